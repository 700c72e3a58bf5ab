"""Sampling job: windows -> pieces -> chips -> products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.functions import cells as C
from rastertable.grid import Grid
from rastertable.operators.algebra import add_mask, add_ndvi, add_zscore, merged_stats
from rastertable.operators.augment import augment_choice, orient_pieces
from rastertable.operators.extract import band_list, select_bands
from rastertable.operators.windows import (
    BLOCK, Uniform, hash_uniform, sample_windows, stitch, window_blocks, window_pieces,
)
from rastertable.schema import band_columns
from rastertable.session import large_tiles
from rastertable.sources import layers
from rastertable.sources.samples import write_products, write_samples


def chips_from_windows(
    windows: DataFrame,
    tiles: DataFrame,
    tile: int,
    uniform: Uniform | None = None,
    zscore: bool = True,
    bands=None,
    positional: bool = False,
    block: int = BLOCK,
    size: int | None = None,
    **join_options,
) -> DataFrame:
    """Chips with all products as columns: b*, ndvi, mask and z_b*.

    A chip is stored as blocks of at most ``block`` x ``block`` cells, one row
    each: ``px, py`` is the block's place in the (turned) chip, ``cols, rows``
    its size and ``x0 .. y1`` the window of the whole chip.  So a row is
    bounded however large the chip is, and a chip of at most a block is one
    row.  Blocks that meet no tile have no row.

    One plan: window keys join the tiles, pieces are cut before the shuffle,
    each block is stitched in its own group, and everything after that is
    narrow, but for the statistics of chips of several blocks: moments of the
    pieces, merged per window and joined back.  ``size`` (the windows' side, if
    known) spares that where a chip is one block.  A chip without data has no
    z-score.

    ``uniform`` switches augmentation on.  NDVI and mask use the layer's bands;
    ``positional=True`` takes them from the chosen subset instead (positions 0
    and 3, and the last three).
    """
    chosen = band_list(bands)
    if positional and chosen:
        tiles = select_bands(tiles, chosen)
    have = band_columns(tiles)
    if "b3" not in have:
        raise ValueError("NDVI needs the bands b0 and b3")
    wanted = list(range(len(have))) if positional or not chosen else chosen
    # Read only what the image, the NDVI and the mask need.
    needed = sorted({0, 3, *wanted, *[int(b[1:]) for b in have[-3:]]})
    single = size is not None and size <= block
    windows = windows.withColumn("chip", F.struct("x0", "y0", "x1", "y1")) if single else window_blocks(windows, block)
    pieces = window_pieces(windows, tiles.select("col", "row", *[f"b{k}" for k in needed]), tile, **join_options)
    chips = stitch(pieces, tile).withColumns(
        {
            "px": (F.col("x0") - F.col("chip.x0")).cast("int"),
            "py": (F.col("y0") - F.col("chip.y0")).cast("int"),
            "w": F.col("cols"),
            "h": F.col("rows"),
        }
    )
    chips = chips.withColumns({c: F.col(f"chip.{c}") for c in ("x0", "y0", "x1", "y1")}).drop("chip")
    if uniform is not None:
        chips = orient_pieces(chips.withColumns(augment_choice(F.col("window_id"), uniform)))
        chips = chips.drop("flip_v", "flip_h", "turns")
    chips = chips.withColumns({"cols": F.col("w"), "rows": F.col("h")}).drop("w", "h")
    chips = add_mask(add_ndvi(chips), have[-3:])
    rest = [c for c in chips.columns if c not in band_columns(chips)]
    if not zscore or single:
        chips = chips.select(*rest, *[F.col(f"b{k}").alias(f"b{n}") for n, k in enumerate(wanted)])
        return add_zscore(chips, strict=False) if zscore else chips
    used = [f"b{k}" for k in sorted(set(wanted))]
    stats = merged_stats(pieces, "window_id", used)
    stats = stats.select("window_id", *[F.col(b).alias(f"_{b}") for b in used])

    def scored(b: str):
        return F.transform(b, lambda v: C.zscore(v, F.col(f"_{b}.mean"), F.col(f"_{b}.sd")))

    return chips.join(stats, "window_id").select(
        *rest,
        *[F.col(f"b{k}").alias(f"b{n}") for n, k in enumerate(wanted)],
        *[scored(f"b{k}").alias(f"z_b{n}") for n, k in enumerate(wanted)],
    )


def generate_samples(
    spark: SparkSession,
    catalog: str,
    layer: str,
    path: str,
    split: str = "entire",
    zoom: int = 0,
    size: int = 256,
    amount: int = 5000,
    randomize: bool = True,
    zscore: bool = True,
    bands=None,
    positional: bool = False,
    gzip: bool = False,
    copy_to: str | None = None,
    seed: int = 0,
    products: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Draw ``amount`` windows of a split and write their chips, in blocks of ``block`` cells a side.

    Returns the chips as read back from ``path``.  ``copy_to`` also writes them
    to another store, and ``products`` writes one directory per product.
    """
    grid = Grid.from_meta(layers.layer_meta_row(spark, catalog, layer, zoom))
    extent = layers.split_extent(spark, catalog, layer, zoom, split)
    windows = sample_windows(spark, amount, extent, size, grid, seed, split)
    # Chip georeference: the drawn rectangle; it is not changed by rotation.
    windows = windows.select(
        "window_id", "split", "size", F.lit(grid.crs).alias("crs"),
        F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"), "x0", "y0", "x1", "y1",
    )
    tiles = layers.read_layer(spark, catalog, layer, zoom)
    uniform = hash_uniform(seed) if randomize else None
    chips = chips_from_windows(windows, tiles, grid.tile, uniform, zscore, bands, positional, block, size)
    with large_tiles(spark):
        write_samples(chips, path, gzip)
    stored = spark.read.parquet(path)
    if products:
        names = ("image", "ndvi", "mask", "image_z") if zscore else ("image", "ndvi", "mask")
        write_products(stored, f"{path.rstrip('/')}-products", names, gzip)
    if copy_to is not None:
        write_samples(stored, copy_to, gzip)
    return stored
