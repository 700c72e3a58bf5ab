"""Stacking co-registered source files into scenes of ordered bands.

Everything that depends on whole files (band offsets, extent repair, cell type)
is computed on header rows, which carry no cells.  Cell data is shuffled once,
by (scene, block), and a group never holds more than one block per band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastertable.functions.tiles import constant_cells, pad_cells
from rastertable.schema import SCENE_SIZE, SOURCE_BANDS, TOTAL_BANDS, cell_sql_type

FILE = ["source_dir", "file_name"]


def is_corrupt_extent(extent: Column, size: int = SCENE_SIZE) -> Column:
    """A scene without georeference carries the extent (0, 0, size, size)."""
    return (
        (extent["xmin"] == 0) & (extent["ymin"] == 0)
        & (extent["xmax"] == size) & (extent["ymax"] == size)
    )


def file_headers(blocks: DataFrame) -> DataFrame:
    """One row per file: scene key, source, band count, cell type, CRS, extent."""
    return blocks.groupBy("i", "j", "src", *FILE).agg(
        (F.max("band") + 1).alias("n_bands"),
        F.min("cell_type").alias("cell_type"),
        F.min("crs").alias("crs"),
        F.min("extent").alias("extent"),
    )


def scene_headers(headers: DataFrame, size: int = SCENE_SIZE) -> DataFrame:
    """One row per scene: band total, first cell type, repaired CRS and extent.

    The extent and CRS come from the first file in band order whose extent is
    not corrupt; a scene without such a file is an error.
    """
    order = F.struct("src", "file_name")
    good = F.when(~is_corrupt_extent(F.col("extent"), size), F.struct("crs", "extent"))
    agg = headers.groupBy("i", "j").agg(
        F.sum("n_bands").cast("int").alias("n_bands"),
        F.min_by("cell_type", order).alias("cell_type"),
        F.min_by(good, F.when(good.isNotNull(), order)).alias("_good"),
    )
    missing = F.raise_error(
        F.format_string("scene %d_%d has no file with a valid extent", F.col("i"), F.col("j"))
    )
    checked = F.when(F.col("_good").isNotNull(), F.col("_good")).otherwise(
        missing.cast("struct<crs:string,extent:struct<xmin:double,ymin:double,xmax:double,ymax:double>>")
    )
    return agg.withColumn("_good", checked).select(
        "i", "j", "n_bands", "cell_type", "_good.crs", "_good.extent"
    )


def band_offsets(headers: DataFrame, within: tuple[str, ...] = ("i", "j")) -> DataFrame:
    """Add ``band_offset``: bands of earlier files (src, name) of the scene."""
    w = (
        Window.partitionBy(*within).orderBy("src", "file_name", "source_dir")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return headers.withColumn(
        "band_offset", F.coalesce(F.sum("n_bands").over(w), F.lit(0)).cast("int")
    )


def slot_offset(src: Column, source_bands=SOURCE_BANDS) -> Column:
    """First band of a source when every source keeps its own slot."""
    starts = [sum(source_bands[:k]) for k in range(len(source_bands))]
    return F.get(F.array(*[F.lit(v) for v in starts]), src)


def _placed_files(headers: DataFrame, total: int, pad: str, source_bands) -> DataFrame:
    """First band of every file; a file that does not fit is an error."""
    if pad == "slot":
        files = band_offsets(headers, ("i", "j", "src"))
        start = slot_offset(F.col("src"), source_bands)
        room = F.get(F.array(*[F.lit(n) for n in source_bands]), F.col("src"))
    else:
        files = band_offsets(headers)
        start, room = F.lit(0), F.lit(total)
    fits = F.col("band_offset") + F.col("n_bands") <= room
    excess = F.raise_error(
        F.format_string("scene %d_%d has more than %d bands: %s", F.col("i"), F.col("j"), room, F.col("file_name"))
    ).cast("int")
    return files.withColumn(
        "band_offset", F.when(fits, start + F.col("band_offset")).otherwise(excess)
    )


def _block_side(block: str, block_size: int, scene_size: int) -> Column:
    return F.least(F.lit(block_size), F.lit(scene_size) - F.col(block) * block_size).cast("int")


def block_frame(scenes: DataFrame, block_size: int, scene_size: int = SCENE_SIZE) -> DataFrame:
    """Every block position of every scene header, with offset and size."""
    axis = F.sequence(F.lit(0), F.lit(-(-scene_size // block_size) - 1))
    return (
        scenes.withColumn("block_x", F.explode(axis))
        .withColumn("block_y", F.explode(axis))
        .withColumns(
            {
                "x_off": F.col("block_x") * block_size,
                "y_off": F.col("block_y") * block_size,
                "cols": _block_side("block_x", block_size, scene_size),
                "rows": _block_side("block_y", block_size, scene_size),
            }
        )
    )


def assemble_scenes(
    blocks: DataFrame,
    block_size: int,
    scene_size: int = SCENE_SIZE,
    total_bands: int = TOTAL_BANDS,
    pad: str = "tail",
    source_bands=SOURCE_BANDS,
) -> DataFrame:
    """Scenes in block form: (i, j, block_x, block_y, .., b0 .. b10).

    Bands follow source order.  Short bands are padded with zeros to the scene
    size, and missing bands become zero bands: at the end (``pad='tail'``), or
    in the slot of the missing source (``pad='slot'``).  A scene with more than
    ``total_bands`` bands, a block outside the scene, or two rows for one block
    of a band is an error; nothing is dropped.

    A cell-free frame of all block positions, which carries the scene header
    and the first band of each file, is joined with the blocks on the block
    key.  The join and the grouping share that key, so cell data is shuffled
    once however many files there are.
    """
    if pad not in ("tail", "slot"):
        raise ValueError("pad must be 'tail' or 'slot'")
    key = ["i", "j", "block_x", "block_y"]
    n = -(-scene_size // block_size)
    headers = file_headers(blocks)
    # At most ``total_bands`` files per scene, since each has a band and fits.
    offsets = (
        _placed_files(headers, total_bands, pad, source_bands)
        .groupBy("i", "j")
        .agg(F.collect_list(F.struct(*FILE, "band_offset")).alias("_files"))
    )
    scenes = scene_headers(headers, scene_size).join(offsets, ["i", "j"])
    header = ["crs", "extent", "cell_type", "n_bands"]
    frame = block_frame(scenes, block_size, scene_size).select(*key, *header, "_files")
    ctype = cell_sql_type(blocks, "cells")
    outside = F.raise_error(
        F.concat(F.lit("block outside the scene: "), F.col("file_name"))
    ).cast("int")
    inside = (F.col("block_x") < n) & (F.col("block_y") < n)
    data = blocks.select(
        "i", "j", F.when(inside, F.col("block_x")).otherwise(outside).alias("block_x"), "block_y",
        *FILE, "band",
        pad_cells(
            F.col("cells"), F.col("cols"), F.col("rows"),
            _block_side("block_x", block_size, scene_size),
            _block_side("block_y", block_size, scene_size), 0, ctype,
        ).alias("_cells"),
    )
    own = F.get(
        F.filter(
            "_files",
            lambda f: (f["source_dir"] == F.col("source_dir")) & (f["file_name"] == F.col("file_name")),
        ),
        F.lit(0),
    )
    # Both sides are partitioned by the block key beforehand, which the join
    # and the aggregation keep.
    tagged = (
        frame.repartition(*key)
        .join(data.repartition(*key), key, "left")
        .select(*key, *header, (own["band_offset"] + F.col("band")).alias("_k"), "_cells")
    )
    stacked = tagged.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in header],
        F.greatest(F.lit(0), *[F.count_if(F.col("_k") == k) for k in range(total_bands)]).alias("_most"),
        *[
            F.first(F.when(F.col("_k") == k, F.col("_cells")), ignorenulls=True).alias(f"b{k}")
            for k in range(total_bands)
        ],
    )
    twice = F.raise_error(
        F.format_string("scene %d_%d has two rows of one band for block %d, %d", *[F.col(c) for c in key])
    ).cast("boolean")
    stacked = stacked.where(F.when(F.col("_most") > 1, twice).otherwise(F.lit(True)))
    cols = _block_side("block_x", block_size, scene_size)
    rows = _block_side("block_y", block_size, scene_size)
    zero = constant_cells(0, cols * rows, ctype)
    return stacked.select(
        *key, *header,
        (F.col("block_x") * block_size).alias("x_off"),
        (F.col("block_y") * block_size).alias("y_off"),
        cols.alias("cols"), rows.alias("rows"),
        *[F.coalesce(F.col(f"b{k}"), zero).alias(f"b{k}") for k in range(total_bands)],
    )


def rekey(scenes: DataFrame) -> DataFrame:
    """Drop the scene key, keep the georeferenced payload."""
    return scenes.drop("i", "j")
