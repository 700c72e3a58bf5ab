"""Random sample windows, and cutting them out of a tile layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertable.functions.batches import crop_listed, map_rows
from rastertable.functions.tiles import constant_cells, crop_cells, let
from rastertable.grid import Grid
from rastertable.operators.index import dense_index
from rastertable.operators.joins import join_tiles, window_keys
from rastertable.schema import band_columns, cell_sql_type
from rastertable.session import BATCH_CELLS, bounded_batches

Uniform = Callable[[Column, int], Column]

# Side of the blocks in which chips are stored; a smaller chip is one block.
BLOCK = 512


def hash_uniform(seed: int) -> Uniform:
    """Seeded uniform numbers in [0, 1) that depend on (id, salt) only.

    Unlike ``rand(seed)`` the value does not depend on the partitioning, so a
    recomputed task draws the same windows.
    """

    def draw(ident: Column, salt: int) -> Column:
        h = F.xxhash64(ident, F.lit(seed), F.lit(salt))
        return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(2**53))

    return draw


def lcg_uniform(ident: Column, salt: int) -> Column:
    """The deterministic integer recurrence used for reproducible checks."""
    m = 2147483647
    h = (F.pmod(ident.cast("bigint"), F.lit(m)) * 48271 + salt * 16807 + 12345) * 69621
    return (h % m) / F.lit(float(m))


def random_windows(
    draws: DataFrame,
    extent: tuple[float, float, float, float],
    size: int,
    grid: Grid,
    uniform: Uniform,
    ident: str = "draw_id",
) -> DataFrame:
    """One window per draw: (draw_id, xmin, ymin, xmax, ymax, x0, y0, x1, y1).

    The side is ``(size - 1)`` cells and the origin uniform over the extent; if
    the window fits exactly, its origin is the extent's.  A window larger than
    the extent is an error.
    """
    xmin, ymin, xmax, ymax = extent
    w, h = grid.cw * (size - 1), grid.ch * (size - 1)
    if w > xmax - xmin or h > ymax - ymin:
        raise ValueError(f"window of {size} cells is larger than the extent {extent}")
    u = F.col(ident)
    return (
        draws.select(
            F.col(ident).cast("bigint").alias("draw_id"),
            (F.lit(xmin) + uniform(u, 1) * F.lit(xmax - xmin - w)).alias("xmin"),
            (F.lit(ymin) + uniform(u, 2) * F.lit(ymax - ymin - h)).alias("ymin"),
        )
        .withColumns({"xmax": F.col("xmin") + F.lit(w), "ymax": F.col("ymin") + F.lit(h)})
        .withColumns(
            grid.crop_bounds(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
        )
    )


def distinct_windows(windows: DataFrame) -> DataFrame:
    """Equal rectangles once, keeping the lowest draw; partial aggregation."""
    corner = ["xmin", "ymin", "xmax", "ymax"]
    rest = [c for c in windows.columns if c not in (*corner, "draw_id")]
    return windows.groupBy(*corner).agg(
        F.min("draw_id").alias("draw_id"), *[F.min_by(c, "draw_id").alias(c) for c in rest]
    )


def number_windows(windows: DataFrame) -> DataFrame:
    """Consecutive ``window_id`` in draw order; it names the output files."""
    return dense_index(windows, "draw_id", "window_id")


def sample_windows(
    spark: SparkSession,
    amount: int,
    extent: tuple[float, float, float, float],
    size: int,
    grid: Grid,
    seed: int = 0,
    split: str = "entire",
) -> DataFrame:
    """``amount`` random windows, distinct and numbered from 0."""
    if amount < 1:
        raise ValueError("amount must be positive")
    drawn = random_windows(
        spark.range(1, amount + 1).withColumnRenamed("id", "draw_id"),
        extent, size, grid, hash_uniform(seed),
    )
    return number_windows(distinct_windows(drawn)).withColumns(
        {"split": F.lit(split), "size": F.lit(size)}
    )


def crop_tiles(joined: DataFrame, tile: int, keep: list[str]) -> DataFrame:
    """Slice joined tiles to their window: one piece per (window, tile); narrow.

    ``px, py`` is the position of the piece in the window, ``w, h`` its size.
    """
    left = F.greatest(F.col("col").cast("bigint") * tile, F.col("x0"))
    top = F.greatest(F.col("row").cast("bigint") * tile, F.col("y0"))
    right = F.least((F.col("col").cast("bigint") + 1) * tile - 1, F.col("x1"))
    bottom = F.least((F.col("row").cast("bigint") + 1) * tile - 1, F.col("y1"))
    w, h = (right - left + 1).cast("int"), (bottom - top + 1).cast("int")
    return joined.select(
        *keep, "col", "row", "x0", "y0", "x1", "y1",
        (left - F.col("x0")).cast("int").alias("px"),
        (top - F.col("y0")).cast("int").alias("py"),
        w.alias("w"), h.alias("h"),
        *[
            crop_cells(
                F.col(b), F.lit(tile), left - F.col("col") * tile, top - F.col("row") * tile, w, h
            ).alias(b)
            for b in band_columns(joined)
        ],
    )


def window_blocks(windows: DataFrame, side: int = BLOCK) -> DataFrame:
    """Cut windows into blocks of at most ``side`` x ``side`` cells; narrow.

    ``x0 .. y1`` become the bounds of the block; ``chip`` keeps those of the
    window, so the place of a block in its chip is the difference.
    """
    bounds = ("x0", "y0", "x1", "y1")

    def starts(lo: str, hi: str) -> Column:
        return F.sequence(F.col(lo).cast("bigint"), F.col(hi).cast("bigint"), F.lit(side).cast("bigint"))

    out = windows.withColumn("chip", F.struct(*bounds))
    out = out.withColumn("x0", F.explode(starts("x0", "x1"))).withColumn("y0", F.explode(starts("y0", "y1")))
    return out.withColumns({"x1": F.least(F.col("x0") + side - 1, "x1"), "y1": F.least(F.col("y0") + side - 1, "y1")})


def window_pieces(
    windows: DataFrame, tiles: DataFrame, tile: int, ident: str = "window_id", **join_options
) -> DataFrame:
    """Pieces of every window, without stitching.

    Suits windows of any size: no cells are grouped, and the tiles are shuffled
    only if the windows are too many or too concentrated to broadcast.  A tile
    meets its windows as a list, so its cells reach Python once for all of them,
    and the pieces of ``crop_tiles`` leave in bounded batches.
    """
    bands = band_columns(tiles)
    bounds = ("x0", "y0", "x1", "y1")
    keep = [c for c in windows.columns if c not in bounds]
    tiles = tiles.select("col", "row", *bands)
    if not bands:
        return crop_tiles(join_tiles(window_keys(windows, tile), tiles, ident, **join_options), tile, keep)
    bounded_batches(tiles, tile * tile)
    joined = join_tiles(window_keys(windows, tile), tiles, ident, lists=True, **join_options)
    kind = {f.name: f.dataType for f in (*tiles.schema, *windows.schema)}
    kind |= {c: T.IntegerType() for c in ("px", "py", "w", "h")} | {b: T.ArrayType(kind[b].elementType) for b in bands}
    schema = T.StructType([T.StructField(c, kind[c]) for c in (*keep, "col", "row", *bounds, "px", "py", "w", "h", *bands)])
    return map_rows(joined, crop_listed(tile, keep, bands, BATCH_CELLS), schema)


def stitch(pieces: DataFrame, tile: int, ident: str = "window_id") -> DataFrame:
    """Join the pieces of each window into one row of dense bands.

    Pieces are already cut to their window, so a group holds at most the cells
    of one window: cut large windows into blocks first (``window_blocks``).
    Parts no tile covers are NoData.  A window that meets no tile has no piece
    and hence no row.
    """
    bands = band_columns(pieces)
    spot = ("col", "row", "x0", "y0", "x1", "y1", "px", "py", "w", "h")
    rest = [c for c in pieces.columns if c not in (*spot, *bands, ident)]
    grouped = (
        pieces.groupBy(ident, "x0", "y0", "x1", "y1")
        .agg(
            *[F.first(c).alias(c) for c in rest],
            F.collect_list(F.struct("col", "row", "w", "h", *bands)).alias("_p"),
        )
    )
    t = F.lit(tile)

    def div(v: Column) -> Column:
        return F.floor(v / t).cast("int")

    def overlap(lo: Column, hi: Column, k: Column) -> Column:
        """Cells that tile index ``k`` shares with [lo, hi]."""
        first = F.greatest(k.cast("bigint") * t, lo)
        last = F.least((k.cast("bigint") + 1) * t - 1, hi)
        return (last - first + 1).cast("int")

    def stitched(band: str) -> Column:
        ctype = cell_sql_type(pieces, band)
        x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))

        def strip(ps: Column, r: Column) -> Column:
            h = overlap(y0, y1, r)

            def part(c: Column) -> Column:
                w = overlap(x0, x1, c)
                hit = F.get(F.filter(ps, lambda p: (p["col"] == c) & (p["row"] == r)), F.lit(0))
                return F.struct(
                    w.alias("w"),
                    F.coalesce(hit.getField(band), constant_cells(None, w * h, ctype)).alias("a"),
                )

            return let(
                F.transform(F.sequence(div(x0), div(x1)), part),
                lambda parts: F.flatten(
                    F.transform(
                        F.sequence(F.lit(0), h - 1),
                        lambda y: F.flatten(
                            F.transform(
                                parts, lambda p: F.slice(p["a"], y * p["w"] + 1, p["w"])
                            )
                        ),
                    )
                ),
            )

        whole = F.get(F.col("_p"), F.lit(0)).getField(band)
        # A window inside one tile needs no stitching.
        single = (div(x0) == div(x1)) & (div(y0) == div(y1))
        return (
            F.when(single, whole)
            .otherwise(
                let(
                    F.col("_p"),
                    lambda ps: F.flatten(
                        F.transform(F.sequence(div(y0), div(y1)), lambda r: strip(ps, r))
                    ),
                )
            )
            .alias(band)
        )

    return grouped.select(
        ident, *rest, "x0", "y0", "x1", "y1",
        (F.col("x1") - F.col("x0") + 1).cast("int").alias("cols"),
        (F.col("y1") - F.col("y0") + 1).cast("int").alias("rows"),
        *[stitched(b) for b in bands],
    )


def stitch_windows(
    windows: DataFrame, tiles: DataFrame, tile: int, ident: str = "window_id", **join_options
) -> DataFrame:
    """Windows cut out of a layer as one row of dense bands each."""
    return stitch(window_pieces(windows, tiles, tile, ident, **join_options), tile, ident)
