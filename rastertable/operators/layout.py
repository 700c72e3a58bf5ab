"""Cutting rasters into keyed tile layers, and moving between tile and pixel form."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.functions.geo import reproject, reproject_columns
from rastertable.functions.tiles import constant_cells, crop_cells, dense_bands, let, place_cells
from rastertable.grid import Grid, zorder
from rastertable.operators.joins import join_tiles, measured_broadcast, spread
from rastertable.schema import BAND_NAMES, LAYER_META, SCENE_SIZE, band_columns, cell_sql_type
from rastertable.session import bounded_batches

# Contributions to one tile that are merged inside one group; tiles with more
# are merged cell by cell, where partial aggregation bounds every task.  A full
# 512 x 512 piece of 11 int bands has 11.5 MB.
FAN_IN = 16
# Tiles are hash-partitioned by their Z-order cell of 2 ** 4 tiles, so that a
# layer comes out of the tiling shuffle already clustered for writing.
CELL_BITS = 4


# ---------------------------------------------------------------- pixels, tiles
def tiles_to_pixels(tiles: DataFrame, tile: int, drop_nodata: bool = True) -> DataFrame:
    """One row per cell with global grid coordinates ``x``/``y``; narrow."""
    bands = band_columns(tiles)
    keep = [c for c in tiles.columns if c not in (*bands, "col", "row", "z", "tile_cols", "tile_rows")]
    pixels = tiles.select(
        *keep, "col", "row", F.posexplode(F.arrays_zip(*[F.col(b) for b in bands])).alias("_k", "_c")
    ).select(
        *keep,
        (F.col("col").cast("bigint") * tile + F.col("_k") % tile).alias("x"),
        (F.col("row").cast("bigint") * tile + F.floor(F.col("_k") / tile)).alias("y"),
        *[F.col(f"_c.{b}").alias(b) for b in bands],
    )
    if drop_nodata:
        pixels = pixels.where(F.coalesce(*[F.col(b) for b in bands]).isNotNull())
    return pixels


def pixels_to_tiles(pixels: DataFrame, tile: int) -> DataFrame:
    """Tiles from pixels that are unique per (x, y); absent cells are NoData.

    Groups are bounded by the cells of one tile.
    """
    bands = band_columns(pixels)
    local = pixels.select(
        F.floor(F.col("x") / tile).cast("int").alias("col"),
        F.floor(F.col("y") / tile).cast("int").alias("row"),
        F.struct(
            (F.pmod("y", F.lit(tile)) * tile + F.pmod("x", F.lit(tile))).cast("int").alias("k"),
            *bands,
        ).alias("e"),
    )
    grouped = local.groupBy("col", "row").agg(F.sort_array(F.collect_list("e")).alias("_e"))
    return grouped.select(
        "col", "row", zorder(F.col("col"), F.col("row")).alias("z"),
        F.lit(tile).alias("tile_cols"), F.lit(tile).alias("tile_rows"),
        dense_bands(F.col("_e"), {b: cell_sql_type(pixels, b) for b in bands}, tile * tile).alias("_d"),
    ).select("col", "row", "z", "tile_cols", "tile_rows", *[F.col(f"_d.{b}").alias(b) for b in bands])


def merge_pixels(pixels: DataFrame, order: str) -> DataFrame:
    """One row per cell: per band, the data of the lowest ``order`` wins.

    NoData never overwrites data.  Partial aggregation collapses copies of a
    cell before the shuffle.
    """
    bands = band_columns(pixels)
    return pixels.groupBy("x", "y").agg(
        *[
            F.min_by(b, F.when(F.col(b).isNotNull(), F.col(order))).alias(b)
            for b in bands
        ]
    )


# --------------------------------------------------------------------- metadata
def collect_metadata(
    scenes: DataFrame,
    layer: str,
    tile: int,
    zoom: int = 0,
    scene_size: int = SCENE_SIZE,
    band_names=BAND_NAMES,
) -> DataFrame:
    """The one-row ``layer_meta`` of a floating layout over the given scenes.

    The layout starts at the north-western corner of the common extent; the
    cell size is that of the first scene (all must agree to be tiled).
    """
    box = scenes.agg(
        F.min("crs").alias("crs"), F.min("cell_type").alias("cell_type"),
        F.min("extent.xmin").alias("xmin"), F.min("extent.ymin").alias("ymin"),
        F.max("extent.xmax").alias("xmax"), F.max("extent.ymax").alias("ymax"),
        F.min((F.col("extent.xmax") - F.col("extent.xmin")) / scene_size).alias("cw"),
        F.min((F.col("extent.ymax") - F.col("extent.ymin")) / scene_size).alias("ch"),
    )
    return layer_metadata(box, layer, tile, zoom, band_names)


def layer_metadata(box: DataFrame, layer: str, tile: int, zoom: int, band_names) -> DataFrame:
    """Metadata row from a bounding box row (crs, cell_type, xmin.., cw, ch)."""
    c = F.col
    cols = F.round((c("xmax") - c("xmin")) / c("cw")).cast("int")
    rows = F.round((c("ymax") - c("ymin")) / c("ch")).cast("int")
    col_max = F.floor((cols - 1) / tile).cast("int")
    row_max = F.floor((rows - 1) / tile).cast("int")
    return box.select(
        F.lit(layer).alias("layer"), F.lit(zoom).alias("zoom"), "crs", "cell_type",
        F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"),
        F.struct(
            c("xmin"),
            (c("ymax") - (row_max + 1) * tile * c("ch")).alias("ymin"),
            (c("xmin") + (col_max + 1) * tile * c("cw")).alias("xmax"),
            c("ymax"),
        ).alias("layout_extent"),
        F.lit(tile).alias("tile_size"), c("cw").alias("cell_w"), c("ch").alias("cell_h"),
        F.lit(0).alias("col_min"), col_max.alias("col_max"),
        F.lit(0).alias("row_min"), row_max.alias("row_max"),
        F.array(*[F.lit(n) for n in band_names]).alias("band_names"),
    ).to(LAYER_META)


# ----------------------------------------------------------------------- tiling
def place_on_grid(scenes: DataFrame, grid: Grid, scene_size: int = SCENE_SIZE) -> DataFrame:
    """Add ``x0``/``y0``, the grid cell of a block's first cell.

    The centre of the cell decides: ``floor((centre - origin) / cell)``.  Cells
    of another size than the grid's are an error (reproject those instead).
    """
    cw = (F.col("extent.xmax") - F.col("extent.xmin")) / scene_size
    ch = (F.col("extent.ymax") - F.col("extent.ymin")) / scene_size
    # A scene may be off by less than half a cell at its far end.
    same = (F.abs(cw - grid.cw) * scene_size < grid.cw / 2) & (
        F.abs(ch - grid.ch) * scene_size < grid.ch / 2
    )
    wrong = F.raise_error(F.lit("scene cell size differs from the layout")).cast("bigint")
    return scenes.withColumns(
        {
            "x0": F.when(
                same, grid.x_of(F.col("extent.xmin") + F.lit(0.5) * cw) + F.col("x_off")
            ).otherwise(wrong),
            "y0": grid.y_of(F.col("extent.ymax") - F.lit(0.5) * ch) + F.col("y_off"),
        }
    )


def _pieces(blocks: DataFrame, tile: int, order: str, with_cells: bool) -> DataFrame:
    def span(start: str, size: str):
        last = F.col(start) + F.col(size) - 1
        return F.sequence(
            F.floor(F.col(start) / tile).cast("int"), F.floor(last / tile).cast("int")
        )

    keyed = blocks.withColumn("row", F.explode(span("y0", "rows"))).withColumn(
        "col", F.explode(span("x0", "cols"))
    )
    if not with_cells:
        return keyed.select("col", "row")
    left = F.greatest(F.col("col").cast("bigint") * tile, F.col("x0"))
    top = F.greatest(F.col("row").cast("bigint") * tile, F.col("y0"))
    right = F.least((F.col("col").cast("bigint") + 1) * tile, F.col("x0") + F.col("cols"))
    bottom = F.least((F.col("row").cast("bigint") + 1) * tile, F.col("y0") + F.col("rows"))
    w, h = (right - left).cast("int"), (bottom - top).cast("int")
    return keyed.select(
        "col", "row", F.col(order).alias("ord"),
        (left - F.col("col").cast("bigint") * tile).cast("int").alias("px"),
        (top - F.col("row").cast("bigint") * tile).cast("int").alias("py"),
        w.alias("w"), h.alias("h"),
        *[
            crop_cells(F.col(b), F.col("cols"), left - F.col("x0"), top - F.col("y0"), w, h).alias(b)
            for b in band_columns(blocks)
        ],
    )


def tile_to_layout(
    blocks: DataFrame,
    grid: Grid,
    order: str,
    fan_in: int = FAN_IN,
    footprint: DataFrame | None = None,
) -> DataFrame:
    """Cut placed blocks (``x0, y0, cols, rows, b*``) into tiles of the grid.

    Blocks are sliced to the tiles they touch before the one shuffle, which
    clusters by Z-order cell.  Where blocks overlap, data of the lowest
    ``order`` (a unique, orderable column) wins and NoData never overwrites
    data.  A count over the keys finds tiles with more than ``fan_in``
    contributions; those are merged cell by cell with partial aggregation.
    ``footprint`` may supply the ``x0, y0, cols, rows`` of the same blocks from
    a cheaper plan for that count.
    """
    tile = grid.tile
    if footprint is None:
        footprint = blocks
    counts = _pieces(footprint, tile, order, False).groupBy("col", "row").agg(F.count("*").alias("_n"))
    hot = counts.where(F.col("_n") > fan_in).select("col", "row")
    pieces = _pieces(blocks, tile, order, True)
    if hot.isEmpty():
        return _merge_pieces(pieces, tile)
    hot = measured_broadcast(hot)
    cold_tiles = _merge_pieces(pieces.join(hot, ["col", "row"], "left_anti"), tile)
    bands = band_columns(blocks)
    cells = (
        pieces.join(hot, ["col", "row"], "left_semi")
        .select(
            "col", "row", "ord", "px", "py", "w",
            F.posexplode(F.arrays_zip(*[F.col(b) for b in bands])).alias("_k", "_c"),
        )
        .select(
            (F.col("col").cast("bigint") * tile + F.col("px") + F.col("_k") % F.col("w")).alias("x"),
            (F.col("row").cast("bigint") * tile + F.col("py") + F.floor(F.col("_k") / F.col("w"))).alias("y"),
            "ord",
            *[F.col(f"_c.{b}").alias(b) for b in bands],
        )
    )
    return cold_tiles.unionByName(pixels_to_tiles(merge_pixels(cells, "ord"), tile))


def _merge_pieces(pieces: DataFrame, tile: int) -> DataFrame:
    bands = band_columns(pieces)
    n = tile * tile
    z = zorder(F.col("col"), F.col("row"))
    grouped = (
        pieces.withColumn("_cell", F.shiftright(z, CELL_BITS))
        .repartition("_cell")
        .groupBy("_cell", "col", "row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("ord", "px", "py", "w", "h", *bands)),
                # Only the order is compared, never the cells.
                lambda a, b: F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0),
            ).alias("_p")
        )
    )

    def merged(band: str):
        ctype = cell_sql_type(pieces, band)

        def placed(p):
            return F.when(
                (p["w"] == tile) & (p["h"] == tile), p[band]
            ).otherwise(
                place_cells(p[band], p["w"], p["px"], p["py"], p["w"], p["h"], tile, tile, ctype)
            )

        return let(
            F.col("_p"),
            lambda ps: F.when(F.size(ps) == 1, placed(F.get(ps, F.lit(0)))).otherwise(
                F.aggregate(
                    ps,
                    constant_cells(None, n, ctype),
                    lambda acc, p: F.zip_with(acc, placed(p), lambda a, b: F.coalesce(a, b)),
                )
            ),
        ).alias(band)

    return grouped.select(
        "col", "row", z.alias("z"), F.lit(tile).alias("tile_cols"), F.lit(tile).alias("tile_rows"),
        *[merged(b) for b in bands],
    )


# ------------------------------------------------------------------ resolutions
def pyramid_level(tiles: DataFrame, tile: int, level: int) -> DataFrame:
    """Overview ``level`` steps above the base layer, nearest neighbour.

    Every 2 x 2 block keeps its top-left cell, so level ``n`` keeps the cells
    whose coordinates are multiples of ``2**n``: each level comes straight from
    the base layer.  Tiles are thinned before the shuffle.
    """
    if level == 0:
        return tiles
    f = 2**level
    bands = band_columns(tiles)
    ctype = {b: cell_sql_type(tiles, b) for b in bands}
    if f <= tile and tile % f == 0:
        side = tile // f

        def thin(b: str):
            return let(
                F.col(b),
                lambda a: F.flatten(
                    F.transform(
                        F.sequence(F.lit(0), F.lit(side - 1)),
                        lambda y: F.transform(
                            F.sequence(F.lit(0), F.lit(side - 1)),
                            lambda x: F.get(a, y * (f * tile) + x * f),
                        ),
                    )
                ),
            ).alias(b)

        blocks = tiles.select(
            (F.col("col").cast("bigint") * side).alias("x0"),
            (F.col("row").cast("bigint") * side).alias("y0"),
            F.lit(side).alias("cols"), F.lit(side).alias("rows"), F.lit(0).alias("ord"),
            *[thin(b) for b in bands],
        )
        # Each parent has f*f children that never overlap.
        return _merge_children(_pieces(blocks, tile, "ord", True), tile, side, ctype)
    kept = tiles_to_pixels(tiles.select("col", "row", *bands), tile)
    return pixels_to_tiles(pyramid_pixels(kept, level), tile)


def zoomed_levels(tiles: DataFrame, tile: int, zoom: int, levels: int) -> DataFrame:
    """A layer of the given zoom and its next overviews, ``levels`` in all: (zoom, col, row, bands).

    Each level is thinned from the base tiles, so no level waits for another and
    Spark shares the base's shuffle.  For overviews down to zoom 0 use the job
    that writes each level before it reads it.
    """
    if not 1 <= levels <= zoom + 1:
        raise ValueError("need 1 <= levels <= zoom + 1")
    bands = band_columns(tiles)
    each = [
        pyramid_level(tiles, tile, k).select(F.lit(zoom - k).alias("zoom"), "col", "row", *bands)
        for k in range(levels)
    ]
    return reduce(DataFrame.unionByName, each)


def _merge_children(pieces: DataFrame, tile: int, side: int, ctype: dict[str, str]) -> DataFrame:
    """Assemble disjoint ``side x side`` pieces on a regular raster of a tile."""
    per = tile // side
    bands = list(ctype)
    z = zorder(F.col("col"), F.col("row"))
    slot = (F.floor(F.col("py") / side) * per + F.floor(F.col("px") / side)).cast("int")
    grouped = (
        pieces.withColumn("_cell", F.shiftright(z, CELL_BITS))
        .repartition("_cell")
        .groupBy("_cell", "col", "row")
        .agg(F.map_from_entries(F.collect_list(F.struct(slot, F.struct(*bands)))).alias("_m"))
    )

    def joined(b: str):
        empty = constant_cells(None, side * side, ctype[b])

        def strip(m, r):
            parts = F.transform(
                F.sequence(F.lit(0), F.lit(per - 1)),
                lambda c: F.coalesce(F.try_element_at(m, r * per + c).getField(b), empty),
            )
            return let(
                parts,
                lambda ps: F.flatten(
                    F.transform(
                        F.sequence(F.lit(0), F.lit(side - 1)),
                        lambda y: F.flatten(
                            F.transform(ps, lambda p: F.slice(p, y * side + 1, side))
                        ),
                    )
                ),
            )

        return let(
            F.col("_m"),
            lambda m: F.flatten(
                F.transform(F.sequence(F.lit(0), F.lit(per - 1)), lambda r: strip(m, r))
            ),
        ).alias(b)

    return grouped.select(
        "col", "row", z.alias("z"), F.lit(tile).alias("tile_cols"), F.lit(tile).alias("tile_rows"),
        *[joined(b) for b in bands],
    )


def pyramid_pixels(pixels: DataFrame, level: int) -> DataFrame:
    """The same overview rule in pixel form: a filter and two shifts."""
    f = 2**level
    return pixels.where((F.col("x") % f == 0) & (F.col("y") % f == 0)).withColumns(
        {"x": F.shiftright(F.col("x"), level), "y": F.shiftright(F.col("y"), level)}
    )


def _source_cells(source: Grid, target: Grid, col: int, row: int, window=None):
    """Source cell of the centres in a window of a target tile, and which lie on the source.

    Coordinates of columns and rows are kept apart as long as the projection
    allows; NumPy broadcasts them where it mixes the two.
    """
    c0, c1, r0, r1 = window or (0, target.tile - 1, 0, target.tile - 1)
    tx = np.arange(c0, c1 + 1) + col * target.tile
    ty = np.arange(r0, r1 + 1) + row * target.tile
    mx = (target.ox + (tx + 0.5) * target.cw)[None, :]
    my = (target.oy - (ty + 0.5) * target.ch)[:, None]
    with np.errstate(all="ignore"):
        sx, sy = reproject(mx, my, target.crs, source.crs, np)
        x, y = np.floor((sx - source.ox) / source.cw), np.floor((source.oy - sy) / source.ch)
    x, y = np.broadcast_arrays(x, y)
    inside = np.isfinite(x) & np.isfinite(y) & (x >= 0) & (y >= 0)
    if source.width is not None:
        inside &= (x < source.width) & (y < source.height)
    return np.where(inside, x, -1).astype(np.int64), np.where(inside, y, -1).astype(np.int64), inside


def footprints(target_keys: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """(tcol, trow, col, row, c0, c1, r0, r1): source tiles that a target tile needs, each with
    the window of target cells that may lie on it."""
    names = ["tcol", "trow", "col", "row", "c0", "c1", "r0", "r1"]

    def run(batches):
        for batch in batches:
            out = [np.empty((0, 8), np.int64)]
            for col, row in zip(*(batch.column(i).to_pylist() for i in range(2))):
                x, y, inside = _source_cells(source, target, col, row)
                r, c = np.nonzero(inside)
                if not len(r):
                    continue
                scol, srow = x[r, c] // source.tile, y[r, c] // source.tile
                order = np.lexsort((srow, scol))
                scol, srow, r, c = scol[order], srow[order], r[order], c[order]
                starts = np.flatnonzero(np.append(True, (scol[1:] != scol[:-1]) | (srow[1:] != srow[:-1])))
                own = np.full(len(starts), 1)
                out.append(
                    np.stack(
                        [
                            own * col, own * row, scol[starts], srow[starts],
                            np.minimum.reduceat(c, starts), np.maximum.reduceat(c, starts),
                            np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts),
                        ],
                        axis=1,
                    )
                )
            rows = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i], pa.int32()) for i in range(8)], names=names)

    keys = spread(target_keys.select("col", "row").distinct(), "col", "row")
    return keys.mapInArrow(run, ", ".join(f"{n} int" for n in names))


def reproject_nn(
    tiles: DataFrame, source: Grid, target: Grid, target_keys: DataFrame, skip_empty: bool = True
) -> DataFrame:
    """Resample a layer to another grid or CRS, nearest neighbour.

    Every target cell centre is projected back to the source grid.  Footprints
    say which source tiles a target tile needs; they are joined to the source
    tiles by key, each pair yields the target cells that lie on its source tile
    (in NumPy, only over the pair's window), and these pieces are put together
    per target tile.  Neighbouring tiles arrive by join, so no buffer is
    needed; a piece and a group hold at most the cells of one target tile,
    whatever the scale, and few footprints are broadcast, so that source tiles
    stay where they are.
    """
    t, s = target.tile, source.tile
    bands = band_columns(tiles)
    types = {b: cell_sql_type(tiles, b) for b in bands}
    bounded_batches(tiles, max(s * s, t * t))
    pairs = footprints(target_keys, source, target).withColumn("_pair", F.xxhash64("tcol", "trow"))
    joined = join_tiles(pairs, tiles.select("col", "row", *bands), "_pair").select(
        "tcol", "trow", "col", "row", F.array("c0", "c1", "r0", "r1").alias("_window"), *bands
    )
    schema = "col int, row int, k array<int>, " + ", ".join(f"{b} array<{types[b]}>" for b in bands)

    def look_up(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            keys = [columns[n].to_pylist() for n in ("tcol", "trow", "col", "row", "_window")]
            found = []
            for tcol, trow, col, row, window in zip(*keys):
                x, y, inside = _source_cells(source, target, tcol, trow, window)
                here = inside & (x // s == col) & (y // s == row)
                r, c = np.nonzero(here)
                k = (r + window[2]) * t + c + window[0]
                found.append((k, (y[here] % s) * s + x[here] % s))
            offsets = pa.array(np.cumsum([0, *(len(k) for k, _ in found)]), pa.int32())
            out = [columns["tcol"], columns["trow"]]
            out.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([k for k, _ in found]), pa.int32())))
            for b in bands:
                cells, starts = columns[b].values, columns[b].offsets.to_numpy()
                at = np.concatenate([a + start for start, (_, a) in zip(starts, found)])
                out.append(pa.ListArray.from_arrays(offsets, cells.take(pa.array(at, pa.int64()))))
            yield pa.RecordBatch.from_arrays(out, names=["col", "row", "k", *bands])

    def put_together(pieces: pa.Table) -> pa.Table:
        pieces = pieces.combine_chunks()
        k = pieces["k"].combine_chunks().flatten().to_numpy()
        at = np.full(t * t, -1)
        at[k] = np.arange(len(k))
        place = pa.array(at, pa.int64(), mask=at < 0)
        whole = {b: pieces[b].combine_chunks().flatten().take(place) for b in bands}
        if skip_empty and all(v.null_count == len(v) for v in whole.values()):
            return pieces.slice(0, 0).select(["col", "row", *bands])
        ends = pa.array([0, t * t], pa.int32())
        return pa.table([pieces["col"].slice(0, 1), pieces["row"].slice(0, 1), *(pa.ListArray.from_arrays(ends, v) for v in whole.values())], names=["col", "row", *bands])

    dense = ", ".join(f"{b} array<{types[b]}>" for b in bands)
    parts = joined.mapInArrow(look_up, schema)
    out = parts.groupBy("col", "row").applyInArrow(put_together, f"col int, row int, {dense}")
    return out.select(
        "col", "row", zorder(F.col("col"), F.col("row")).alias("z"),
        F.lit(t).alias("tile_cols"), F.lit(t).alias("tile_rows"), *bands,
    )


def target_keys_for(tiles: DataFrame, source: Grid, target: Grid, margin: int = 1) -> DataFrame:
    """Target tile keys that a source layer can reach.

    Projects a small raster of points of every source tile (its corners and the
    points between) and takes the covered key range plus ``margin`` tiles.
    """
    steps = 4
    step = F.sequence(F.lit(0), F.lit(steps))
    box = source.key_extent(F.col("col"), F.col("row"))
    pts = (
        tiles.select("col", "row", box.alias("e"))
        .withColumn("a", F.explode(step))
        .withColumn("b", F.explode(step))
        .withColumns(
            {
                "px": F.col("e.xmin") + (F.col("e.xmax") - F.col("e.xmin")) * F.col("a") / steps,
                "py": F.col("e.ymin") + (F.col("e.ymax") - F.col("e.ymin")) * F.col("b") / steps,
            }
        )
    )
    pts = reproject_columns(
        pts, F.col("px"), F.col("py"), source.crs, target.crs, ("_mx", "_my")
    )
    tcol, trow = target.key_of(F.col("_mx"), F.col("_my"))
    spans = pts.select("col", "row", tcol.alias("tc"), trow.alias("tr")).groupBy("col", "row").agg(
        F.min("tc").alias("c0"), F.max("tc").alias("c1"),
        F.min("tr").alias("r0"), F.max("tr").alias("r1"),
    )
    return (
        spans.withColumn("_c", F.explode(F.sequence(F.col("c0") - margin, F.col("c1") + margin)))
        .withColumn("_r", F.explode(F.sequence(F.col("r0") - margin, F.col("r1") + margin)))
        .select(F.col("_c").alias("col"), F.col("_r").alias("row"))
        .distinct()
    )
