"""Band selection, polygon filters and masks, layer extracts and tile views."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertable.functions import geo
from rastertable.functions.batches import map_bands, masked
from rastertable.functions.tiles import crop_cells
from rastertable.grid import Grid, zorder_of
from rastertable.operators.joins import join_tiles, spread
from rastertable.schema import BAND_NAMES, band_columns
from rastertable.session import bounded_batches

# Unrolling more edges than this would exceed the generated-code limit.
UNROLL_EDGES = 64


# ------------------------------------------------------------------------ bands
def band_list(bands: str | Sequence[int] | None) -> list[int]:
    """Band numbers from a list or from dotted text such as ``"0.1.2"``."""
    if not bands:
        return []
    if isinstance(bands, str):
        return [int(p) for p in bands.split(".")]
    return list(bands)


def select_bands(df: DataFrame, bands: str | Sequence[int] | None) -> DataFrame:
    """Keep the bands in list order as b0, b1, ..; an empty list keeps all.

    Bands are columns, so the rest is never read from the files.
    """
    chosen = band_list(bands)
    if not chosen:
        return df
    have = band_columns(df)
    missing = [k for k in chosen if f"b{k}" not in have]
    if missing:
        raise ValueError(f"layer has no band {missing}")
    rest = [c for c in df.columns if c not in have]
    return df.select(*rest, *[F.col(f"b{k}").alias(f"b{n}") for n, k in enumerate(chosen)])


def bands_by_name(names: str | Sequence[str], band_names: Sequence[str] = BAND_NAMES) -> list[int]:
    """Band numbers of known names; none known gives 0, 1, 2."""
    items = names.split(",") if isinstance(names, str) else list(names)
    index = {n: k for k, n in enumerate(band_names)}
    return [index[n] for n in items if n in index] or [0, 1, 2]


def select_bands_by_name(
    df: DataFrame, names: str | Sequence[str], band_names: Sequence[str] = BAND_NAMES
) -> DataFrame:
    return select_bands(df, bands_by_name(names, band_names))


# ---------------------------------------------------------------------- filters
def key_range(tiles: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    """Tiles in the key range of a map box.

    Literal ranges on ``col`` and ``row`` reach the Parquet scan, where the
    Z-order clustering of the files makes their statistics selective.
    """
    x0, y0, x1, y1 = box_keys(grid, box)
    return tiles.where(F.col("col").between(x0, x1) & F.col("row").between(y0, y1))


def box_keys(grid: Grid, box: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
    """Inclusive tile-key range whose closed extents touch a closed map box."""
    tw, th = grid.tile * grid.cw, grid.tile * grid.ch
    xmin, ymin, xmax, ymax = box
    return (
        math.ceil((xmin - grid.ox) / tw) - 1, math.ceil((grid.oy - ymax) / th) - 1,
        math.floor((xmax - grid.ox) / tw), math.floor((grid.oy - ymin) / th),
    )


def filter_intersects(tiles: DataFrame, polygon: geo.Rings, grid: Grid) -> DataFrame:
    """Tiles whose extent meets the polygon.  Narrow: no join, no shuffle."""
    near = key_range(tiles, grid, geo.envelope_of(polygon))
    edges = geo.edges_literal(polygon)
    box = grid.key_extent(F.col("col"), F.col("row"))
    return near.where(geo.box_relation(edges, box) != "outside")


def polygon_keys(polygons: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """(.., col, row, relation, edges) for each tile a polygon meets.

    ``edges`` keeps the edges that can matter inside that tile's rows, so long
    outlines are not copied whole to every tile.
    """
    tw, th = grid.tile * grid.cw, grid.tile * grid.ch
    rest = [c for c in polygons.columns if c != rings]
    base = polygons.select(
        *rest,
        geo.polygon_envelope(F.col(rings)).alias("_env"),
        geo.polygon_edges(F.col(rings)).alias("_edges"),
    )

    def span(lo: Column, hi: Column, step: float, limit: int | None) -> Column:
        first = F.greatest((F.ceil(lo / step) - 1).cast("int"), F.lit(0))
        last = F.floor(hi / step).cast("int")
        if limit is not None:
            last = F.least(last, F.lit((limit - 1) // grid.tile))
        return F.when(first <= last, F.sequence(first, last))

    env = F.col("_env")
    rows = base.withColumn(
        "row",
        F.explode(span(F.lit(grid.oy) - env["ymax"], F.lit(grid.oy) - env["ymin"], th, grid.height)),
    ).withColumn("_band", grid.key_extent(F.lit(0), F.col("row")))
    # Only edges that reach a tile row matter in it.  Rows of one polygon are
    # spread over the tasks, so a polygon over very many tiles does not hold up
    # a single one.
    rows = spread(
        rows.select(
            *rest, "row", "_env",
            F.filter(
                "_edges",
                lambda e: (F.greatest(e["y1"], e["y2"]) >= F.col("_band.ymin"))
                & (F.least(e["y1"], e["y2"]) <= F.col("_band.ymax")),
            ).alias("_near"),
        ),
        *rest, "row",
    )
    keys = rows.withColumn(
        "col",
        F.explode(span(env["xmin"] - F.lit(grid.ox), env["xmax"] - F.lit(grid.ox), tw, grid.width)),
    )
    box = grid.key_extent(F.col("col"), F.col("row"))
    related = keys.withColumn("_box", box).withColumn(
        "relation", geo.box_relation(F.col("_near"), F.col("_box"))
    ).where(F.col("relation") != "outside")
    right_of = F.filter("_near", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("_box.xmin"))
    return related.select(
        *rest, "col", "row", "relation",
        F.when(F.col("relation") == "edge", right_of).alias("edges"),
    )


def polygons_join_tiles(polygons: DataFrame, tiles: DataFrame, grid: Grid, ident: str, **options) -> DataFrame:
    """All (polygon, tile) pairs that intersect, with the tile's bands masked."""
    bands = band_columns(tiles)
    keys = polygon_keys(polygons.select(ident, "rings"), grid)
    joined = join_tiles(keys, tiles.select("col", "row", *bands), ident, **options)
    return mask_joined(joined, grid, bands).drop("edges", "relation")


# ------------------------------------------------------------------------ masks
def mask_joined(df: DataFrame, grid: Grid, bands: Sequence[str]) -> DataFrame:
    """Mask tiles that carry their polygon's ``edges`` and ``relation``.

    Tiles wholly inside pass unchanged; only boundary tiles are tested, once
    for all bands.
    """
    bounded_batches(df.select(*bands), grid.tile * grid.tile)
    box = grid.key_extent(F.col("col"), F.col("row"))
    # A ray to the right only meets edges that reach past the left side.
    near = F.filter(
        "edges",
        lambda e: (F.greatest(e["y1"], e["y2"]) >= box["ymin"])
        & (F.least(e["y1"], e["y2"]) <= box["ymax"])
        & (F.greatest(e["x1"], e["x2"]) >= box["xmin"]),
    )
    whole = F.coalesce(F.col("relation") == "inside", F.lit(False))
    side = F.lit(grid.tile)
    inputs = {
        "whole": whole, "edges": F.when(~whole, near), "cols": side, "rows": side,
        "left": box["xmin"], "top": box["ymax"],
    }
    return map_bands(df, bands, inputs, masked(grid.cw, grid.ch))


def mask_tiles(tiles: DataFrame, polygon: geo.Rings, grid: Grid) -> DataFrame:
    """NoData for cells whose centre is outside the polygon; tiles that do not
    meet it are left out."""
    edges = geo.edges_literal(polygon)
    box = grid.key_extent(F.col("col"), F.col("row"))
    near = key_range(tiles, grid, geo.envelope_of(polygon)).withColumns(
        {"relation": geo.box_relation(edges, box)}
    ).where(F.col("relation") != "outside")
    return mask_joined(near.withColumn("edges", edges), grid, band_columns(tiles)).drop(
        "edges", "relation"
    )


def mask_pixels(pixels: DataFrame, polygon: geo.Rings, grid: Grid) -> DataFrame:
    """The same in pixel form: rows outside are NoData and hence absent.

    The envelope becomes a literal range on x and y.
    """
    x0, y0, x1, y1 = grid.bounds_of(*geo.envelope_of(polygon))
    near = pixels.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))
    cx, cy = grid.centre_x(F.col("x")), grid.centre_y(F.col("y"))
    edges = geo.edges_of(polygon)
    inside = (
        geo.contains_point_const(polygon, cx, cy)
        if len(edges) <= UNROLL_EDGES
        else geo.contains_point(geo.edges_literal(polygon), cx, cy)
    )
    return near.where(inside)


# ------------------------------------------------------------------------ crops
def crop_layer(tiles: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    """Crop a layer to a map box: pieces with global bounds, one per tile.

    Stays distributed: a piece is a sliced tile with its offset ``px, py``
    inside the crop.
    """
    x0, y0, x1, y1 = grid.bounds_of(*box)
    t = grid.tile
    near = tiles.where(
        F.col("col").between(x0 // t, x1 // t) & F.col("row").between(y0 // t, y1 // t)
    )
    left = F.greatest(F.col("col").cast("bigint") * t, F.lit(x0))
    top = F.greatest(F.col("row").cast("bigint") * t, F.lit(y0))
    w = (F.least((F.col("col").cast("bigint") + 1) * t - 1, F.lit(x1)) - left + 1).cast("int")
    h = (F.least((F.col("row").cast("bigint") + 1) * t - 1, F.lit(y1)) - top + 1).cast("int")
    return near.select(
        "col", "row",
        *[F.lit(v).cast("bigint").alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))],
        (left - x0).cast("int").alias("px"), (top - y0).cast("int").alias("py"),
        w.alias("w"), h.alias("h"),
        *[
            crop_cells(F.col(b), F.lit(t), left - F.col("col") * t, top - F.col("row") * t, w, h).alias(b)
            for b in band_columns(tiles)
        ],
    )


def crop_pixels(pixels: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    x0, y0, x1, y1 = grid.bounds_of(*box)
    return pixels.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


# --------------------------------------------------------------------- extracts
def as_polygon(polygon: str | geo.Rings, polygon_crs: str, crs: str) -> geo.Rings:
    """A query polygon (GeoJSON text or rings) in the layer's CRS."""
    rings = geo.rings_from_geojson(polygon) if isinstance(polygon, str) else polygon
    return geo.reproject_rings(rings, polygon_crs, crs)


def extract(
    tiles: DataFrame,
    grid: Grid,
    polygon: str | geo.Rings | None = None,
    bands: str | Sequence[int] | None = None,
    polygon_crs: str = "EPSG:4326",
) -> DataFrame:
    """Polygon extract of a layer: filter, mask, choose bands, crop.

    Returns the pieces of the extract (see ``crop_layer``); without a polygon
    those of the whole layer.  Bands are chosen first, so masks run on those
    only.
    """
    chosen = select_bands(tiles, bands)
    if polygon is None:
        return crop_layer(chosen, grid, grid.extent)
    rings = as_polygon(polygon, polygon_crs, grid.crs)
    return crop_layer(mask_tiles(chosen, rings, grid), grid, geo.envelope_of(rings))


def get_tile(tiles: DataFrame, col: int, row: int) -> DataFrame:
    """One tile by key; an unknown key gives an empty result.

    The Z-order value is matched too: files are sorted by it, so the lookup
    reads single row groups.
    """
    found = tiles.where((F.col("col") == col) & (F.col("row") == row))
    return found.where(F.col("z") == zorder_of(col, row)) if "z" in tiles.columns else found


def tile_view(
    tiles: DataFrame,
    grid: Grid,
    col: int,
    row: int,
    bands: str | Sequence[str] = "R,G,B",
    polygon: str | geo.Rings | None = None,
    polygon_crs: str = "EPSG:4326",
    band_names: Sequence[str] = BAND_NAMES,
) -> DataFrame:
    """One tile with the named bands, masked by an optional polygon.

    A tile outside the polygon is all NoData, not absent.
    """
    found = select_bands_by_name(get_tile(tiles, col, row), bands, band_names)
    if polygon is None:
        return found
    rings = as_polygon(polygon, polygon_crs, grid.crs)
    edges = geo.edges_literal(rings)
    box = grid.key_extent(F.col("col"), F.col("row"))
    tagged = found.withColumns({"relation": geo.box_relation(edges, box), "edges": edges})
    return mask_joined(tagged, grid, band_columns(found)).drop("relation", "edges")
