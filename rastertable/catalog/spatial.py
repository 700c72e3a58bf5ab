"""Queries on bands, polygons, projections, tile keys, numbering and overviews."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rastertable.catalog import fixtures as X
from rastertable.catalog.cells import exploded
from rastertable.catalog.registry import query
from rastertable.functions import geo
from rastertable.grid import WORLD_HALF, Grid, zorder
from rastertable.operators import extract, index, layout
from rastertable.operators.joins import join_tiles

BOX = (366100.0, 5808100.0, 366300.0, 5808400.0)


# -------------------------------------------------------------------------- bands
@query("select_bands", f"WITH {X.LP} SELECT x, y, b3 AS b0, b1 AS b1 FROM lp")
def select_bands(spark, sf):
    return extract.select_bands(X.lp_pixels(spark, sf), "3.1")


@query("select_bands_by_name", f"WITH {X.LP} SELECT x, y, b3 AS b0, b0 AS b1 FROM lp")
def select_bands_by_name(spark, sf):
    """Unknown names are skipped."""
    return extract.select_bands_by_name(X.lp_pixels(spark, sf), "IR,??,R", X.BANDS4)


@query("select_bands_default", f"WITH {X.LP} SELECT x, y, b0, b1, b2 FROM lp")
def select_bands_default(spark, sf):
    """No known name: the first three bands."""
    return extract.select_bands_by_name(X.lp_pixels(spark, sf), "??", X.BANDS4)


# ----------------------------------------------------------------------- polygons
@query(
    "parse_geojson",
    f"""WITH {X.POLYGONS} SELECT poly_id, CAST(0 AS INTEGER) AS ring, idx, px, py FROM pv
    UNION ALL SELECT poly_id, 0, 4, px, py FROM pv WHERE idx = 0""",
)
def parse_geojson(spark, sf):
    return (
        X.polygons(spark, sf)
        .select("poly_id", F.posexplode("rings").alias("ring", "pts"))
        .select("poly_id", "ring", F.posexplode("pts").alias("idx", "p"))
        .select("poly_id", "ring", "idx", F.get("p", F.lit(0)).alias("px"), F.get("p", F.lit(1)).alias("py"))
    )


_ENV = "SELECT poly_id, min(px) AS xmin, min(py) AS ymin, max(px) AS xmax, max(py) AS ymax FROM pv GROUP BY poly_id"


@query("polygon_envelope", f"WITH {X.POLYGONS} {_ENV}")
def polygon_envelope(spark, sf):
    return X.polygons(spark, sf).select("poly_id", geo.polygon_envelope(F.col("rings")).alias("e")).select("poly_id", "e.*")


@query(
    "extent_polygon",
    f"""WITH {X.POLYGONS}, e AS ({_ENV}) SELECT poly_id, CAST(5 AS INTEGER) AS n_points,
    (xmax - xmin) * (ymax - ymin) AS area FROM e""",
)
def extent_polygon(spark, sf):
    """Envelope -> ring -> edges; the shoelace area is that of the box."""
    ring = X.polygons(spark, sf).select(
        "poly_id", geo.extent_polygon(geo.polygon_envelope(F.col("rings"))).alias("r")
    )
    edges = geo.polygon_edges(F.col("r"))
    area = F.aggregate(
        edges, F.lit(0.0),
        lambda a, e: a + (e["x2"] - 366000.0) * (e["y1"] - 5808000.0) - (e["x1"] - 366000.0) * (e["y2"] - 5808000.0),
    )
    return ring.select("poly_id", F.size(F.get("r", F.lit(0))).alias("n_points"), (area / 2).alias("area"))


@query(
    "combine_extents",
    f"""WITH {X.POLYGONS}, e AS ({_ENV}) SELECT poly_id, least(xmin, 366100.0)::DOUBLE AS xmin,
    least(ymin, 5808100.0)::DOUBLE AS ymin, greatest(xmax, 366300.0)::DOUBLE AS xmax, greatest(ymax, 5808400.0)::DOUBLE AS ymax FROM e""",
)
def combine_extents(spark, sf):
    fixed = F.struct(*[F.lit(v).alias(n) for n, v in zip(("xmin", "ymin", "xmax", "ymax"), BOX)])
    both = geo.combine_extents(geo.polygon_envelope(F.col("rings")), fixed)
    return X.polygons(spark, sf).select("poly_id", both.alias("e")).select("poly_id", "e.*")


# A closed box (bx0, by0, bx1, by1) meets an edge: overlap of both projections
# and corners not all on one side.
_MEETS = """(least(ex1, ex2) <= bx1 AND greatest(ex1, ex2) >= bx0 AND least(ey1, ey2) <= by1 AND greatest(ey1, ey2) >= by0
    AND abs((ex2 - ex1) * ((by0 + by1) / 2 - ey1) - (ey2 - ey1) * ((bx0 + bx1) / 2 - ex1))
        <= (bx1 - bx0) / 2 * abs(ey2 - ey1) + (by1 - by0) / 2 * abs(ex2 - ex1))"""
_INSIDE = X.CROSSES.replace("ccy", "((by0 + by1) / 2)").replace("ccx", "((bx0 + bx1) / 2)")
_TILE_BOX = f"""tb AS (SELECT col, row, CAST({X.OX} + col * 32 AS DOUBLE) AS bx0, CAST({X.OY} - (row + 1) * 32 AS DOUBLE) AS by0,
    CAST({X.OX} + (col + 1) * 32 AS DOUBLE) AS bx1, CAST({X.OY} - row * 32 AS DOUBLE) AS by1 FROM tk)"""


@query(
    "filter_intersects",
    f"""WITH {X.LP}, {X.TILES}, {X.POLY_EDGES}, {_TILE_BOX}
    SELECT col, row FROM tb, pe GROUP BY col, row HAVING bool_or({_MEETS}) OR count(*) FILTER (WHERE {_INSIDE}) % 2 = 1""",
)
def filter_intersects(spark, sf):
    grid = X.lp_grid(spark, sf)
    keys = X.lp_tiles(spark, sf).select("col", "row")
    return extract.filter_intersects(keys, X.POLY, grid)


@query(
    "polygon_tile_join",
    f"""WITH {X.POLYGONS}, {X.LP}, {X.TILES}, {_TILE_BOX}
    SELECT poly_id, col, row FROM tb, pe GROUP BY poly_id, col, row
    HAVING bool_or({_MEETS}) OR count(*) FILTER (WHERE {_INSIDE}) % 2 = 1""",
)
def polygon_tile_join(spark, sf):
    keys = extract.polygon_keys(X.polygons(spark, sf), X.lp_grid(spark, sf))
    tiles = X.lp_tiles(spark, sf).select("col", "row")
    return join_tiles(keys, tiles, "poly_id").select("poly_id", "col", "row")


_ALL = [f"b{k}" for k in range(4)]
_LIST = ", ".join(_ALL)


@query(
    "polygon_zones",
    f"""WITH {X.POLYGONS}, {X.LP}, e AS ({_ENV}),
    c AS (SELECT poly_id, {_LIST}, x, y, ({X.OX} + (x + 0.5) * {X.CELL})::DOUBLE AS ccx, ({X.OY} - (y + 0.5) * {X.CELL})::DOUBLE AS ccy
          FROM e JOIN lp ON ({X.OX} + (x + 0.5) * {X.CELL}) BETWEEN xmin AND xmax AND ({X.OY} - (y + 0.5) * {X.CELL}) BETWEEN ymin AND ymax),
    i AS (SELECT c.poly_id, x, y, {_LIST} FROM c JOIN pe ON c.poly_id = pe.poly_id GROUP BY c.poly_id, x, y, {_LIST}
          HAVING count(*) FILTER (WHERE {X.CROSSES}) % 2 = 1)
    SELECT poly_id, count(*) AS n, {", ".join(f"CAST(sum({b}) AS BIGINT) AS sum_{b}" for b in _ALL)} FROM i GROUP BY poly_id""",
)
def polygon_zones(spark, sf):
    """Masked cells of every (polygon, tile) pair, all bands summed per polygon."""
    masked = extract.polygons_join_tiles(X.polygons(spark, sf), X.lp_tiles(spark, sf), X.lp_grid(spark, sf), "poly_id")
    cells = exploded(masked.select("poly_id", *_ALL), *_ALL).where("b0 IS NOT NULL")
    return cells.groupBy("poly_id").agg(F.count("*").alias("n"), *[F.sum(b).alias(f"sum_{b}") for b in _ALL])


_MASKED = f"""WITH {X.LP}, {X.POLY_EDGES}, c AS (SELECT x, y, {_LIST}, {X.CENTRES} FROM lp),
    i AS (SELECT x, y, {_LIST} FROM c, pe GROUP BY x, y, {_LIST} HAVING count(*) FILTER (WHERE {X.CROSSES}) % 2 = 1)"""


@query("mask_polygon", f"{_MASKED} SELECT x, y, {_LIST} FROM i")
def mask_polygon(spark, sf):
    px = extract.mask_pixels(X.lp_pixels(spark, sf), X.POLY, X.lp_grid(spark, sf))
    return px.select("x", "y", *_ALL)


@query("mask_polygon_tiles", f"{_MASKED} SELECT x, y, {_LIST} FROM i")
def mask_polygon_tiles(spark, sf):
    masked = extract.mask_tiles(X.lp_tiles(spark, sf), X.POLY, X.lp_grid(spark, sf))
    return layout.tiles_to_pixels(masked, X.TILE).select("x", "y", *_ALL)


@query(
    "crop_extent",
    f"WITH {X.LP} SELECT x, y, {_LIST} FROM lp WHERE x BETWEEN 200 AND 599 AND y BETWEEN 224 AND 823",
)
def crop_extent(spark, sf):
    """Crop to a map box, in tile form; cell bounds follow the crop rule."""
    return _piece_pixels(extract.crop_layer(X.lp_tiles(spark, sf), X.lp_grid(spark, sf), BOX), _ALL)


def _piece_pixels(pieces, bands):
    cells = exploded(pieces.select("x0", "y0", "px", "py", "w", *bands), *bands).where(f"{bands[0]} IS NOT NULL")
    return cells.select(
        (F.col("x0") + F.col("px") + F.col("k") % F.col("w")).alias("x"),
        (F.col("y0") + F.col("py") + F.floor(F.col("k") / F.col("w"))).alias("y"),
        *bands,
    )


@query("extract_polygon", f"{_MASKED} SELECT x, y, b3 AS b0 FROM i")
def extract_polygon(spark, sf):
    """Filter, mask, band choice and crop of one polygon."""
    pieces = extract.extract(
        X.lp_tiles(spark, sf), X.lp_grid(spark, sf), X.POLY, "3", polygon_crs="EPSG:32633"
    )
    return _piece_pixels(pieces, ["b0"])


@query(
    "tile_view",
    f"{_MASKED} SELECT x, y, b3 AS b0 FROM i WHERE x // 64 = 4 AND y // 64 = 4",
)
def tile_view(spark, sf):
    """One tile, one named band, masked."""
    view = extract.tile_view(
        X.lp_tiles(spark, sf), X.lp_grid(spark, sf), 4, 4, "IR", X.POLY, "EPSG:32633", X.BANDS4
    )
    return layout.tiles_to_pixels(view.select("col", "row", "b0"), X.TILE).select("x", "y", "b0")


@query("point_lookup", f"WITH {X.LP} SELECT x, y, b0, b1, b2, b3 FROM lp WHERE x // 64 = 3 AND y // 64 = 9")
def point_lookup(spark, sf):
    tile = extract.get_tile(X.lp_tiles(spark, sf), 3, 9)
    return layout.tiles_to_pixels(tile.select("col", "row", "b0", "b1", "b2", "b3"), X.TILE)


# -------------------------------------------------------------------- projections
def _milli(c):
    return F.floor(c * 1000 + F.lit(0.5)).alias


@query(
    "project_web_mercator",
    f"""WITH {X.LONLAT} SELECT id, CAST(floor(radians(lon) * 6378137 * 1000 + 0.5) AS BIGINT) AS mx,
    CAST(floor(ln(tan(radians(lat) / 2 + pi() / 4)) * 6378137 * 1000 + 0.5) AS BIGINT) AS my FROM ll""",
)
def project_web_mercator(spark, sf):
    x, y = geo.project(F.col("lon"), F.col("lat"), "EPSG:3857")
    return X.lonlat(spark, sf).select("id", _milli(x)("mx"), _milli(y)("my"))


def _tm_sql(source: str, keys: str) -> str:
    """CTEs from (lon, lat) in ``source`` to UTM zone 33 columns ux, uy."""
    e, radius, fwd, _, _ = geo._krueger()
    d = "CAST({!r} AS DOUBLE)".format
    xs = "".join(f" + cos(xi * {2 * j}) * sinh(eta * {2 * j}) * {d(a)}" for j, a in enumerate(fwd, 1))
    ys = "".join(f" + sin(xi * {2 * j}) * cosh(eta * {2 * j}) * {d(a)}" for j, a in enumerate(fwd, 1))
    return f"""
    t1 AS (SELECT {keys}, radians(lon) - {d(math.radians(15))} AS dl, sin(radians(lat)) AS sp FROM {source}),
    t2 AS (SELECT {keys}, dl, sinh(atanh(sp) - atanh(sp * {d(e)}) * {d(e)}) AS t FROM t1),
    t3 AS (SELECT {keys}, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(t * t + 1)) AS eta FROM t2),
    utm AS (SELECT {keys}, (eta{xs}) * {d(geo.UTM_K0 * radius)} + 500000 AS ux, (xi{ys}) * {d(geo.UTM_K0 * radius)} AS uy FROM t3)"""


@query(
    "project_utm33",
    f"""WITH {X.LONLAT}, {_tm_sql('ll', 'id')} SELECT id, CAST(floor(ux * 1000 + 0.5) AS BIGINT) AS ux,
    CAST(floor(uy * 1000 + 0.5) AS BIGINT) AS uy FROM utm""",
)
def project_utm33(spark, sf):
    there = geo.reproject_columns(
        X.lonlat(spark, sf), F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:32633", ("x", "y")
    )
    return there.select("id", _milli(F.col("x"))("ux"), _milli(F.col("y"))("uy"))


@query(
    "unproject_utm33",
    f"""WITH {X.LONLAT} SELECT id, CAST(floor(lon * 10000000 + 0.5) AS BIGINT) AS lon7,
    CAST(floor(lat * 10000000 + 0.5) AS BIGINT) AS lat7 FROM ll""",
)
def unproject_utm33(spark, sf):
    """Forward and back again: the original coordinates to 1e-7 degree."""
    there = geo.reproject_columns(
        X.lonlat(spark, sf), F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:32633", ("x", "y")
    )
    back = geo.reproject_columns(
        there, F.col("x"), F.col("y"), "EPSG:32633", "EPSG:4326", ("lon2", "lat2")
    )
    return back.select(
        "id", F.floor(F.col("lon2") * 10000000 + 0.5).alias("lon7"),
        F.floor(F.col("lat2") * 10000000 + 0.5).alias("lat7"),
    )


# --------------------------------------------------------------------------- keys
@query(
    "key_extent",
    f"WITH {X.LP}, {X.TILES}, {_TILE_BOX} SELECT col, row, bx0 AS xmin, by0 AS ymin, bx1 AS xmax, by1 AS ymax FROM tb",
)
def key_extent(spark, sf):
    grid = X.lp_grid(spark, sf)
    keys = X.lp_tiles(spark, sf).select("col", "row")
    return keys.select("col", "row", grid.key_extent(F.col("col"), F.col("row")).alias("e")).select(
        "col", "row", "e.*"
    )


_Z = " + ".join(
    f"((col >> {b}) & 1) * {1 << (2 * b)} + ((row >> {b}) & 1) * {1 << (2 * b + 1)}" for b in range(14)
)
_ZKEYS = f"WITH {X.LP}, {X.TILES}, zk AS (SELECT col, row, CAST({_Z} AS BIGINT) AS z FROM tk)"


@query("zorder_key", f"{_ZKEYS} SELECT col, row, z FROM zk")
def zorder_key(spark, sf):
    keys = X.lp_tiles(spark, sf).select("col", "row")
    return keys.withColumn("z", zorder(F.col("col"), F.col("row")))


@query("with_index", f"{_ZKEYS} SELECT col, row, row_number() OVER (ORDER BY z) - 1 AS idx FROM zk")
def with_index(spark, sf):
    return index.with_index(X.lp_tiles(spark, sf).select("col", "row"))


@query(
    "indexed_tiles",
    f"""{_ZKEYS}, i AS (SELECT col, row, row_number() OVER (ORDER BY z) - 1 AS idx FROM zk),
    t AS (SELECT x // 64 AS col, y // 64 AS row, {", ".join(f"CAST(sum({b}) AS BIGINT) AS sum_{b}" for b in _ALL)}
          FROM lp GROUP BY 1, 2)
    SELECT i.col, i.row, idx, {", ".join(f"sum_{b}" for b in _ALL)} FROM i JOIN t ON i.col = t.col AND i.row = t.row""",
)
def indexed_tiles(spark, sf):
    """Numbers of whole tiles, with the sum of every band."""
    zero = F.lit(0).cast("bigint")
    sums = [
        F.aggregate(b, zero, lambda a, v: a + F.coalesce(v.cast("bigint"), zero)).alias(f"sum_{b}")
        for b in _ALL
    ]
    return index.with_index(X.lp_tiles(spark, sf)).select("col", "row", "idx", *sums)


@query(
    "batch_select",
    f"""{_ZKEYS}, i AS (SELECT col, row, row_number() OVER (ORDER BY z) - 1 AS idx FROM zk),
    t AS (SELECT x // 64 AS col, y // 64 AS row, CAST(sum(b0) AS BIGINT) AS sum_b0 FROM lp GROUP BY 1, 2)
    SELECT i.col, i.row, sum_b0 FROM i JOIN t ON i.col = t.col AND i.row = t.row WHERE idx % 3 = 1""",
)
def batch_select(spark, sf):
    chosen = index.batch(X.lp_tiles(spark, sf), 3, 1)
    zero = F.lit(0).cast("bigint")
    total = F.aggregate("b0", zero, lambda a, v: a + F.coalesce(v.cast("bigint"), zero))
    return chosen.select("col", "row", total.alias("sum_b0"))


# --------------------------------------------------------------------- resolutions
@query(
    "pyramid_level",
    f"WITH {X.LP} SELECT x // 4 AS x, y // 4 AS y, {_LIST} FROM lp WHERE x % 4 = 0 AND y % 4 = 0",
)
def pyramid_level(spark, sf):
    tiles = layout.pyramid_level(X.lp_tiles(spark, sf), X.TILE, 2)
    return layout.tiles_to_pixels(tiles, X.TILE).select("x", "y", *_ALL)


@query(
    "pyramid_pixels",
    f"WITH {X.LP} SELECT x // 8 AS x, y // 8 AS y, b0, b1, b2, b3 FROM lp WHERE x % 8 = 0 AND y % 8 = 0",
)
def pyramid_pixels(spark, sf):
    return layout.pyramid_pixels(X.lp_pixels(spark, sf), 3)


_ZOOM = 17
_ZC = 2 * WORLD_HALF / (256 * 2**_ZOOM)


@query(
    "zoomed_layout",
    f"""WITH {X.LP}, c AS (SELECT b0, {X.CENTRES} FROM lp)
    SELECT CAST(floor((CAST(ccx AS DOUBLE) - CAST({-WORLD_HALF!r} AS DOUBLE)) / CAST({256 * _ZC!r} AS DOUBLE)) AS INTEGER) AS col,
    CAST(floor((CAST({WORLD_HALF!r} AS DOUBLE) - CAST(ccy AS DOUBLE)) / CAST({256 * _ZC!r} AS DOUBLE)) AS INTEGER) AS row,
    count(*) AS n, CAST(sum(b0) AS BIGINT) AS sum_b0 FROM c GROUP BY 1, 2""",
)
def zoomed_layout(spark, sf):
    """Web-grid keys of cell centres, read as world metres."""
    grid, world = X.lp_grid(spark, sf), Grid.zoomed(_ZOOM)
    col, row = world.key_of(grid.centre_x(F.col("x")), grid.centre_y(F.col("y")))
    return X.lp_pixels(spark, sf).groupBy(col.alias("col"), row.alias("row")).agg(
        F.count("*").alias("n"), F.sum("b0").alias("sum_b0")
    )


def _target_range() -> tuple[int, int, int, int, int]:
    """Web-grid cells around one sheet: x from/to, y from/to, rows per sheet."""
    world = Grid.zoomed(_ZOOM)
    corners = [
        geo.reproject(x, y, "EPSG:32633", "EPSG:3857", geo.NUM)
        for x in (X.OX, X.OX + 512) for y in (X.OY, X.OY - 512)
    ]
    xs = [math.floor((p[0] - world.ox) / world.cw) for p in corners]
    ys = [math.floor((world.oy - p[1]) / world.ch) for p in corners]
    return min(xs) - 900, max(xs) + 900, min(ys) - 600, max(ys) + 600, math.ceil(900 / world.ch)


_TX0, _TX1, _TY0, _TY1, _PER = _target_range()


_REPROJECT = f"""WITH {X.LP}, {X.SHEETS}, gx AS (SELECT unnest(range({_TX0}, {_TX1})) AS tx),
    gy AS (SELECT unnest(range({_TY0}, {_TY1} + s * {_PER})) AS ty FROM sh),
    m AS (SELECT tx, ty, CAST({-WORLD_HALF!r} AS DOUBLE) + (tx + CAST(0.5 AS DOUBLE)) * CAST({_ZC!r} AS DOUBLE) AS mx,
          CAST({WORLD_HALF!r} AS DOUBLE) - (ty + CAST(0.5 AS DOUBLE)) * CAST({_ZC!r} AS DOUBLE) AS my FROM gx, gy),
    ll AS (SELECT tx, ty, degrees(mx / 6378137) AS lon, degrees(atan(exp(my / 6378137)) * 2 - pi() / 2) AS lat FROM m),
    {_tm_sql('ll', 'tx, ty')},
    s AS (SELECT tx, ty, CAST(floor((ux - {X.OX}) / {X.CELL}) AS BIGINT) AS x, CAST(floor(({X.OY} - uy) / {X.CELL}) AS BIGINT) AS y FROM utm)
    SELECT tx AS x, ty AS y, {_LIST} FROM s JOIN lp ON s.x = lp.x AND s.y = lp.y"""


@query("reproject_nn", _REPROJECT)
def reproject_nn(spark, sf):
    """The large raster resampled to the web grid."""
    source, target = X.lp_grid(spark, sf), Grid.zoomed(_ZOOM)
    tiles = X.lp_tiles(spark, sf)
    keys = layout.target_keys_for(tiles.select("col", "row"), source, target)
    out = layout.reproject_nn(tiles, source, target, keys)
    return layout.tiles_to_pixels(out, target.tile).select("x", "y", *_ALL)


_LEVELS = 5


@query(
    "zoomed_levels",
    f"""WITH base AS ({_REPROJECT}), k AS (SELECT unnest(range(0, {_LEVELS})) AS up)
    SELECT CAST({_ZOOM} - up AS INTEGER) AS zoom, x >> up AS x, y >> up AS y, {_LIST}
    FROM base, k WHERE x % (1 << up) = 0 AND y % (1 << up) = 0""",
)
def zoomed_levels(spark, sf):
    """The web layer of the large raster with its overviews, cell by cell."""
    source, target = X.lp_grid(spark, sf), Grid.zoomed(_ZOOM)
    tiles = X.lp_tiles(spark, sf)
    keys = layout.target_keys_for(tiles.select("col", "row"), source, target)
    web = layout.zoomed_levels(layout.reproject_nn(tiles, source, target, keys), target.tile, _ZOOM, _LEVELS)
    return layout.tiles_to_pixels(web, target.tile).select("zoom", "x", "y", *_ALL)
