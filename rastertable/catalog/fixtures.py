"""Raster inputs derived by Spark from the driver tables, and the same in SQL.

``px``  scenes of 11 bands from ``embeddings`` (8 x 8 cells, one block per row);
``lp``  a large sparse 4-band raster from ``lineitem``, growing southward by one
        1024-row sheet per 16384 order keys;
windows one 16 x 16 draw per row of ``customer``;
polygons one quadrilateral per row of ``supplier``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.functions.geo import parse_geojson
from rastertable.grid import Grid
from rastertable.operators.layout import pixels_to_tiles
from rastertable.operators.windows import (
    distinct_windows, lcg_uniform, number_windows, random_windows,
)
from rastertable.sources.scenes import parse_scene_key, source_ordinal

DIRS = ("/data/ortho_rgbir", "/data/height", "/data/labels", "/data/labels_nb")
SCENE = 8
TILE = 64
SIDE = 1024
SHEET = 16384
WINDOW = 16
OX, OY, CELL = 366000.0, 5808512.0, 0.5
BANDS4 = ("R", "G", "B", "IR")

POLY = [[[366100.0, 5808100.0], [366300.0, 5808150.0], [366250.0, 5808400.0],
         [366120.0, 5808350.0], [366100.0, 5808100.0]]]


# Columns in use; declared, so that no job runs to infer a schema.
TABLES = {
    "embeddings": "vec_id bigint, embedding array<float>",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint",
    "supplier": "s_suppkey bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------------ scenes
def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block table as a source would deliver it: unrounded extents, no keys."""
    scene = F.floor(F.col("vec_id") / 11).cast("int")
    band = (F.col("vec_id") % 11).cast("int")
    src = F.when(band <= 3, 0).when(band == 4, 1).when(band <= 7, 2).otherwise(3)

    def dn(v: Column, k: Column) -> Column:
        return (
            F.when(band >= 8, F.when(v > 0, 255).otherwise(0))
            .when((scene == 0) & (band == 4), 100)
            .when((scene == 1) & band.isin(0, 3) & (k == 0), 0)
            .otherwise(F.floor((v.cast("double") + 1) * 127.5).cast("int"))
        )

    cells = F.transform("embedding", dn)
    i, j = 2 + scene % 6, 7 + F.floor(scene / 6).cast("int")
    name = (
        F.when(src == 0, F.format_string("img_%d_%d_rgbir.tif", i, j))
        .when(src == 1, F.format_string("dsm_%02d_%02d_norm.tif", i, j))
        .when(src == 2, F.format_string("img_%d_%d_label.tif", i, j))
        .otherwise(F.format_string("img_%d_%d_label_nb.tif", i, j))
    )
    left, top = F.lit(366000.04) + 4 * j, F.lit(5808000.06) - 4 * i
    good = src <= 1
    extent = F.struct(
        F.when(good, left).otherwise(0.0).alias("xmin"),
        F.when(good, top - 4).otherwise(0.0).alias("ymin"),
        F.when(good, left + 4).otherwise(float(SCENE)).alias("xmax"),
        F.when(good, top).otherwise(float(SCENE)).alias("ymax"),
    )
    # The height band is one column short.
    short = band == 4
    return table(spark, sf_dir, "embeddings").select(
        scene.alias("scene"), band.alias("scene_band"),
        F.get(F.array(*[F.lit(d) for d in DIRS]), src).alias("source_dir"),
        name.alias("file_name"), F.lit("EPSG:32633").alias("crs"), extent.alias("extent"),
        (band - F.get(F.array(*[F.lit(v) for v in (0, 4, 5, 8)]), src)).alias("band"),
        F.lit("int32").alias("cell_type"),
        F.when(short, SCENE - 1).otherwise(SCENE).alias("cols"), F.lit(SCENE).alias("rows"),
        F.lit(0).alias("block_x"), F.lit(0).alias("block_y"),
        F.when(short, F.filter(cells, lambda v, k: k % SCENE != SCENE - 1)).otherwise(cells).alias("cells"),
    )


def px_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after the scan step: source ordinal, scene key, rounded extent."""
    from rastertable.functions.geo import round_extent

    df = raw_blocks(spark, sf_dir).withColumn("src", source_ordinal(F.col("source_dir"), DIRS))
    df = df.withColumn("extent", round_extent(F.col("extent")))
    return parse_scene_key(df)


def px_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, band, k, x, y, dn) with k on the 8 x 8 grid."""
    return (
        raw_blocks(spark, sf_dir)
        .select("scene", F.col("scene_band").alias("band"), "cols", F.posexplode("cells").alias("p", "dn"))
        .select(
            "scene", "band",
            (F.floor(F.col("p") / F.col("cols")) * SCENE + F.col("p") % F.col("cols")).cast("int").alias("k"),
            (F.col("p") % F.col("cols")).cast("int").alias("x"),
            F.floor(F.col("p") / F.col("cols")).cast("int").alias("y"),
            "dn",
        )
    )


PX = """
px_raw AS (SELECT vec_id // 11 AS scene, vec_id % 11 AS band,
                  unnest(range(0, 64)) AS k, unnest(embedding) AS v FROM embeddings),
px AS (SELECT CAST(scene AS INTEGER) AS scene, CAST(band AS INTEGER) AS band,
              CAST(k AS INTEGER) AS k, CAST(k % 8 AS INTEGER) AS x, CAST(k // 8 AS INTEGER) AS y,
              CAST(CASE WHEN band >= 8 THEN (CASE WHEN v > 0 THEN 255 ELSE 0 END)
                        WHEN scene = 0 AND band = 4 THEN 100
                        WHEN scene = 1 AND band IN (0, 3) AND k = 0 THEN 0
                        ELSE floor((CAST(v AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) END AS INTEGER) AS dn
       FROM px_raw WHERE NOT (band = 4 AND k % 8 = 7))"""

# Assembled scenes: one row per cell, missing cells and bands are zero.
SC = PX + """,
sc AS (SELECT scene, k, x, y, """ + ", ".join(
    f"coalesce(max(dn) FILTER (WHERE band = {b}), 0) AS b{b}" for b in range(11)
) + """ FROM px GROUP BY scene, k, x, y)"""

# File headers of the scenes.
FILES = """
fb AS (SELECT DISTINCT CAST(vec_id // 11 AS INTEGER) AS scene, CAST(vec_id % 11 AS INTEGER) AS band FROM embeddings),
f0 AS (SELECT scene, band, CASE WHEN band <= 3 THEN 0 WHEN band = 4 THEN 1 WHEN band <= 7 THEN 2 ELSE 3 END AS src FROM fb),
files AS (SELECT scene, src, CAST(2 + scene % 6 AS INTEGER) AS i, CAST(7 + scene // 6 AS INTEGER) AS j,
                 CAST(count(*) AS INTEGER) AS n_bands FROM f0 GROUP BY scene, src)"""

SPLITS_SQL = "splits(i, j, split) AS (VALUES {})"


def splits_sql() -> str:
    from rastertable.schema import SPLITS

    rows = ", ".join(f"({i}, {j}, '{n}')" for n, keys in SPLITS.items() for i, j in keys)
    return SPLITS_SQL.format(rows)


# ------------------------------------------------------------------ large raster
def lp_of(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(
        (F.col("l_orderkey") % SIDE).alias("x"),
        (F.col("l_partkey") % SIDE + SIDE * F.floor(F.col("l_orderkey") / SHEET)).alias("y"),
    ).agg(
        F.max("l_quantity").cast("int").alias("b0"),
        (F.max("l_linenumber") * 30).alias("b1"),
        F.round(F.max("l_discount") * 1000).cast("int").alias("b2"),
        F.floor(F.max("l_extendedprice") / 400).cast("int").alias("b3"),
    )


def lp_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lp_of(table(spark, sf_dir, "lineitem"))


def lp_sql(name: str = "lp", where: str = "") -> str:
    return f"""
{name} AS (SELECT l_orderkey % {SIDE} AS x, l_partkey % {SIDE} + {SIDE} * (l_orderkey // {SHEET}) AS y,
       CAST(trunc(max(l_quantity)) AS INTEGER) AS b0, CAST(max(l_linenumber) * 30 AS INTEGER) AS b1,
       CAST(round(max(l_discount) * 1000) AS INTEGER) AS b2,
       CAST(floor(max(l_extendedprice) / 400) AS INTEGER) AS b3
       FROM lineitem {where} GROUP BY 1, 2)"""


LP = lp_sql()


def sheets(spark: SparkSession, sf_dir: str) -> int:
    top = table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).first()[0]
    return (top or 0) // SHEET + 1


SHEETS = f"sh AS (SELECT max(l_orderkey) // {SHEET} + 1 AS s FROM lineitem)"


def lp_grid(spark: SparkSession, sf_dir: str) -> Grid:
    return Grid(OX, OY, CELL, CELL, TILE, SIDE, SIDE * sheets(spark, sf_dir))


def lp_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels_to_tiles(lp_pixels(spark, sf_dir), TILE)


# ----------------------------------------------------------------------- windows
def drawn_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = lp_grid(spark, sf_dir)
    draws = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("draw_id"))
    return random_windows(draws, grid.extent, WINDOW, grid, lcg_uniform)


def numbered_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct windows numbered from 0."""
    return number_windows(distinct_windows(drawn_windows(spark, sf_dir)))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows under their draw number."""
    return drawn_windows(spark, sf_dir).select(
        F.col("draw_id").alias("window_id"), "draw_id", "x0", "y0", "x1", "y1"
    )


def u_sql(ident: str, salt: int) -> str:
    return (
        f"(CAST((((({ident}) % 2147483647) * 48271 + {salt} * 16807 + 12345) * 69621) % 2147483647 AS DOUBLE)"
        " / CAST(2147483647 AS DOUBLE))"
    )


_W = (WINDOW - 1) * CELL
DRAWN = SHEETS + f""",
wd AS (SELECT CAST(c_custkey AS BIGINT) AS draw_id,
              {OX} + {u_sql('c_custkey', 1)} * CAST({SIDE * CELL - _W} AS DOUBLE) AS xmin,
              CAST({OY} - {SIDE * CELL} * s AS DOUBLE) + {u_sql('c_custkey', 2)} * CAST({SIDE * CELL} * s - {_W} AS DOUBLE) AS ymin,
              {SIDE} * s AS height FROM customer, sh),
we AS (SELECT draw_id, xmin, ymin, xmin + CAST({_W} AS DOUBLE) AS xmax, ymin + CAST({_W} AS DOUBLE) AS ymax, height FROM wd),
wb AS (SELECT draw_id, xmin, ymin, xmax, ymax,
              greatest(CAST(floor((xmin - {OX}) / {CELL}) AS BIGINT), 0) AS x0,
              greatest(CAST(floor(({OY} - ymax) / {CELL}) AS BIGINT), 0) AS y0,
              least(CAST(ceil((xmax - {OX}) / {CELL}) AS BIGINT) - 1, {SIDE - 1}) AS x1,
              least(CAST(ceil(({OY} - ymin) / {CELL}) AS BIGINT) - 1, height - 1) AS y1 FROM we)"""

WINDOWS = DRAWN + """,
w AS (SELECT draw_id AS window_id, draw_id, x0, y0, x1, y1 FROM wb)"""

NUMBERED = DRAWN + """,
w AS (SELECT row_number() OVER (ORDER BY draw_id) - 1 AS window_id, draw_id, x0, y0, x1, y1
      FROM (SELECT *, row_number() OVER (PARTITION BY xmin, ymin, xmax, ymax ORDER BY draw_id) AS r FROM wb)
      WHERE r = 1)"""

# Tiles of the large raster, and window cells with their place in the window.
TILES = f"tk AS (SELECT DISTINCT CAST(x // {TILE} AS INTEGER) AS col, CAST(y // {TILE} AS INTEGER) AS row FROM lp)"
WINDOW_CELLS = f"""
hit AS (SELECT DISTINCT w.* FROM w JOIN tk ON tk.col BETWEEN x0 // {TILE} AND x1 // {TILE}
        AND tk.row BETWEEN y0 // {TILE} AND y1 // {TILE}),
wc AS (SELECT w.window_id, w.draw_id, lp.x - w.x0 AS cx, lp.y - w.y0 AS cy, x1 - x0 + 1 AS cols, y1 - y0 + 1 AS rows,
              b0, b1, b2, b3
       FROM hit w JOIN lp ON lp.x BETWEEN w.x0 AND w.x1 AND lp.y BETWEEN w.y0 AND w.y1)"""


# ---------------------------------------------------------------------- polygons
def polygon_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(poly_id, geojson): a quadrilateral with whole-number corners."""
    s = sheets(spark, sf_dir)
    k = F.col("s_suppkey")
    cx = F.floor(F.lit(OX) + lcg_uniform(k, 6) * 512)
    cy = F.floor(F.lit(OY) - lcg_uniform(k, 7) * (512 * s))
    r = F.floor(lcg_uniform(k, 8) * 60) + 5
    pts = [(cx - r, cy - F.floor(r / 2)), (cx + r, cy - r), (cx + F.floor(r / 2), cy + r),
           (cx - F.floor(r / 2), cy + F.floor(r / 3))]
    text = [F.concat(F.lit("["), x, F.lit(","), y, F.lit("]")) for x, y in [*pts, pts[0]]]
    return table(spark, sf_dir, "supplier").select(
        k.cast("bigint").alias("poly_id"),
        F.concat(
            F.lit('{"type":"Polygon","coordinates":[['), F.concat_ws(",", *text), F.lit("]]}")
        ).alias("geojson"),
    )


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygon_text(spark, sf_dir).select("poly_id", parse_geojson(F.col("geojson")).alias("rings"))


POLYGONS = SHEETS + f""",
pc AS (SELECT CAST(s_suppkey AS BIGINT) AS poly_id,
              floor({OX} + {u_sql('s_suppkey', 6)} * 512) AS cx,
              floor({OY} - {u_sql('s_suppkey', 7)} * (512 * s)) AS cy,
              floor({u_sql('s_suppkey', 8)} * 60) + 5 AS r FROM supplier, sh),
pv AS (SELECT poly_id, CAST(0 AS INTEGER) AS idx, cx - r AS px, cy - floor(r / 2) AS py FROM pc
       UNION ALL SELECT poly_id, 1, cx + r, cy - r FROM pc
       UNION ALL SELECT poly_id, 2, cx + floor(r / 2), cy + r FROM pc
       UNION ALL SELECT poly_id, 3, cx - floor(r / 2), cy + floor(r / 3) FROM pc),
pe AS (SELECT a.poly_id, a.px AS ex1, a.py AS ey1, b.px AS ex2, b.py AS ey2 FROM pv a JOIN pv b
       ON a.poly_id = b.poly_id AND b.idx = (a.idx + 1) % 4)"""

POLY_EDGES = "pe(ex1, ey1, ex2, ey2) AS (VALUES " + ", ".join(
    f"(CAST({a[0]} AS DOUBLE), CAST({a[1]} AS DOUBLE), CAST({b[0]} AS DOUBLE), CAST({b[1]} AS DOUBLE))"
    for a, b in zip(POLY[0], POLY[0][1:])
) + ")"

CENTRES = f"({OX} + (x + 0.5) * {CELL}) AS ccx, ({OY} - (y + 0.5) * {CELL}) AS ccy"
CROSSES = "((ey1 > ccy) <> (ey2 > ccy)) AND ccx < (ex2 - ex1) * ((ccy - ey1) / (ey2 - ey1)) + ex1"


# ------------------------------------------------------------------------ points
def lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lon, lat) within three degrees of the central meridian."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("bigint").alias("id"),
        (F.lit(12.0) + lcg_uniform(k, 9) * 6).alias("lon"),
        (F.lit(50.0) + lcg_uniform(k, 10) * 4).alias("lat"),
    )


LONLAT = f"""ll AS (SELECT CAST(c_custkey AS BIGINT) AS id, 12.0 + {u_sql('c_custkey', 9)} * 6 AS lon,
       50.0 + {u_sql('c_custkey', 10)} * 4 AS lat FROM customer)"""
