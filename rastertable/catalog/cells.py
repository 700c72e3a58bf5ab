"""Queries on cell math, statistics, display values and grid transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.catalog import fixtures as X
from rastertable.catalog.registry import query
from rastertable.functions import cells as C
from rastertable.functions import tiles as K
from rastertable.operators import algebra, render
from rastertable.operators.assemble import assemble_scenes
from rastertable.operators.extract import select_bands
from rastertable.operators.joins import diff_layers
from rastertable.operators.layout import tiles_to_pixels

S = X.SCENE


def scene_tiles(spark, sf: str) -> DataFrame:
    """Assembled 11-band scenes in tile form, keyed by ``scene``."""
    sc = assemble_scenes(X.px_blocks(spark, sf), S, S)
    scene = ((F.col("j") - 7) * 6 + F.col("i") - 2).cast("int")
    return sc.select(scene.alias("scene"), *[f"b{k}" for k in range(11)])


def exploded(df: DataFrame, *values: str) -> DataFrame:
    """Tile rows to (.., k, value..) rows."""
    keys = [c for c in df.columns if c not in values]
    return df.select(
        *keys, F.posexplode(F.arrays_zip(*[F.col(v) for v in values])).alias("k", "_c")
    ).select(*keys, "k", *[F.col(f"_c.{v}").alias(v) for v in values])


# ----------------------------------------------------------------- tiles, pixels
@query("tiles_to_pixels", f"WITH {X.PX} SELECT scene, band, x, y, dn FROM px WHERE band <> 4")
def tiles_to_px(spark, sf):
    blocks = X.raw_blocks(spark, sf).where("scene_band <> 4").select(
        "scene", F.col("scene_band").alias("band"), F.lit(0).alias("col"), F.lit(0).alias("row"),
        F.col("cells").alias("b0"),
    )
    return tiles_to_pixels(blocks, S).select(
        "scene", "band", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"),
        F.col("b0").alias("dn"),
    )


@query(
    "pixels_to_tiles",
    f"""WITH {X.LP} SELECT CAST(x // 64 AS INTEGER) AS col, CAST(y // 64 AS INTEGER) AS row,
    CAST(4096 AS INTEGER) AS n_cells, count(*) AS n_data, CAST(sum(b0) AS BIGINT) AS sum_b0,
    CAST(sum((y % 64 * 64 + x % 64) * b3) AS BIGINT) AS k_b3 FROM lp GROUP BY 1, 2""",
)
def px_to_tiles(spark, sf):
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v.cast("bigint"), F.lit(0)))
    return X.lp_tiles(spark, sf).select(
        "col", "row", F.size("b0").alias("n_cells"),
        F.size(F.filter("b0", lambda v: v.isNotNull())).cast("bigint").alias("n_data"),
        total(F.col("b0")).alias("sum_b0"),
        total(F.transform("b3", lambda v, k: v * k.cast("bigint"))).alias("k_b3"),
    )


# ------------------------------------------------------------------------ indices
def _ratio_sql(p: str, m: str) -> str:
    return (
        f"CASE WHEN {p} + {m} = 0 THEN NULL ELSE CAST({p} - {m} AS DOUBLE) / CAST({p} + {m} AS DOUBLE) END"
    )


@query("ndvi4", f"WITH {X.LP} SELECT x, y, {_ratio_sql('b3', 'b0')} AS v FROM lp")
def ndvi4(spark, sf):
    return algebra.add_ndvi(X.lp_pixels(spark, sf), out="v").select("x", "y", "v")


@query("ndwi4", f"WITH {X.LP} SELECT x, y, {_ratio_sql('b1', 'b3')} AS v FROM lp")
def ndwi4(spark, sf):
    return algebra.add_ndwi(X.lp_pixels(spark, sf), out="v").select("x", "y", "v")


@query("ndvi2", f"WITH {X.LP} SELECT x, y, {_ratio_sql('b3', 'b0')} AS v FROM lp")
def ndvi2(spark, sf):
    two = select_bands(X.lp_pixels(spark, sf), [0, 3])
    return algebra.add_ndvi(two, "b0", "b1", "v").select("x", "y", "v")


@query("ndwi2", f"WITH {X.LP} SELECT x, y, {_ratio_sql('b1', 'b3')} AS v FROM lp")
def ndwi2(spark, sf):
    two = select_bands(X.lp_pixels(spark, sf), "1.3")
    return algebra.add_ndwi(two, "b0", "b1", "v").select("x", "y", "v")


@query("ndvi_tiles", f"WITH {X.SC} SELECT scene, k, {_ratio_sql('b3', 'b0')} AS v FROM sc")
def ndvi_tiles(spark, sf):
    return exploded(algebra.add_ndvi(scene_tiles(spark, sf), out="v").select("scene", "v"), "v")


@query("ndwi_tiles", f"WITH {X.SC} SELECT scene, k, {_ratio_sql('b1', 'b3')} AS v FROM sc")
def ndwi_tiles(spark, sf):
    return exploded(algebra.add_ndwi(scene_tiles(spark, sf), out="v").select("scene", "v"), "v")


@query(
    "label_mask",
    f"WITH {X.SC} SELECT scene, k, CAST(CASE WHEN b8 + b9 + b10 = 0 THEN 0 ELSE 1 END AS INTEGER) AS m FROM sc",
)
def label_mask(spark, sf):
    return exploded(algebra.add_mask(scene_tiles(spark, sf), out="m").select("scene", "m"), "m")


@query("map_cells", f"WITH {X.SC} SELECT scene, k, b0 * 2 + 1 AS b0, b4 * 2 + 1 AS b4 FROM sc")
def map_cells(spark, sf):
    df = algebra.map_bands(scene_tiles(spark, sf), lambda v: v * 2 + 1, ["b0", "b4"])
    return exploded(df.select("scene", "b0", "b4"), "b0", "b4")


@query("combine_cells", f"WITH {X.SC} SELECT scene, k, b0 + b5 * 2 - b10 AS v FROM sc")
def combine_cells(spark, sf):
    df = algebra.combine_bands(
        scene_tiles(spark, sf), lambda a, b, c: a + b * 2 - c, ["b0", "b5", "b10"], "v"
    )
    return exploded(df.select("scene", "v"), "v")


@query("convert_cells", f"WITH {X.SC} SELECT scene, k, CAST(b0 AS DOUBLE) AS b0 FROM sc")
def convert_cells(spark, sf):
    df = algebra.convert_bands(scene_tiles(spark, sf), "double", ["b0"])
    return exploded(df.select("scene", "b0"), "b0")


# --------------------------------------------------------------------- statistics
@query(
    "band_stats",
    f"""WITH {X.PX} SELECT scene, band, count(dn) AS n, CAST(sum(dn) AS BIGINT) AS s,
    CAST(sum(dn * dn) AS BIGINT) AS ss, round(avg(dn), 6) AS mean, round(stddev_pop(dn), 6) AS sd
    FROM px GROUP BY scene, band""",
)
def band_stats(spark, sf):
    return algebra.band_stats(X.px_pixels(spark, sf), ["scene", "band"], "dn").select(
        "scene", "band", "n", "s", F.col("ss").cast("bigint").alias("ss"),
        F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"),
    )


# Cells near the end of the int range: prices in cents above 1.5e9.
# A scene holds the lines of 128 order keys, so its size does not grow.
_WIDE = """px AS (SELECT CAST(l_orderkey % 8 + 8 * (l_orderkey // 1024) AS BIGINT) AS scene,
  CAST(round(l_extendedprice * 100) AS INTEGER) + 1500000000 AS v FROM lineitem),
st AS (SELECT scene, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS sd FROM px GROUP BY scene)"""


@query(
    "zscore_wide",
    f"""WITH {_WIDE}, z AS (SELECT scene, CAST(trunc((v - mean) / sd) AS INTEGER) AS z FROM px JOIN st USING (scene))
    SELECT scene, any_value(n) AS n, any_value(round(mean, 2)) AS mean, any_value(round(sd, 2)) AS sd,
      CAST(sum(z) AS BIGINT) AS z_sum, CAST(sum(z * z) AS BIGINT) AS z_squares,
      CAST(sum(z) AS BIGINT) AS tile_sum, CAST(sum(z * z) AS BIGINT) AS tile_squares
    FROM z JOIN st USING (scene) GROUP BY scene""",
)
def zscore_wide(spark, sf):
    px = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.expr("l_orderkey % 8 + 8 * (l_orderkey div 1024)").cast("bigint").alias("scene"),
        (F.round(F.col("l_extendedprice") * 100).cast("int") + 1500000000).alias("v"),
    )
    stats = algebra.band_stats(px, ["scene"], "v").select("scene", "n", F.round("mean", 2).alias("mean"), F.round("sd", 2).alias("sd"))
    z = F.col("z").cast("bigint")
    pixels = algebra.zscore_pixels(px, ["scene"], "v").groupBy("scene").agg(F.sum(z).alias("z_sum"), F.sum(z * z).alias("z_squares"))
    tiles = algebra.add_zscore(px.groupBy("scene").agg(F.collect_list("v").alias("b0")), ["b0"])
    cells = tiles.select("scene", F.explode("z_b0").alias("z")).groupBy("scene").agg(F.sum(z).alias("tile_sum"), F.sum(z * z).alias("tile_squares"))
    return stats.join(pixels, "scene").join(cells, "scene")


_STATS = """
st AS (SELECT {key}, CAST(count({v}) AS DOUBLE) AS n, CAST(sum({v}) AS DOUBLE) AS s,
       CAST(sum({v} * {v}) AS DOUBLE) AS ss FROM {t} GROUP BY {key}),
sd AS (SELECT *, s / n AS mean, sqrt(greatest(n * ss - s * s, 0)) / n AS sd FROM st)"""


def stats_sql(t: str, key: str, v: str) -> str:
    return _STATS.format(t=t, key=key, v=v)


@query(
    "zscore_trunc",
    f"""WITH {X.PX}, {stats_sql('px', 'scene, band', 'dn')}
    SELECT px.scene, px.band, px.k, CAST(CASE WHEN sd = 0 THEN 0 ELSE trunc((dn - mean) / sd) END AS INTEGER) AS z
    FROM px JOIN sd ON px.scene = sd.scene AND px.band = sd.band""",
)
def zscore_trunc(spark, sf):
    return algebra.zscore_pixels(X.px_pixels(spark, sf), ["scene", "band"], "dn").select(
        "scene", "band", "k", "z"
    )


_ALL = [f"b{k}" for k in range(11)]


@query(
    "zscore_tiles",
    f"""WITH {X.SC}, st AS (SELECT scene, {", ".join(f"CAST(count({b}) AS DOUBLE) AS n_{b}, CAST(sum({b}) AS DOUBLE) AS s_{b}, CAST(sum({b} * {b}) AS DOUBLE) AS ss_{b}" for b in _ALL)}
      FROM sc GROUP BY scene),
    sd AS (SELECT scene, {", ".join(f"s_{b} / n_{b} AS mean_{b}, sqrt(greatest(n_{b} * ss_{b} - s_{b} * s_{b}, 0)) / n_{b} AS sd_{b}" for b in _ALL)} FROM st)
    SELECT sc.scene, k, {", ".join(f"CAST(CASE WHEN sd_{b} = 0 THEN 0 ELSE trunc(({b} - mean_{b}) / sd_{b}) END AS INTEGER) AS z_{b}" for b in _ALL)}
    FROM sc JOIN sd ON sc.scene = sd.scene""",
)
def zscore_tiles(spark, sf):
    """All bands of every scene, each by its own statistics."""
    out = [f"z_{b}" for b in _ALL]
    return exploded(algebra.add_zscore(scene_tiles(spark, sf), _ALL).select("scene", *out), *out)


# ------------------------------------------------------------------ display values
_CF = f"CAST({(259 * (C.CONTRAST + 255)) / (255 * (259 - C.CONTRAST))!r} AS DOUBLE)"


def _clamp_sql(v: str, lo: int = 0, hi: int = 255) -> str:
    return f"CASE WHEN {v} < {lo} THEN {lo} WHEN {v} > {hi} THEN {hi} ELSE {v} END"


def adjust_sql(source: str, cols: list[str], keys: str) -> str:
    """CTEs that apply brightness, gamma and contrast to ``cols``."""
    step = source
    out = []
    for n, (name, fn) in enumerate(
        (
            ("bri", lambda c: f"CASE WHEN {c} > 0 THEN {c} + 15 ELSE {c} END"),
            ("gam", lambda c: f"CAST(trunc(255 * pow(CAST({c} AS DOUBLE) / 255, CAST(1.25 AS DOUBLE))) AS INTEGER)"),
            ("con", lambda c: f"CAST(trunc({_CF} * ({c} - 128) + 128) AS INTEGER)"),
        )
    ):
        out.append(f"{name} AS (SELECT {keys}, " + ", ".join(f"{fn(c)} AS {c}" for c in cols) + f" FROM {step})")
        out.append(
            f"{name}c AS (SELECT {keys}, " + ", ".join(f"{_clamp_sql(c)} AS {c}" for c in cols) + f" FROM {name})"
        )
        step = f"{name}c"
    return ", ".join(out)


_U16 = ", ".join(
    f"CAST(trunc(({_clamp_sql(f'b{k} * 100', 4000, 15176)} - 4000) * 255 / CAST(11176 AS DOUBLE)) AS INTEGER) AS {n}"
    for k, n in enumerate("rgb")
)


def _as_u16(df: DataFrame) -> DataFrame:
    return algebra.map_bands(df.select("scene", "b0", "b1", "b2"), lambda v: v * 100)


_RGB = list("rgb")
_U16_SQL = f"WITH {X.SC}, src AS (SELECT scene, k, {_U16} FROM sc), {adjust_sql('src', _RGB, 'scene, k')} SELECT * FROM conc"


@query("true_color_u16", _U16_SQL)
def true_color_u16(spark, sf):
    px = exploded(_as_u16(scene_tiles(spark, sf)), "b0", "b1", "b2")
    return render.true_color(px, True).select("scene", "k", "r", "g", "b")


@query("true_color_u16_tiles", _U16_SQL)
def true_color_u16_tiles(spark, sf):
    df = render.true_color(_as_u16(scene_tiles(spark, sf)), True)
    return exploded(df.select("scene", "r", "g", "b"), "r", "g", "b")


_U8 = ", ".join(f"CASE WHEN b3 = 0 THEN 0 ELSE b{k} END AS {n}" for k, n in enumerate("rgb"))
_U8_SQL = f"WITH {X.SC}, src AS (SELECT scene, k, {_U8} FROM sc), {adjust_sql('src', _RGB, 'scene, k')} SELECT * FROM conc"


@query("true_color_u8", _U8_SQL)
def true_color_u8(spark, sf):
    px = exploded(scene_tiles(spark, sf).select("scene", "b0", "b1", "b2", "b3"), "b0", "b1", "b2", "b3")
    return render.true_color(px, False).select("scene", "k", "r", "g", "b")


@query("true_color_u8_tiles", _U8_SQL)
def true_color_u8_tiles(spark, sf):
    df = render.true_color(scene_tiles(spark, sf), False)
    return exploded(df.select("scene", "r", "g", "b"), "r", "g", "b")


@query(
    "display_steps",
    f"""WITH {X.PX} SELECT scene, band, k, {_clamp_sql('dn * 3 - 200')} AS clamped,
    CAST(trunc(({_clamp_sql('dn * 100', 4000, 15176)} - 4000) * 255 / CAST(11176 AS DOUBLE)) AS INTEGER) AS stretched,
    CASE WHEN dn > 0 THEN dn + 15 ELSE dn END AS bright,
    CAST(trunc(255 * pow(CAST(dn AS DOUBLE) / 255, CAST(1.25 AS DOUBLE))) AS INTEGER) AS gamma,
    CAST(trunc({_CF} * (dn - 128) + 128) AS INTEGER) AS contrast FROM px""",
)
def display_steps(spark, sf):
    dn = F.col("dn")
    return X.px_pixels(spark, sf).select(
        "scene", "band", "k", C.clamp(dn * 3 - 200, 0, 255).alias("clamped"),
        C.stretch_u16(dn * 100).alias("stretched"), C.brighten(dn).alias("bright"),
        C.gamma_correct(dn).alias("gamma"), C.contrast_correct(dn).alias("contrast"),
    )


def _classes_sql(breaks: C.Breaks) -> str:
    idx = " ".join(f"WHEN v <= {lim} THEN {k}" for k, (lim, _) in enumerate(breaks))
    col = " ".join(f"WHEN v <= {lim} THEN {int(rgba, 16)}" for lim, rgba in breaks)
    return (
        f"SELECT CAST(CASE {idx} END AS INTEGER) AS class, CAST(CASE {col} END AS BIGINT) AS rgba, "
        "count(*) AS n FROM v GROUP BY 1, 2"
    )


def _one_sql(p: str, m: str, breaks: C.Breaks) -> str:
    return f"WITH {X.LP}, v AS (SELECT {_ratio_sql(p, m)} AS v FROM lp) {_classes_sql(breaks)}"


@query("ndvi_classes", _one_sql("b3", "b0", C.NDVI_BREAKS))
def ndvi_classes(spark, sf):
    return render.class_counts(ndvi4(spark, sf), "v", C.NDVI_BREAKS)


@query("ndwi_classes", _one_sql("b1", "b3", C.NDWI_BREAKS))
def ndwi_classes(spark, sf):
    return render.class_counts(ndwi4(spark, sf), "v", C.NDWI_BREAKS)


_AB = X.lp_sql("la", "WHERE l_linestatus = 'F'") + "," + X.lp_sql("lb", "WHERE l_linestatus = 'O'")


def _two_sql(p: str, m: str) -> str:
    return f"""WITH {_AB}, va AS (SELECT x, y, {_ratio_sql(p, m)} AS v FROM la),
    vb AS (SELECT x, y, {_ratio_sql(p, m)} AS v FROM lb),
    v AS (SELECT va.x, va.y, va.v - vb.v AS v FROM va JOIN vb ON va.x = vb.x AND va.y = vb.y) """


def _two_dates(spark, sf):
    """The raster of two line states, as two acquisition dates."""
    line = X.table(spark, sf, "lineitem")
    return X.lp_of(line.where("l_linestatus = 'F'")), X.lp_of(line.where("l_linestatus = 'O'"))


def _diff(spark, sf, add):
    a, b = (add(df, out="v") for df in _two_dates(spark, sf))
    return diff_layers(a, b, "v", out="v")


@query("diff_layers", _two_sql("b3", "b0") + "SELECT * FROM v")
def ndvi_diff(spark, sf):
    return _diff(spark, sf, algebra.add_ndvi)


@query("ndvi_diff_classes", _two_sql("b3", "b0") + _classes_sql(C.NDVI_DIFF_BREAKS))
def ndvi_diff_classes(spark, sf):
    return render.class_counts(ndvi_diff(spark, sf), "v", C.NDVI_DIFF_BREAKS)


@query("water_diff_classes", _two_sql("b1", "b3") + _classes_sql(C.WATER_DIFF_BREAKS))
def water_diff_classes(spark, sf):
    return render.class_counts(_diff(spark, sf, algebra.add_ndwi), "v", C.WATER_DIFF_BREAKS)


@query(
    "rgba_channels",
    f"""WITH {X.SC}, v AS (SELECT scene, k, {_ratio_sql('b3', 'b0')} AS v FROM sc),
    c AS (SELECT scene, k, CASE {' '.join(f"WHEN v <= {lim} THEN {int(c, 16)}" for lim, c in C.NDVI_BREAKS)} END AS c FROM v)
    SELECT scene, k, CAST(c // 16777216 % 256 AS INTEGER) AS red, CAST(c // 65536 % 256 AS INTEGER) AS green,
    CAST(c // 256 % 256 AS INTEGER) AS blue, CAST(c % 256 AS INTEGER) AS alpha FROM c""",
)
def rgba_channels(spark, sf):
    df = render.color_classes(algebra.add_ndvi(scene_tiles(spark, sf)), "ndvi", C.NDVI_BREAKS)
    ch = C.rgba_channels(F.col("rgba"))
    return exploded(df.select("scene", "rgba"), "rgba").select(
        "scene", "k", *[F.get(ch, F.lit(n)).alias(c) for n, c in enumerate(("red", "green", "blue", "alpha"))]
    )


# ---------------------------------------------------------------- grid transforms
_WIDTH = "(CASE WHEN band = 4 THEN 7 ELSE 8 END)"  # the height band is one column short


def _moved(name: str, kernel, sql_k: str) -> None:
    """Register a transform of every band of the scenes, oblong ones too."""

    @query(
        name,
        f"WITH {X.PX}, p AS (SELECT *, {_WIDTH} AS w FROM px) SELECT scene, band, CAST({sql_k} AS INTEGER) AS k_new, dn FROM p",
    )
    def run(spark, sf):
        df = X.raw_blocks(spark, sf).select(
            "scene", F.col("scene_band").alias("band"),
            kernel(F.col("cells"), F.col("cols"), F.col("rows")).alias("dn"),
        )
        return exploded(df, "dn").withColumnRenamed("k", "k_new")


_moved("rotate90_1", lambda c, w, h: K.rotate90(c, w, h, 1), "(w - 1 - x) * 8 + y")
_moved("rotate90_2", lambda c, w, h: K.rotate90(c, w, h, 2), "(7 - y) * w + w - 1 - x")
_moved("rotate90_3", lambda c, w, h: K.rotate90(c, w, h, 3), "x * 8 + 7 - y")
_moved("flip_vertical", K.flip_vertical, "y * w + w - 1 - x")
_moved("flip_horizontal", K.flip_horizontal, "(7 - y) * w + x")


@query(
    "rotate90_oblong",
    f"WITH {X.PX} SELECT scene, CAST((6 - x) * 8 + y AS INTEGER) AS k_new, dn FROM px WHERE band = 4",
)
def rotate90_oblong(spark, sf):
    df = X.raw_blocks(spark, sf).where("scene_band = 4").select(
        "scene", K.rotate90(F.col("cells"), F.col("cols"), F.col("rows"), 1).alias("dn")
    )
    return exploded(df, "dn").withColumnRenamed("k", "k_new")
