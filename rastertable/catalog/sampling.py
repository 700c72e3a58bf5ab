"""Queries on sample windows, stitching, augmentation and sample products."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rastertable.catalog import fixtures as X
from rastertable.catalog.cells import exploded
from rastertable.catalog.registry import query
from rastertable.functions.batches import map_rows, totals
from rastertable.operators import augment, windows as W
from rastertable.operators.joins import join_tiles, window_keys
from rastertable.plans.sampling import chips_from_windows
from rastertable.sources.samples import PRODUCTS, export_name, gz_name, product_view

BANDS = ["b0", "b1", "b2", "b3"]


@query("random_windows", f"WITH {X.DRAWN} SELECT draw_id, x0, y0, x1, y1 FROM wb")
def random_windows(spark, sf):
    return X.drawn_windows(spark, sf).select("draw_id", "x0", "y0", "x1", "y1")


@query(
    "distinct_windows",
    f"""WITH {X.DRAWN}, o AS (SELECT o_custkey, min(o_orderkey) AS draw_id FROM orders GROUP BY o_custkey),
    e AS (SELECT o_custkey AS place, draw_id,
      {X.OX} + {X.u_sql('o_custkey', 1)} * CAST(504.5 AS DOUBLE) AS xmin,
      CAST(5808512.0 - 512 * s AS DOUBLE) + {X.u_sql('o_custkey', 2)} * CAST(512.0 * s - 7.5 AS DOUBLE) AS ymin FROM o, sh)
    SELECT CAST(min(draw_id) AS BIGINT) AS draw_id, xmin, ymin FROM e GROUP BY xmin, ymin""",
)
def distinct_windows(spark, sf):
    grid = X.lp_grid(spark, sf)
    xmin, ymin, xmax, ymax = grid.extent
    side = grid.cw * (X.WINDOW - 1)
    place = F.col("o_custkey")
    drawn = X.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("draw_id"),
        (F.lit(xmin) + X.lcg_uniform(place, 1) * F.lit(xmax - xmin - side)).alias("xmin"),
        (F.lit(ymin) + X.lcg_uniform(place, 2) * F.lit(ymax - ymin - side)).alias("ymin"),
    ).withColumns({"xmax": F.col("xmin") + side, "ymax": F.col("ymin") + side})
    return W.distinct_windows(drawn).select("draw_id", "xmin", "ymin")


@query("number_windows", f"WITH {X.NUMBERED} SELECT draw_id, window_id FROM w")
def number_windows(spark, sf):
    return X.numbered_windows(spark, sf).select("draw_id", "window_id")


_JOIN = f"""WITH {X.WINDOWS}, {X.LP}, {X.TILES} SELECT window_id, col, row FROM w JOIN tk
    ON x0 <= col * 64 + 63 AND x1 >= col * 64 AND y0 <= row * 64 + 63 AND y1 >= row * 64"""


@query("window_tile_join", _JOIN)
def window_tile_join(spark, sf):
    keys = X.lp_tiles(spark, sf).select("col", "row")
    return join_tiles(window_keys(X.windows(spark, sf), X.TILE), keys, "window_id").select(
        "window_id", "col", "row"
    )


@query("window_tile_join_salted", _JOIN)
def window_tile_join_salted(spark, sf):
    """The shuffle form, with every tile of more than two windows split up."""
    keys = X.lp_tiles(spark, sf).select("col", "row")
    return join_tiles(
        window_keys(X.windows(spark, sf), X.TILE), keys, "window_id", strategy="salted", hot_key=2
    ).select("window_id", "col", "row")


_WSUM = ", ".join(f"CAST(sum({b}) AS BIGINT) AS sum_{b}" for b in BANDS)
_CHIP = f"WITH {X.WINDOWS}, {X.LP}, {X.TILES}, {X.WINDOW_CELLS}"


@query("crop_window", f"{_CHIP} SELECT window_id, count(*) AS n, {_WSUM} FROM wc GROUP BY window_id")
def crop_window(spark, sf):
    """Cells of every window, summed from the unstitched pieces."""
    pieces = W.window_pieces(X.windows(spark, sf).select("window_id", "x0", "y0", "x1", "y1"),
                             X.lp_tiles(spark, sf), X.TILE)
    cells = exploded(pieces.select("window_id", *BANDS), *BANDS).where("b0 IS NOT NULL")
    return cells.groupBy("window_id").agg(
        F.count("*").alias("n"), *[F.sum(b).alias(f"sum_{b}") for b in BANDS]
    )


_KSUM = ", ".join(f"CAST(sum((cy * cols + cx) * {b}) AS BIGINT) AS k_{b}" for b in BANDS)


def _checksums(chips):
    cells = exploded(chips.select("window_id", *BANDS), *BANDS).where("b0 IS NOT NULL")
    return cells.groupBy("window_id").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(b).cast("bigint") * F.col("k")).alias(f"k_{b}") for b in BANDS],
    )


def _window_columns(spark, sf):
    return X.windows(spark, sf).select("window_id", "draw_id", "x0", "y0", "x1", "y1")


@query("stitch_windows", f"{_CHIP} SELECT window_id, count(*) AS n, {_KSUM} FROM wc GROUP BY window_id")
def stitch_windows(spark, sf):
    return _checksums(W.stitch_windows(_window_columns(spark, sf), X.lp_tiles(spark, sf), X.TILE))


@query(
    "augment_choice",
    f"""WITH {X.WINDOWS} SELECT window_id, {X.u_sql('window_id', 3)} > 0.5 AS flip_v,
    {X.u_sql('window_id', 4)} > 0.5 AS flip_h, CAST(floor({X.u_sql('window_id', 5)} * 5) AS INTEGER) AS turns FROM w""",
)
def augment_choice(spark, sf):
    chosen = augment.augment_choice(F.col("window_id"), X.lcg_uniform)
    return X.windows(spark, sf).select("window_id", *[v.alias(k) for k, v in chosen.items()])


_AUGMENTED = f"""{_CHIP},
    ac AS (SELECT *, {X.u_sql('window_id', 3)} > 0.5 AS fv, {X.u_sql('window_id', 4)} > 0.5 AS fh,
                  CAST(floor({X.u_sql('window_id', 5)} * 5) AS INTEGER) % 4 AS n FROM wc),
    af AS (SELECT *, CASE WHEN fv THEN cols - 1 - cx ELSE cx END AS fx, CASE WHEN fh THEN rows - 1 - cy ELSE cy END AS fy FROM ac),
    ar AS (SELECT window_id, b0, b1, b2, b3, CASE WHEN n % 2 = 1 THEN rows ELSE cols END AS cols,
                  CASE n WHEN 0 THEN fx WHEN 1 THEN fy WHEN 2 THEN cols - 1 - fx ELSE rows - 1 - fy END AS cx,
                  CASE n WHEN 0 THEN fy WHEN 1 THEN cols - 1 - fx WHEN 2 THEN rows - 1 - fy ELSE fx END AS cy FROM af)"""
_AUGMENTED_SUM = f"{_AUGMENTED} SELECT window_id, count(*) AS n, {_KSUM} FROM ar GROUP BY window_id"


@query("augment_chips", _AUGMENTED_SUM)
def augment_chips(spark, sf):
    chips = W.stitch_windows(_window_columns(spark, sf), X.lp_tiles(spark, sf), X.TILE)
    return _checksums(augment.augment(chips, X.lcg_uniform))


@query("augment_pieces", _AUGMENTED_SUM)
def augment_pieces(spark, sf):
    """The same augmentation on pieces that are never stitched."""
    pieces = W.window_pieces(_window_columns(spark, sf), X.lp_tiles(spark, sf), X.TILE)
    turned = augment.orient_pieces(
        pieces.withColumns(augment.augment_choice(F.col("window_id"), X.lcg_uniform))
    )
    odd = F.col("turns") % 2 == 1
    cols = F.when(odd, F.col("y1") - F.col("y0") + 1).otherwise(F.col("x1") - F.col("x0") + 1)
    cells = exploded(turned.select("window_id", cols.alias("cols"), "px", "py", "w", *BANDS), *BANDS)
    k = (F.col("py") + F.floor(F.col("k") / F.col("w"))) * F.col("cols") + F.col("px") + F.col("k") % F.col("w")
    return cells.where("b0 IS NOT NULL").groupBy("window_id").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(b).cast("bigint") * k).alias(f"k_{b}") for b in BANDS],
    )


_PRODUCTS = f"""{_AUGMENTED}, full_size AS (SELECT window_id, (x1 - x0 + 1) * (y1 - y0 + 1) AS cells FROM hit),
    ag AS (SELECT h.window_id, cells, count(b0) AS n, coalesce(sum(b0 + b1 + b2 + b3), 0) AS total,
             coalesce(sum(CASE WHEN b0 + b3 = 0 THEN NULL ELSE floor(CAST(b3 - b0 AS DOUBLE) / CAST(b3 + b0 AS DOUBLE) * 1000000) END), 0) AS nd,
             count(CASE WHEN b0 + b3 = 0 THEN NULL ELSE b0 END) AS nn,
             count(CASE WHEN b1 + b2 + b3 = 0 THEN 1 END) AS zero,
             {", ".join(f"CAST(sum({b}) AS DOUBLE) AS s_{b}, CAST(sum({b} * {b}) AS DOUBLE) AS ss_{b}" for b in BANDS)}
           FROM full_size h LEFT JOIN ar ON h.window_id = ar.window_id GROUP BY h.window_id, cells),
    sd AS (SELECT window_id, {", ".join(f"s_{b} / n AS mean_{b}, sqrt(greatest(n * ss_{b} - s_{b} * s_{b}, 0)) / n AS sd_{b}" for b in BANDS)} FROM ag WHERE n > 0),
    z AS (SELECT ar.window_id, count(*) AS n,
            sum({" + ".join(f"{k} * CASE WHEN sd_{b} = 0 THEN 0 ELSE trunc(({b} - mean_{b}) / sd_{b}) END" for k, b in enumerate(BANDS, 1))}) AS total
          FROM ar JOIN sd ON ar.window_id = sd.window_id GROUP BY ar.window_id)
    SELECT window_id, 'image' AS product, n, CAST(total AS BIGINT) AS checksum FROM ag
    UNION ALL SELECT window_id, 'ndvi', nn, CAST(nd AS BIGINT) FROM ag
    UNION ALL SELECT window_id, 'mask', CAST(cells AS BIGINT), CAST(cells - zero AS BIGINT) FROM ag
    UNION ALL SELECT ag.window_id, 'image_z', ag.n, CAST(coalesce(z.total, 0) AS BIGINT) FROM ag LEFT JOIN z ON ag.window_id = z.window_id"""


def _products(chips):
    """Data cells and checksum of each product, per row of chips."""

    def rows(batch):
        column = dict(zip(batch.schema.names, batch.columns))

        def weighted(prefix, weights):
            sums = [totals(column[f"{prefix}{b}"]) for b in BANDS]
            return sums[0][0], reduce(pc.add, [pc.multiply(s, k) for k, (_, s) in zip(weights, sums)])

        parts = {
            "image": weighted("", (1, 1, 1, 1)), "ndvi": totals(column["micro"]),
            "mask": totals(column["mask"]), "image_z": weighted("z_", (1, 2, 3, 4)),
        }
        for product, (n, checksum) in parts.items():
            yield {"window_id": column["window_id"], "product": pa.array([product] * len(n)), "n": n, "checksum": checksum}

    schema = StructType([chips.schema["window_id"], *(StructField(c, t) for c, t in (("product", StringType()), ("n", LongType()), ("checksum", LongType())))])
    micro = F.transform("ndvi", lambda v: F.floor(v * 1000000)).alias("micro")
    return map_rows(chips.select("window_id", *BANDS, micro, "mask", *[f"z_{b}" for b in BANDS]), rows, schema)


@query("generate_samples", _PRODUCTS)
def generate_samples(spark, sf):
    """All four products of augmented chips; bands of the z-score weighted by their number."""
    return _products(
        chips_from_windows(_window_columns(spark, sf), X.lp_tiles(spark, sf), X.TILE, X.lcg_uniform, size=16)
    )


@query("generate_samples_blocks", _PRODUCTS)
def generate_samples_blocks(spark, sf):
    """The same chips in blocks of 5 x 5 cells, with statistics merged per window."""
    chips = chips_from_windows(_window_columns(spark, sf), X.lp_tiles(spark, sf), X.TILE, X.lcg_uniform, block=5)
    return _products(chips).groupBy("window_id", "product").agg(F.sum("n").alias("n"), F.sum("checksum").alias("checksum"))


@query(
    "sample_bands",
    f"""{_CHIP} SELECT window_id, count(*) AS n, CAST(sum((cy * cols + cx) * b2) AS BIGINT) AS k_b0,
    CAST(sum((cy * cols + cx) * b1) AS BIGINT) AS k_b1 FROM wc GROUP BY window_id""",
)
def sample_bands(spark, sf):
    """Image product of a band subset in list order."""
    chips = chips_from_windows(
        _window_columns(spark, sf), X.lp_tiles(spark, sf), X.TILE, None, False, "2.1"
    )
    view = product_view(chips, "image")
    cells = exploded(view.select("window_id", "b0", "b1"), "b0", "b1").where("b0 IS NOT NULL")
    return cells.groupBy("window_id").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(b).cast("bigint") * F.col("k")).alias(f"k_{b}") for b in ("b0", "b1")],
    )


@query(
    "export_names",
    f"""WITH {X.WINDOWS}, n AS (SELECT window_id, unnest(['image', 'ndvi', 'mask', 'image_z']) AS product FROM w),
    f AS (SELECT window_id, product, '/out/test/16x16/' || CASE product WHEN 'image' THEN window_id || '.tiff'
      WHEN 'image_z' THEN window_id || '-z.tiff' ELSE product || '/' || window_id || '.tiff' END AS name FROM n)
    SELECT window_id, product, name, replace(name, '.tiff', '.gz') AS gz_name FROM f""",
)
def export_names(spark, sf):
    named = X.windows(spark, sf).select("window_id", F.lit("test").alias("split"), F.lit(16).alias("size"))
    rows = F.array(
        *[F.struct(F.lit(p).alias("product"), export_name("/out/", p).alias("name")) for p in PRODUCTS]
    )
    return named.select("window_id", F.inline(rows)).withColumn("gz_name", gz_name(F.col("name")))
