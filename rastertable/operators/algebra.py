"""Cell algebra on tables: indices, masks and statistics over band columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertable.functions import cells as C
from rastertable.functions import tiles as K
from rastertable.functions.batches import map_rows, zscores
from rastertable.schema import band_columns, cell_sql_type


# Cell types whose values are exact as doubles, or rounded alike there and in Spark.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _is_tile(df: DataFrame, band: str) -> bool:
    return isinstance(df.schema[band].dataType, T.ArrayType)


def map_bands(df: DataFrame, fn: Callable[[Column], Column], bands: Sequence[str] | None = None) -> DataFrame:
    """Apply one cell formula to every (given) band of tiles or pixels."""
    bands = list(bands or band_columns(df))
    return df.withColumns(
        {b: K.map_cells(F.col(b), fn) if _is_tile(df, b) else fn(F.col(b)) for b in bands}
    )


def combine_bands(df: DataFrame, fn: Callable[..., Column], bands: Sequence[str], out: str) -> DataFrame:
    """Add a column computed cell by cell from several bands."""
    cols = [F.col(b) for b in bands]
    value = K.combine_cells(fn, *cols) if _is_tile(df, bands[0]) else fn(*cols)
    return df.withColumn(out, value)


def convert_bands(df: DataFrame, cell_type: str, bands: Sequence[str] | None = None) -> DataFrame:
    """Change the cell type of the (given) bands."""
    bands = list(bands or band_columns(df))
    return df.withColumns(
        {
            b: K.convert_cells(F.col(b), cell_type) if _is_tile(df, b) else F.col(b).cast(cell_type)
            for b in bands
        }
    )


def add_ndvi(df: DataFrame, red: str = "b0", nir: str = "b3", out: str = "ndvi") -> DataFrame:
    return combine_bands(df, C.ndvi, [red, nir], out)


def add_ndwi(df: DataFrame, green: str = "b1", nir: str = "b3", out: str = "ndwi") -> DataFrame:
    return combine_bands(df, C.ndwi, [green, nir], out)


def add_mask(df: DataFrame, bands: Sequence[str] | None = None, out: str = "mask") -> DataFrame:
    """Label mask of the last three bands (or the given ones)."""
    return combine_bands(df, C.label_mask, list(bands or band_columns(df)[-3:]), out)


def add_zscore(
    df: DataFrame, bands: Sequence[str] | None = None, prefix: str = "z_", strict: bool = True
) -> DataFrame:
    """z-score of each band array by the statistics of its own row.

    A band without data is an error, or stays without data if not ``strict``.
    """
    bands = list(bands or band_columns(df))
    if not all(isinstance(df.schema[b].dataType.elementType, WHOLE) for b in bands):
        return df.withColumns({f"{prefix}{b}": K.zscore_cells(F.col(b), strict) for b in bands})
    # Whole numbers: all bands in one Arrow step.
    out = [f"{prefix}{b}" for b in bands]
    fields = [f for f in df.schema if f.name not in out]
    schema = T.StructType([*fields, *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in out]])

    def scored(batch):
        columns = dict(zip(batch.schema.names, batch.columns))
        yield columns | {c: zscores(columns[b], strict) for c, b in zip(out, bands)}

    return map_rows(df, scored, schema)


def merged_stats(parts: DataFrame, key: str, bands: Sequence[str]) -> DataFrame:
    """(key, one struct(mean, sd) per band) over arrays that together hold a key's cells.

    Only moments of each array are shuffled.  Integer bands are exact; floating
    bands merge the means and deviations of the parts.
    """
    exact = [b for b in bands if cell_sql_type(parts, b) not in ("float", "double")]

    def moments(b: str) -> Column:
        if b in exact:
            return K.cell_moments(F.col(b)).alias(b)
        n = F.size(F.filter(b, lambda v: v.isNotNull()))
        return K.let(K.cell_mean_sd(F.col(b)), lambda m: F.struct(n.alias("n"), m["mean"].alias("mean"), m["sd"].alias("sd"))).alias(b)

    def merged(b: str) -> Column:
        if b in exact:
            n, s = F.sum(f"{b}.n"), F.sum(f"{b}.s")
            sd = C.pop_stddev(n, s, C.square_sum(F.sum(f"{b}.hi"), F.sum(f"{b}.lo")))
            return F.when(n > 0, F.struct((s.cast("double") / n.cast("double")).alias("mean"), sd.alias("sd"))).alias(b)
        rows = F.collect_list(F.when(F.col(f"{b}.n") > 0, F.col(b)))

        def total(x: Column, fn: Callable[[Column], Column]) -> Column:
            return F.aggregate(x, F.lit(0.0), lambda acc, r: acc + fn(r))

        n = lambda r: r["n"].cast("double")
        return K.let(
            rows,
            lambda x: K.let(
                F.try_divide(total(x, lambda r: n(r) * r["mean"]), total(x, n)),
                lambda m: F.struct(
                    m.alias("mean"),
                    F.sqrt(
                        F.try_divide(total(x, lambda r: n(r) * (r["sd"] * r["sd"] + (r["mean"] - m) * (r["mean"] - m))), total(x, n))
                    ).alias("sd"),
                ),
            ),
        ).alias(b)

    return parts.select(key, *[moments(b) for b in bands]).groupBy(key).agg(*[merged(b) for b in bands])


def band_stats(pixels: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key: n, s, ss, mean, sd (population) over data cells.

    Integer cells are summed exactly; NULL results mean "no data cell".
    """
    v = F.col(value)
    if cell_sql_type(pixels, value) in ("float", "double"):
        return pixels.groupBy(*keys).agg(
            F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd")
        )
    high, low = C.square_parts(v)
    sums = pixels.groupBy(*keys).agg(
        F.count(v).alias("n"), F.sum(v.cast("bigint")).alias("s"), F.sum(high).alias("_hi"), F.sum(low).alias("_lo")
    )
    sums = sums.withColumn("ss", C.square_sum(F.col("_hi"), F.col("_lo"))).drop("_hi", "_lo")
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    return sums.withColumns(
        {
            "mean": F.try_divide(s.cast("double"), n.cast("double")),
            "sd": F.when(n > 0, C.pop_stddev(n, s, ss)),
        }
    )


def zscore_pixels(pixels: DataFrame, keys: Sequence[str], value: str, out: str = "z") -> DataFrame:
    """z-score in pixel form; the statistics are joined back by key.

    The statistics have one row per key and aggregate map-side, so a key that
    holds a large share of the cells costs no more than any other; the join is
    left to the runtime size of the statistics.
    """
    stats = band_stats(pixels, keys, value).select(*keys, "n", "mean", "sd")
    checked = F.when(
        F.col("n") > 0, C.zscore(F.col(value), F.col("mean"), F.col("sd"))
    ).otherwise(F.raise_error(F.lit("no statistics: band without data cells")).cast("int"))
    return pixels.join(stats, list(keys)).withColumn(out, checked).drop("n", "mean", "sd")
