"""Consecutive numbering of large tables without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastertable.grid import zorder
from rastertable.operators.joins import BROADCAST_ROWS

# Keys per numbering bucket: 2 ** 12.
BUCKET_BITS = 12


def dense_index(df: DataFrame, key: str, out: str = "idx", bits: int = BUCKET_BITS) -> DataFrame:
    """0-based position of every row in the order of a unique, non-negative key.

    The key range is cut into buckets of ``2**bits`` keys.  Bucket sizes come
    from an ordinary grouped count; their running sum is taken inside
    super-buckets and over the few super-buckets, so the only unpartitioned
    window runs over ``distinct(key >> 2*bits)`` rows.  Buckets depend on the
    key alone, so a recomputed task numbers its rows identically.
    """
    # Non-nullable join keys: otherwise the joins infer a filter on the key
    # formula, and the three uses of ``df`` no longer share one exchange.
    bucket = F.coalesce(F.shiftright(F.col(key), bits), F.lit(0).cast("bigint"))
    counts = df.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count("*").alias("_n"))
    counts = counts.withColumn(
        "_super", F.coalesce(F.shiftright("_bucket", bits), F.lit(0).cast("bigint"))
    )
    before = Window.orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    supers = (
        counts.groupBy("_super")
        .agg(F.sum("_n").alias("_n"))
        .select("_super", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = (
        Window.partitionBy("_super").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        counts.withColumn("_run", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(supers, "_super")
        .select("_bucket", (F.col("_base") + F.col("_run")).alias("_offset"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        df.withColumn("_bucket", bucket)
        .join(offsets, "_bucket")
        .withColumn(out, (F.col("_offset") + rank - 1).cast("bigint"))
        .drop("_bucket", "_offset")
    )


def with_index(tiles: DataFrame, out: str = "idx") -> DataFrame:
    """Number the tiles of a layer in Z-order.

    Only the keys are sorted and numbered.  Few numbers are broadcast to the
    tiles, which then stay where they were read; otherwise both are shuffled by
    their key once.
    """
    z = F.col("z") if "z" in tiles.columns else zorder(F.col("col"), F.col("row"))
    keys = dense_index(tiles.select("col", "row", z.alias("_z")), "_z", out).drop("_z")
    if set(tiles.columns) == {"col", "row"}:
        return keys
    # The keys are as many as the tiles, so the cheaper scan of the keys is measured.
    if tiles.select("col", "row").limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return tiles.join(keys, ["col", "row"]).select(*tiles.columns, out)


def batch(tiles: DataFrame, n: int, k: int) -> DataFrame:
    """Batch ``k`` of ``n`` interleaved batches of a layer.

    Only the keys are numbered; the chosen keys then select the tiles, so cell
    data is shuffled at most once and not at all for a small batch.
    """
    if n < 1 or not 0 <= k < n:
        raise ValueError("need 0 <= k < n")
    keys = with_index(tiles.select("col", "row"))
    chosen = keys.where(F.col("idx") % n == k).select("col", "row")
    return tiles.join(chosen, ["col", "row"], "left_semi")
