"""Session settings for large tiles."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rastertable.schema import band_columns

# Groups of whole tiles are large: aggregate a few in memory, then by sorting
# (one group at a time, with spill) instead of holding 128 groups at once.
# Adaptive execution splits skewed join partitions and merges small ones.
LARGE_TILES = {
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Cells of all bands that an Arrow batch of whole tiles may hold.
BATCH_CELLS = 8_000_000


def bounded_batches(tiles: DataFrame, cells: int) -> None:
    """Let Arrow batches of this session hold no more tiles of ``cells`` cells than ``BATCH_CELLS`` allow."""
    conf, name = tiles.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = max(1, BATCH_CELLS // (cells * max(len(band_columns(tiles)), 1)))
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))


def configure(spark: SparkSession, **extra: str) -> SparkSession:
    """Apply the settings for 512 x 512 tiles to a session; returns it."""
    for key, value in {**LARGE_TILES, **extra}.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def large_tiles(spark: SparkSession) -> Iterator[None]:
    """The settings for the time of a job; the session's own are put back."""
    before = {key: spark.conf.get(key, None) for key in LARGE_TILES}
    configure(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
