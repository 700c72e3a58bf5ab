"""Training / validation / test membership and bounding boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.schema import SPLITS


def splits_table(spark: SparkSession, splits=None) -> DataFrame:
    """(i, j, split) rows of the split lists."""
    rows = [(i, j, name) for name, keys in (splits or SPLITS).items() for i, j in keys]
    return spark.createDataFrame(rows, "i int, j int, split string")


def assign_split(df: DataFrame, splits=None, keep_unassigned: bool = False) -> DataFrame:
    """Add ``split`` to rows keyed by (i, j).

    The split lists are arguments of fixed size, hence broadcast.
    """
    table = splits_table(df.sparkSession, splits)
    how = "left" if keep_unassigned else "inner"
    return df.join(F.broadcast(table), ["i", "j"], how)


def split_extents(scenes: DataFrame, splits=None) -> DataFrame:
    """One row per split with the union of its scene extents; NULL if empty.

    A single grouped min/max over the small header columns serves all splits.
    """
    boxes = (
        assign_split(scenes.select("i", "j", "extent"), splits)
        .groupBy("split")
        .agg(
            F.min("extent.xmin").alias("xmin"), F.min("extent.ymin").alias("ymin"),
            F.max("extent.xmax").alias("xmax"), F.max("extent.ymax").alias("ymax"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    names = scenes.sparkSession.createDataFrame(
        [(name,) for name in (splits or SPLITS)], "split string"
    )
    box = F.struct("xmin", "ymin", "xmax", "ymax")
    return names.join(boxes, "split", "left").select(
        "split",
        F.when(F.col("n").isNotNull(), box).alias("extent"),
    )
