"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.llm.text import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is some node of its component.

    Nodes are digests, so their order is random.  Each round every node of the
    contracted graph points to its least neighbour or itself, two pointers are
    followed, and edges inside a group vanish.  In random order a constant
    share of the nodes goes in each round, so rounds grow with the logarithm of
    a component; stars take one.  Every round is written to the shared folder,
    and only counts reach the driver.
    """
    edges = cut(edges.select("a", "b").where("a <> b").distinct())
    both = edges.union(edges.select("b", "a"))
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    first = True
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("up"))
        jump = least.select(F.col("v").alias("up"), F.col("up").alias("top"))
        parent = cut(least.join(jump, "up").select("v", "top"))
        of_a = parent.select(F.col("v").alias("a"), F.col("top").alias("ta"))
        of_b = parent.select(F.col("v").alias("b"), F.col("top").alias("tb"))
        edges = cut(
            edges.join(of_a, "a").join(of_b, "b").where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        )
        up = parent.select(F.col("v").alias("root"), "top")
        if first:
            labels = parent.select(F.col("v").alias("node"), F.col("top").alias("root"))
        else:
            labels = labels.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        labels, first = cut(labels), False
    return labels
