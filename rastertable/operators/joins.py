"""Join strategies whose broadcast side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest number of (id, tile key) rows that is sent to every executor; such a
# row has about 100 bytes, so this stays near 20 MB.
BROADCAST_ROWS = 200_000
# Windows or polygons per tile that one task may serve.
HOT_KEY = 256


def measured_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it has at most ``limit`` rows, else ``df`` itself.

    Costs one small job that stops after ``limit + 1`` rows of the final stage.
    Beyond the limit Spark plans a shuffle join.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition few but expensive rows over all shuffle partitions.

    The count is given explicitly because adaptive execution would merge such
    small partitions by size into one task, although each row stands for a
    whole tile of work.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def window_keys(windows: DataFrame, tile: int) -> DataFrame:
    """One row per window and tile key that its cell bounds cover."""

    def span(lo: str, hi: str):
        return F.sequence(
            F.floor(F.col(lo) / tile).cast("int"), F.floor(F.col(hi) / tile).cast("int")
        )

    return (
        windows.where("x0 <= x1 and y0 <= y1")
        .withColumn("row", F.explode(span("y0", "y1")))
        .withColumn("col", F.explode(span("x0", "x1")))
    )


def join_tiles(
    keys: DataFrame,
    tiles: DataFrame,
    id_col: str,
    strategy: str = "auto",
    max_broadcast: int = BROADCAST_ROWS,
    hot_key: int = HOT_KEY,
    lists: bool = False,
) -> DataFrame:
    """Equi-join key rows (id, col, row, ..) with the tiles they address.

    ``lists`` gives the keys of a tile as the array ``_keys`` of structs beside
    the tile, instead of a copy of the tile beside each key.  A tile has one
    such row, or one per share of its keys if they are dealt out.

    ``auto`` first counts the key rows per tile, a small aggregate over keys
    only.  Few and well spread keys are broadcast, so the tiles are not
    shuffled at all.  Otherwise both sides are shuffled; a tile with ``n >
    hot_key`` keys is replicated ``ceil(n / hot_key)`` times and its keys are
    dealt out over the copies, so that no task serves more than about
    ``hot_key`` keys of one tile.  Without such tiles the keys of a partition
    are hashed and its tiles stream past them, so no task sorts whole tiles.
    Every pair appears exactly once either way.
    """
    if strategy not in ("auto", "broadcast", "salted"):
        raise ValueError(f"unknown join strategy {strategy}")
    def listed(rows: DataFrame, *on: str) -> DataFrame:
        if not lists:
            return rows
        return rows.groupBy(*on).agg(F.collect_list(F.struct(*[c for c in keys.columns if c not in ("col", "row")])).alias("_keys"))

    # Keys of polygons carry edges of any number; the limit is in rows of about 100 bytes.
    weight = 1 + F.size("edges") * 0.32 if "edges" in keys.columns else F.lit(1.0)
    counts = keys.groupBy("col", "row").agg(F.count("*").alias("_n"), F.sum(weight).alias("_weight"))
    stats = None
    if strategy == "auto":
        stats = counts.agg(
            F.sum("_weight").alias("total"),
            F.max("_n").alias("top"),
            F.count_if(F.col("_n") > hot_key).alias("hot"),
            *[F.expr(f"{f}({c})").alias(f"{c}_{f}") for c in ("col", "row") for f in ("min", "max")],
        ).first()
        if not stats["total"]:
            return tiles.where(F.lit(False)).join(listed(keys, "col", "row"), ["col", "row"])
        tiles = tiles.where(
            F.col("col").between(stats["col_min"], stats["col_max"])
            & F.col("row").between(stats["row_min"], stats["row_max"])
        )
        small = stats["total"] <= max_broadcast and stats["top"] <= hot_key
        strategy = "broadcast" if small else "salted"
    if strategy == "broadcast":
        return tiles.join(F.broadcast(listed(keys, "col", "row")), ["col", "row"])
    if stats is not None and not stats["hot"]:
        return tiles.join(listed(keys, "col", "row").hint("shuffle_hash"), ["col", "row"])

    copies = counts.where(F.col("_n") > hot_key).select(
        "col", "row", F.ceil(F.col("_n") / hot_key).cast("int").alias("_copies")
    )
    copies = measured_broadcast(copies, max_broadcast)
    n = F.coalesce(F.col("_copies"), F.lit(1))
    left = (
        keys.join(copies, ["col", "row"], "left")
        .withColumn("_salt", F.pmod(F.xxhash64(id_col), n).cast("int"))
        .drop("_copies")
    )
    right = (
        tiles.join(copies, ["col", "row"], "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
        .drop("_copies")
    )
    on = ["col", "row", "_salt"]
    return right.join(listed(left, *on), on).drop("_salt")


def diff_layers(a: DataFrame, b: DataFrame, column: str, on=("x", "y"), out: str = "diff") -> DataFrame:
    """Cell-wise difference of one column of two layers."""
    on = list(on)
    left = a.select(*on, F.col(column).alias("_a"))
    right = b.select(*on, F.col(column).alias("_b"))
    return left.join(right, on).select(*on, (F.col("_a") - F.col("_b")).alias(out))
