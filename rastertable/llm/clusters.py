"""Centroid clustering (Lloyd's rounds) with Ptolemaic lower bounds.

Every vector becomes integers ``floor(scale * x)``, so that all distances and
means are exact.  For four points Ptolemy's inequality gives
``d(v, c) >= |d(v, p) d(c, s) - d(v, s) d(c, p)| / d(p, s)``.  The pivots are a
snapshot of the centroids, and each centroid has one fixed pivot pair: its own
snapshot p and the snapshot s farthest from it.  The distances of all vectors
to the pivots are kept next to the vectors in a written table, so a round costs
one bound per vector and centroid; only centroids whose bound does not exceed
the best distance found are checked, in integers.  While centroids stay near
their snapshot, the bound stays near the distance itself.  A new snapshot is
cached when more than ``recache`` of all pairs of the last round had to be
checked; this changes the work, never the result.

Rounding is conservative: cached distances are 32-bit floats, and a bound is
lowered by more than their rounding can have raised it.

Each round moves ``k`` sums to the driver and ``k`` centroids back; nothing
that grows with the table leaves the executors.

Edge cases: rows whose vector is null, is not of ``dims`` components, or holds
null or non-finite components are left out.  Repeated rows are vectors of their
own and share one result; a null id is hashed as empty text, and equal hashes
are ordered by id (null first), then components.  With fewer vectors than
``k`` there are as many centroids as vectors.  Centroids may be equal; the
smaller number then takes all.  An integer of 2^27 or more is an error, because
squared distances would pass 64 bits.  Only vec_id and embedding are read.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm.text import cut, map_arrow

#: Integers below this bound have squared distances of 64 components within 63 bits.
LIMIT = 2**27

#: More than three rounding errors of a 32-bit float, relative to the products of a bound.
SLACK = 2.0**-21


@dataclass(frozen=True)
class ClusterParams:
    k: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256
    salt: str = "2"
    recache: float = 0.5


def integer_vectors(table: DataFrame, p: ClusterParams) -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = table.where(F.col("embedding").isNotNull() & (F.size("embedding") == p.dims)).where(fine)
    # The bound is tested before the cast, which would wrap or raise beyond 64 bits.
    big = F.exists(x, lambda e: F.abs(e) * p.scale >= LIMIT - 1)
    safe = F.when(big, F.raise_error(F.lit(f"a component times {p.scale} is 2^27 or more"))).otherwise(x)
    return kept.select(F.col("vec_id").cast("long"), F.transform(safe, lambda e: F.floor(e * p.scale).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, p: ClusterParams) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes."""
    text = F.concat(F.lit(f"{p.salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.withColumn("h", F.sha2(text, 256)).orderBy("h", "vec_id", "v").limit(p.k).select("v").collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), p.dims)


def _matrix(column: pa.Array, dims: int, kind) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dims)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer matrices."""
    out = np.empty((len(a), len(b)), np.int64)
    for j, row in enumerate(b):
        diff = a - row
        out[:, j] = np.einsum("ij,ij->i", diff, diff)
    return out


def cache_pivots(vectors: DataFrame, pivots: np.ndarray, p: ClusterParams) -> DataFrame:
    """(vec_id, v, far): the vectors with their distances to all pivots, written to the shared folder."""

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column(1), p.dims, np.int64)
            far = np.sqrt(distances(v, pivots).astype(np.float64)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(far, pa.float32())], names=["vec_id", "v", "far"])

    return cut(map_arrow(vectors.select("vec_id", "v"), run, "vec_id long, v array<int>, far array<float>"))


class PivotBounds:
    """Lower bounds of distances to ``centroids`` from distances to ``pivots``."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        between = np.sqrt(distances(pivots, pivots).astype(np.float64))
        here = np.arange(len(pivots))
        self.partner = between.argmax(1)
        base = between[here, self.partner]
        moved = np.sqrt(distances(centroids, pivots).astype(np.float64))
        # Where all pivots are equal there is no pair and so no bound.
        inverse = np.divide(1.0, base, out=np.zeros_like(base), where=base > 0)
        self.own, self.other = moved[here, self.partner] * inverse, moved[here, here] * inverse

    def lower(self, far: np.ndarray) -> np.ndarray:
        a = far * self.own
        b = far[:, self.partner] * self.other
        return np.abs(a - b) - (a + b) * SLACK


def nearest(v: np.ndarray, far: np.ndarray, centroids: np.ndarray, bounds: PivotBounds) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number), squared distance, and how many pairs were checked."""
    low = bounds.lower(far.astype(np.float64))
    cluster = low.argmin(1)
    diff = v - centroids[cluster]
    best = np.einsum("ij,ij->i", diff, diff)
    limit = np.sqrt(best.astype(np.float64)) * (1 + 1e-12)
    checked = len(v)
    low[np.arange(len(v)), cluster] = np.inf
    for c, centroid in enumerate(centroids):
        rows = np.flatnonzero(low[:, c] <= limit)
        if not len(rows):
            continue
        checked += len(rows)
        diff = v[rows] - centroid
        d = np.einsum("ij,ij->i", diff, diff)
        wins = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        rows, d = rows[wins], d[wins]
        cluster[rows], best[rows] = c, d
        limit[rows] = np.sqrt(d.astype(np.float64)) * (1 + 1e-12)
    return cluster, best, checked


def _sums(cached: DataFrame, pivots: np.ndarray, centroids: np.ndarray, p: ClusterParams) -> list:
    """Per cluster: its number of vectors, their componentwise sums, and the pairs checked."""
    k = len(centroids)

    def run(batches):
        bounds = PivotBounds(pivots, centroids)
        n, checked, total = np.zeros(k, np.int64), 0, np.zeros((k, p.dims), np.int64)
        for batch in batches:
            v, far = _matrix(batch.column(0), p.dims, np.int64), _matrix(batch.column(1), k, np.float32)
            cluster, _, pairs = nearest(v, far, centroids, bounds)
            n += np.bincount(cluster, minlength=k)
            checked += pairs
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            total[found] += np.add.reduceat(v[order], starts, axis=0)
        some = np.flatnonzero(n)
        if len(some):
            share = np.where(np.arange(len(some)) == 0, checked, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(share, pa.int64()), _lists(total[some], pa.int64())],
                names=["cluster", "n", "checked", "s"],
            )

    parts = map_arrow(cached.select("v", "far"), run, "cluster int, n long, checked long, s array<bigint>")
    sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(p.dims)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("checked").alias("checked"), *sums).collect()


def _assigned(cached: DataFrame, pivots: np.ndarray, centroids: np.ndarray, p: ClusterParams) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    k = len(centroids)

    def run(batches):
        bounds = PivotBounds(pivots, centroids)
        for batch in batches:
            v, far = _matrix(batch.column(1), p.dims, np.int64), _matrix(batch.column(2), k, np.float32)
            cluster, best, _ = nearest(v, far, centroids, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(best, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return map_arrow(cached, run, "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, p: ClusterParams) -> tuple[np.ndarray, np.ndarray, DataFrame] | None:
    """Final centroids, the pivots and the table cached for them; None without vectors."""
    centroids = first_centroids(vectors, p)
    if not len(centroids):
        return None
    pivots, cached = centroids, cache_pivots(vectors, centroids, p)
    for _ in range(p.rounds):
        rows = _sums(cached, pivots, centroids, p)
        centroids = centroids.copy()
        for r in rows:
            centroids[r.cluster] = [r[f"s{i}"] // r.n for i in range(p.dims)]
        pairs = sum(r.n for r in rows) * len(centroids)
        if sum(r.checked for r in rows) > p.recache * pairs:
            pivots, cached = centroids, cache_pivots(cached, centroids, p)
    return centroids, pivots, cached


def cluster(table: DataFrame, params: ClusterParams | None = None) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector, and the centroids."""
    p = params or ClusterParams()
    vectors = cut(integer_vectors(table, p))
    model = fit(vectors, p)
    if model is None:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.empty((0, p.dims), np.int64)
    centroids, pivots, cached = model
    return _assigned(cached, pivots, centroids, p), centroids


def report(table: DataFrame, params: ClusterParams | None = None) -> DataFrame:
    """vec_id, cluster, distance, inertias of the cluster and of all, digest of the centroid."""
    spark = table.sparkSession
    assigned, centroids = cluster(table, params)
    assigned = cut(assigned)
    # As decimals: a sum over many rows may pass 64 bits on the way, not silently in the result.
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("i"))
    whole = F.sum("i").over(Window.partitionBy(F.lit(0)))  # over at most k rows
    inertia = inertia.select("cluster", F.col("i").cast("long").alias("cluster_inertia"), whole.cast("long").alias("inertia"))
    shas = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    digests = spark.createDataFrame(shas, "cluster int, centroid_sha256 string")
    of_cluster = inertia.join(digests, "cluster")
    return assigned.join(F.broadcast(of_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
