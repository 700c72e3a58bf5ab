"""Nearest neighbours by inner product with collision-counting hashing.

Inner products become distances: vectors are divided by the largest norm M of
their block and get one more component that makes them unit vectors, queries
are unit vectors with a zero there, so the nearest vector has the largest inner
product.  Each of ``projections`` random directions is one hash function: the
block's projections are kept as a sorted array.  A query opens a window around
its own projection in every array.  A vector that falls into the window of
radius ``window * R`` collides; at distance R it does so in a known share of
all functions, and a vector with at least ``threshold`` collisions is verified
with its full inner product.  Radii grow by ``ratio`` (virtual rehashing: the
windows only widen), from two steps below the nearest of a few vectors looked at
first, and a query stops at the first R within which it has all ``k`` results.
Narrow windows are read from the sorted arrays, wide ones compared with every
vector's place in them.  A vector at distance R or less has fewer
collisions than the threshold with the probability of ``miss`` standard
deviations or less, so nothing but that chance is lost: there is no cap on
candidates or window sizes, and beyond the largest distance all vectors of a
block are verified if results are missing.

Vectors are hashed into blocks of bounded size, queries into groups of bounded
size; every group meets every block once in a task of its own, which sorts the
block's projections and returns ``k`` results a query; these are merged per
query.

Edge cases: null vectors, zero vectors and vectors with null or non-finite
components take no part; only vectors of equal length are compared.  A null id
is no query, but a candidate, and comes last among ties.  Rows equal in id and
vector count once.  A query's own rows are all rows with its id; if they hold
several vectors, each of them is a query with results of its own.  Fewer than
``k`` candidates are all returned.  Only vec_id and embedding are read.  An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm.text import cut


@dataclass(frozen=True)
class NeighbourParams:
    k: int = 20
    every: int = 20
    projections: int = 64
    window: float = 1.0
    miss: float = 1.2
    first_radius: float = 0.3
    ratio: float = 1.12
    probe: int = 512
    back: int = 2
    block: int = 16_384
    group: int = 1_024
    seed: int = 12

    @property
    def share(self) -> float:
        """Chance that a vector at distance R collides in one function."""
        return math.erf(self.window / math.sqrt(2))

    @property
    def threshold(self) -> int:
        m, s = self.projections, self.share
        return max(1, math.ceil(m * s - self.miss * math.sqrt(m * s * (1 - s))))

    @property
    def radii(self) -> list[float]:
        steps = math.ceil(math.log(2 / self.first_radius) / math.log(self.ratio))
        return [self.first_radius * self.ratio**j for j in range(steps + 1)]


def directions(dims: int, p: NeighbourParams) -> np.ndarray:
    """Random directions whose products with a unit vector have variance 1.

    In many dimensions they are orthogonal in sets, which makes counts less
    random; in few, products of such sets are not normal enough.
    """
    rng = np.random.default_rng([p.seed, dims])
    if dims < 32:
        return rng.standard_normal((p.projections, dims))
    sets = [np.linalg.qr(rng.standard_normal((dims, dims)))[0].T for _ in range(-(-p.projections // dims))]
    return np.concatenate(sets)[: p.projections] * math.sqrt(dims)


class Block:
    """The sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, p: NeighbourParams):
        self.ids, self.x, self.p = ids, x, p
        scaled = x / np.abs(x).max()
        norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        unit = scaled / norms.max()
        rest = np.sqrt(np.maximum(0, 1 - (norms / norms.max()) ** 2))
        self.directions = directions(x.shape[1] + 1, p)
        products = self.directions @ np.concatenate([unit, rest[:, None]], axis=1).T
        self.order = np.argsort(products, axis=1)
        self.sorted = np.take_along_axis(products, self.order, axis=1)
        self.ranks = np.empty(self.order.shape, np.uint16 if len(x) < 2**16 else np.uint32)
        np.put_along_axis(self.ranks, self.order, np.arange(len(x), dtype=self.ranks.dtype)[None, :], axis=1)
        self.unit = unit.astype(np.float32)
        #: More than the error of an inner product of two vectors of length 1 or less in 32 bits.
        self.slack = (x.shape[1] + 4) * 2.0**-22

    def _windows(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the windows: query x radius x function."""
        radii = np.array(self.p.radii) * self.p.window
        at = q @ self.directions[:, :-1].T
        lo = np.empty((len(q), len(radii), len(self.sorted)), np.int64)
        hi = np.empty_like(lo)
        for i, values in enumerate(self.sorted):
            lo[:, :, i] = np.searchsorted(values, at[:, i, None] - radii, "left")
            hi[:, :, i] = np.searchsorted(values, at[:, i, None] + radii, "right")
        return lo, hi

    def search(self, q_ids: np.ndarray, q: np.ndarray):
        """Per query: positions and scores of the block's ``k`` best vectors found."""
        unit = q / np.abs(q).max(1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for s in range(0, len(q), 128):  # bounds the memory of the windows
            lo, hi = self._windows(unit[s : s + 128])
            for j, own in enumerate(q_ids[s : s + 128]):
                rows = self._reached(own, unit[s + j].astype(np.float32), lo[j], hi[j])
                # Each row is summed alone and in one order, so equal vectors have equal scores.
                scores = (self.x[rows] * q[s + j]).sum(1)
                first = np.lexsort((self.ids[rows], -scores))[: self.p.k]
                yield rows[first], scores[first]

    def _collisions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many windows every vector is in."""
        n = len(self.x)
        if 16 * int((hi - lo).sum()) < self.ranks.size:
            inside = [o[a:b] for o, a, b in zip(self.order, lo.tolist(), hi.tolist())]
            return np.bincount(np.concatenate(inside), minlength=n)
        # Wide windows are compared with the places of all vectors in the sorted arrays.
        kind = self.ranks.dtype
        inside = (self.ranks - lo.astype(kind)[:, None]) < (hi - lo).astype(kind)[:, None]
        return np.add.reduce(inside.view(np.int8), axis=0, dtype=np.int8 if len(lo) < 128 else np.int64)

    def _reached(self, own: int, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """All verified vectors that may be among the ``k`` best."""
        p = self.p
        waiting = self.ids != own
        wanted = min(p.k, int(waiting.sum()))
        rows, near = np.empty(0, np.int64), np.empty(0, np.float32)
        # Some vectors tell about how far the nearest are; smaller radii would find none.
        probe = (self.unit[: p.probe] @ q)[waiting[: p.probe]]
        guess = math.sqrt(max(0.0, 2 - 2 * float(probe.max()))) if len(probe) else 0.0
        start = max(0, sum(radius < guess for radius in p.radii) - p.back)
        for r, radius in list(enumerate(p.radii))[start:]:
            reached = np.flatnonzero(waiting & (self._collisions(lo[r], hi[r]) >= p.threshold))
            if len(reached):
                waiting[reached] = False
                rows, near = self._closest(np.append(rows, reached), np.append(near, self.unit[reached] @ q))
            if len(rows) >= wanted and (wanted == 0 or 2 - 2 * (np.partition(near, -wanted)[-wanted] - self.slack) <= radius**2):
                return rows
        if len(rows) < wanted:
            rows = np.append(rows, np.flatnonzero(waiting))
        return rows

    def _closest(self, rows: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) <= self.p.k:
            return rows, near
        keep = near >= np.partition(near, -self.p.k)[-self.p.k] - 2 * self.slack
        return rows[keep], near[keep]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


#: Stands for a null id where ids are numbers; sorted last among ties.
NO_ID = np.iinfo(np.int64).max


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy()


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, x, dims, h): the distinct rows that take part, with a hash of id and vector."""
    whole = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = table.where(F.col("embedding").isNotNull()).where(whole & F.exists("embedding", lambda e: e != 0))
    return (
        kept.select(F.col("vec_id").cast("long"), F.col("embedding").alias("x"))
        .withColumn("h", F.xxhash64("vec_id", "x"))
        .dropDuplicates(["h", "vec_id", "x"])
        .withColumn("dims", F.size("x"))
    )


def search(table: DataFrame, params: NeighbourParams | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest vectors of every query."""
    p = params or NeighbourParams()
    vectors = cut(valid_vectors(table))
    is_query = F.col("vec_id") % p.every == 0
    size = vectors.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, groups = max(1, -(-size.n // p.block)), max(1, -(-size.q // p.group))
    # The two numbers come from different bits of the hash, so that groups and blocks are independent.
    block = F.pmod("h", F.lit(blocks)).cast("int").alias("block")
    group = F.pmod(F.shiftright("h", 20), F.lit(groups)).cast("int").alias("grp")
    data = vectors.select("vec_id", "x", "dims", block, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    queries = vectors.where(is_query).select(
        "vec_id", "x", "h", "dims", group, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    schema = "query_id long, h long, vec_id long, score double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            ids, hashes = _ids(right["vec_id"]), right["h"].to_numpy()
            here = Block(_ids(left["vec_id"]), _matrix(left["x"]), p)
            for own, h, (rows, scores) in zip(ids, hashes, here.search(ids, _matrix(right["x"]))):
                parts.append((np.full(len(rows), own), np.full(len(rows), h), here.ids[rows], scores))
        cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 3 + [np.empty(0)]
        found = pa.array(cols[2], pa.int64(), mask=cols[2] == NO_ID)
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), found, pa.array(cols[3], pa.float64())], names=["query_id", "h", "vec_id", "score"])

    keys = ["dims", "block", "grp"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, schema)
    best = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")
