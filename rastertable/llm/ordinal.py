"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(theta_k - w.x) with one weight vector for all grades
and ordered thresholds.  x holds the square roots of the shares of hashed words
and of hashed word shapes in a text, and how many words repeat the one before.
The model is fitted in one task on at most ``rows`` rated documents, chosen by
a hash of the id, so its memory is bounded; all documents are then scored for
expected grade and for the probability of the top grades.

Edge cases: null and empty texts have no features and get the grades' base
rates.  Ratings that are null or outside 0..levels-1 are not used; several
ratings of one id count as their lowest, several texts of one as its smallest.  Without ratings all grades are
equally likely.  Only doc_id and text are read, so extra columns cannot clash.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.llm.text import Interner, fold, map_arrow, one_text, raw_text

_RUNS = ((re.compile(rb"[a-z]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"9"), (re.compile(rb"[\x80-\xff]+"), b"u"))


@dataclass(frozen=True)
class OrdinalParams:
    levels: int = 3
    buckets: int = 1 << 12
    rows: int = 10_000
    rounds: int = 200
    ridge: float = 1e-4
    select_from: int = 2
    select_at: float = 0.5


class Hashed:
    """Sparse features of texts: (text numbers, buckets, values)."""

    def __init__(self, buckets: int):
        # The first bucket counts repeated words.
        self.half = buckets // 2
        self.pairs: list[tuple[int, int]] = []
        self.words = Interner(self._build, self._clear)
        self._clear()

    def _clear(self) -> None:
        self.pairs.clear()
        self.table = np.zeros((0, 2), np.int64)

    def _build(self, word: bytes) -> None:
        shape = word
        for pattern, to in _RUNS:
            shape = pattern.sub(to, shape)
        self.pairs.append(
            (1 + xxhash.xxh3_64_intdigest(word.lower()) % (self.half - 1), self.half + xxhash.xxh3_64_intdigest(shape) % self.half)
        )

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.words.trim()
        split = [(t or b"").split() for t in texts]
        n = np.array([len(w) for w in split], np.int64)
        at = self.words.ids([w for ws in split for w in ws])
        if len(self.table) < len(self.pairs):
            self.table = np.vstack([self.table, np.array(self.pairs[len(self.table) :], np.int64)])
        doc = np.repeat(np.arange(len(texts)), n)
        again = np.flatnonzero((at[1:] == at[:-1]) & (doc[1:] == doc[:-1])) + 1
        size = 2 * self.half
        key = np.concatenate([doc * size + self.table[at, 0], doc * size + self.table[at, 1], doc[again] * size])
        key, count = np.unique(key, return_counts=True)
        doc, bucket = key // size, key % size
        return doc, bucket, np.sqrt(count / n[doc])


def _sparse(batches, p: OrdinalParams):
    hashed = Hashed(p.buckets)
    for batch in batches:
        doc, bucket, value = hashed.of(batch.column(0).to_pylist())
        offsets = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(bucket, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(value, pa.float32()))],
            names=["grade", "bucket", "value"],
        )


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(grade: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, p: OrdinalParams) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by Adam on the mean log likelihood."""
    # theta_0, then logarithms of the gaps keep the thresholds in order.
    below = np.array([(np.sum(grade <= k) + 1) / (len(grade) + p.levels) for k in range(p.levels - 1)])
    theta = np.log(below / (1 - below))
    free = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    w = np.zeros(p.buckets)
    x = np.concatenate([w, free])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, p.rounds + 1):
        w, free = x[: p.buckets], x[p.buckets :]
        theta = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        s = np.bincount(row, value * w[bucket], len(grade))
        edge = np.concatenate([[-1e3], theta, [1e3]])
        hi, lo = _sigmoid(edge[grade + 1] - s), _sigmoid(edge[grade] - s)
        like = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / like, lo * (1 - lo) / like
        g_w = np.bincount(bucket, value * (d_hi - d_lo)[row], p.buckets) / len(grade) + p.ridge * w
        g_theta = np.array([np.sum(d_lo[grade == k + 1]) - np.sum(d_hi[grade == k]) for k in range(p.levels - 1)]) / len(grade)
        g_free = np.cumsum(g_theta[::-1])[::-1] * np.concatenate([[1.0], np.exp(free[1:])])
        g = np.concatenate([g_w, g_free])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    free = x[p.buckets :]
    return x[: p.buckets], np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def _fit_table(table: pa.Table, p: OrdinalParams) -> pa.Table:
    bucket, value = table.column("bucket").combine_chunks(), table.column("value").combine_chunks()
    size = pa.compute.list_value_length(bucket).to_numpy()
    w, theta = fit(
        table.column("grade").to_numpy().astype(np.int64),
        np.repeat(np.arange(len(size)), size),
        bucket.flatten().to_numpy(),
        value.flatten().to_numpy().astype(float),
        p,
    )
    return pa.table({"weights": pa.array([w.tolist()], pa.list_(pa.float64())), "thresholds": pa.array([theta.tolist()], pa.list_(pa.float64()))})


def learn(docs: DataFrame, ratings: DataFrame, p: OrdinalParams) -> tuple[np.ndarray, np.ndarray]:
    """Fit on at most ``rows`` of the ratings (doc_id, grade)."""
    rows = (
        ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, p.levels - 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(p.rows)
    )
    # A bounded number of ids is broadcast; only their texts are moved, one an id.
    texts = docs.select(F.col("doc_id").cast("long"), raw_text().alias("text")).join(F.broadcast(rows), "doc_id")
    texts = one_text(texts, "grade")
    sparse = map_arrow(texts.select("text", "grade"), lambda b: _sparse(b, p), "grade int, bucket array<int>, value array<float>")
    found = sparse.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(lambda t: _fit_table(t, p), "weights array<double>, thresholds array<double>").first()
    if found is None:
        even = np.arange(1, p.levels) / p.levels
        return np.zeros(p.buckets), np.log(even / (1 - even))
    return np.array(found["weights"]), np.array(found["thresholds"])


def score(docs: DataFrame, ratings: DataFrame, params: OrdinalParams | None = None, folds: int = 5) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_probability, selected of every document.

    Ratings of ids in fold 0 are held out of the fit.
    """
    p = params or OrdinalParams()
    w, theta = learn(docs, ratings.where(fold("doc_id", folds) != 0), p)

    def rate(batches):
        hashed = Hashed(p.buckets)
        for batch in batches:
            doc, bucket, value = hashed.of(batch.column(2).to_pylist())
            s = np.bincount(doc, value * w[bucket], batch.num_rows)
            # P(grade > k) for each threshold; their sum is the expected grade.
            above = _sigmoid(s[:, None] - theta)
            tail = above[:, p.select_from - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(above.sum(1)), pa.array(tail), pa.array(tail >= p.select_at)],
                names=["doc_id", "held_out", "expected_grade", "tail_probability", "selected"],
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), (fold("doc_id", folds) == 0).alias("held_out"), raw_text().alias("text")),
        rate,
        "doc_id long, held_out boolean, expected_grade double, tail_probability double, selected boolean",
    )


def grades(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 poor, 1 good but toxic, 2 good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).alias("grade"))
