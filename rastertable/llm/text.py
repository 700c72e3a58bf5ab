"""Helpers shared by the text operators: words, hashes and bounded Arrow batches.

Texts reach Python as UTF-8 bytes.  ``bytes.split()`` splits at exactly the
white space ``[\\x20\\x09-\\x0D]`` and ``bytes.lower()`` lowers exactly A-Z.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 512
U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few rows, so that long texts fit a Python worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it from there.

    Cuts the lineage and survives lost executors.  Only where the session names
    no folder, as in tests, a local one is made.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="checkpoint-"))
    # A checkpoint that remembers its plan's constraints cannot be joined with
    # itself ("key not found"), so none are derived while it is made.
    conf, name = df.sparkSession.conf, "spark.sql.constraintPropagation.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return df.checkpoint()
    finally:
        conf.set(name, before)


def id_text(doc_id: str = "doc_id") -> Column:
    """The document id as text; a null id counts as empty."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return (F.crc32(id_text(doc_id).cast("binary")) % folds).cast("int")


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key for rows of equal id and text; such repeated rows share all results."""
    return F.xxhash64(F.col(doc_id), F.col(text), F.lit(11))


def raw_text(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null stays null."""
    return F.col(text).cast("string").cast("binary")


def one_text(rows: DataFrame, label: str) -> DataFrame:
    """(doc_id, label, text), one row an id with its smallest text, so that a sample of ids is one of rows too."""
    return rows.groupBy("doc_id", label).agg(F.min("text").alias("text"))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with small batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


class Interner(dict):
    """Dense numbers for byte strings; ``build(word)`` is called once per new word.

    It is a cache: ``trim`` empties it between batches once it is full.
    """

    def __init__(self, build: Callable[[bytes], None], clear: Callable[[], None], limit: int = 1_000_000):
        super().__init__()
        self.build, self.clear_values, self.limit = build, clear, limit

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.build(word)
        return n

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
            self.clear_values()

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class WordHashes(dict):
    """Cache of 64-bit word hashes."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (two multiply-xorshift rounds)."""
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(29))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers from a seed."""
    return mix64(np.arange(1, n + 1, dtype=U64) * U64(2 * seed + 1)) | U64(1)


def window_hashes(h: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """Hashes of all ``size``-word windows of word hashes ``h``."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for k, c in enumerate(odd_constants(size, seed)):
        out += h[k : k + n] * c
    return mix64(out)
