"""Line deduplication with a suffix array over line ids.

All documents, ordered by id, form one sequence of line ids (64-bit hashes of
the lines without white space at their ends; lines without text are left out)
with a break after each document.  Prefix doubling names every suffix by its
first 1, 2, 4, ... lines: the name at depth 2d joins the names at depth d of
the suffix and of the one d lines further on.  Suffixes of equal name form an
interval of the suffix array whose longest common prefix is d or more.  An
interval of one suffix is finished and leaves the work, so after the first
depth only repeated lines are left.

Every maximal run of lines that repeats an earlier run and has ``min_chars``
characters is deleted whole: the first copy of a run stays and later ones go.
A run of any length is the union of its shortest sub-runs with ``min_chars``
that begin or end at one of its lines, for each of its lines has ``min_chars``
characters after it, or before it, or lies in the shortest sub-run that ends
with the run.  A sub-run has at most ``min_chars`` lines, and two overlapping
names of its largest depth 2^t name it, so depths end there.  Names
that no such sub-run can hold, because they have ``min_chars`` without their
first and without their last line, leave the work too.  Copies may overlap what
they repeat.

Edge cases: a null text stays null; an empty line is never deleted.  Rows of
equal id and text are one document and get one result; null ids come last.
Runs never cross documents.  Other columns pass through.  An empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertable.llm.text import cut, doc_key, map_arrow, raw_text

WHITE = " \t\x0b\x0c\r"


@dataclass(frozen=True)
class LineParams:
    min_chars: int = 40


def shortest_runs(chars: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, the lines of the shortest run with ``least`` characters that begins, and that ends there; 0 for none."""
    end = np.cumsum(chars)
    start = end - chars
    at = np.arange(len(chars))
    begins = np.searchsorted(start, start + least - 1, "right") - at
    ends = at + 1 - np.searchsorted(end, end - least + 1, "left")
    total = end[-1] if len(end) else 0
    return np.where(total - start >= least, begins, 0), np.where(end >= least, ends, 0)


def _line_table(docs: DataFrame, p: LineParams) -> DataFrame:
    """(doc_id, dk, line, raw, name, chars, begins, ends): non-empty lines, numbered with and without empty ones."""

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, dk, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = [(raw, t.strip(WHITE)) for raw, t in enumerate(text.decode().split("\n"))]
                lines = [(raw, t) for raw, t in lines if t]
                chars = np.array([len(t) for _, t in lines], np.int64)
                names = np.array([xxhash.xxh3_64_intdigest(t.encode()) for _, t in lines], np.uint64).view(np.int64)
                n = len(lines)
                out.append(([doc_id] * n, [dk] * n, np.arange(n), [raw for raw, _ in lines], names, chars, *shortest_runs(chars, p.min_chars)))
                if sum(len(x[0]) for x in out) > 20_000:
                    yield _line_batch(out)
                    out = []
            yield _line_batch(out)

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), doc_key().alias("dk"), raw_text().alias("text"))
    return map_arrow(texts, run, "doc_id long, dk long, line int, raw int, name long, chars int, begins int, ends int")


def _line_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "dk", "line", "raw", "name", "chars", "begins", "ends"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array([x for part in c for x in part], k) for c, k in zip(cols, kinds)], names=names)


def _intervals(suffixes: DataFrame) -> DataFrame:
    """Suffixes whose name occurs again, and whether an earlier one has it.

    The order of suffixes is that of documents (null ids last), then lines.
    """
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "dk", "line")
    first = suffixes.groupBy("name").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    return suffixes.join(first, "name").withColumn("later", place != F.col("first")).drop("n", "first")


def later_lines(docs: DataFrame, params: LineParams | None = None) -> DataFrame:
    """(dk, lines): the lines to delete of each document, as (line, raw) numbers."""
    p = params or LineParams()
    lines = cut(_line_table(docs.select("doc_id", "text"), p).distinct())
    # Most lines occur once; they go before the intervals are formed.
    again = lines.groupBy("name").count().where("count > 1").select("name")
    level = cut(_intervals(lines.join(again, "name")))
    repeated = level.select("dk", "line", "raw")
    found = level.where(F.col("later") & (F.col("begins") == 1)).select("dk", "line", F.lit(1).alias("size"))
    # The shortest runs of several lines, by where they begin.
    begin = level.where("begins > 1").select("doc_id", "dk", "line", F.col("begins").alias("size"))
    end = level.where("ends > 1").select("doc_id", "dk", (F.col("line") - F.col("ends") + 1).alias("line"), F.col("ends").alias("size"))
    runs = cut(begin.union(end).distinct())
    level = level.select("doc_id", "dk", "line", "name", F.col("chars").alias("head"), F.col("chars").alias("tail"), "chars")
    depth = 1
    while depth < p.min_chars and not level.isEmpty():
        # Blocks of 2^t lines to 2^(t+1) - 1, named by the names at their first and last 2^t lines.
        if depth > 1:
            found = found.union(_later_runs(runs.where((F.col("size") >= depth) & (F.col("size") < 2 * depth)), level, depth))
        ahead = level.select("dk", (F.col("line") - depth).alias("line"), F.col("name").alias("name2"), F.col("chars").alias("chars2"), F.col("tail").alias("tail2"))
        wider = level.join(ahead, ["dk", "line"]).select(
            "doc_id", "dk", "line", F.xxhash64("name", "name2").alias("name"), "head", F.col("tail2").alias("tail"), (F.col("chars") + F.col("chars2")).alias("chars")
        )
        useful = F.col("chars") - F.greatest("head", "tail") < p.min_chars
        depth, level = 2 * depth, cut(_intervals(wider.where(useful)).drop("later"))
    if depth > 1:
        found = found.union(_later_runs(runs.where(F.col("size") >= depth), level, depth))
    covered = found.select("dk", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("size") - 1)).alias("line")).distinct()
    return repeated.join(covered, ["dk", "line"]).groupBy("dk").agg(F.collect_list(F.struct("line", "raw")).alias("lines"))


def _later_runs(runs: DataFrame, level: DataFrame, depth: int) -> DataFrame:
    """(dk, line, size) of the runs of ``depth`` lines or more that occur earlier."""
    first = level.select("dk", "line", F.col("name").alias("a"))
    last = level.select("dk", F.col("line").alias("at"), F.col("name").alias("b"))
    named = runs.join(first, ["dk", "line"]).withColumn("at", F.col("line") + F.col("size") - depth).join(last, ["dk", "at"])
    return _intervals(named.withColumn("name", F.xxhash64("size", "a", "b"))).where("later").select("dk", "line", "size")


def _rows(docs: DataFrame, p: LineParams | None) -> DataFrame:
    """(row, text, n_lines, n_deleted, n_runs): every row with its cleaned text."""
    keyed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"), doc_key().alias("dk"))
    joined = keyed.join(later_lines(docs, p), "dk", "left").select("row", "text", "lines")
    schema = T.StructType(
        [joined.schema["row"], joined.schema["text"], *(T.StructField(c, T.LongType()) for c in ("n_lines", "n_deleted", "n_runs"))]
    )

    def clean(batches):
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is None:
                    out.append((None, 0, 0, 0))
                    continue
                parts = text.split("\n")
                if found:
                    gone, at = {x["raw"] for x in found}, {x["line"] for x in found}
                    text = "\n".join(t for k, t in enumerate(parts) if k not in gone)
                    out.append((text, len(parts), len(gone), sum(k - 1 not in at for k in at)))
                else:
                    out.append((text, len(parts), 0, 0))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])], names=schema.names
            )

    return map_arrow(joined, clean, schema)


def dedup_lines(docs: DataFrame, params: LineParams | None = None) -> DataFrame:
    """The documents, with all their columns, without later copies of repeated runs."""
    return _rows(docs, params).select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame, params: LineParams | None = None) -> DataFrame:
    """doc_id, n_lines, n_deleted, n_runs and the cleaned text of every document."""
    return _rows(docs, params).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_deleted", "n_runs", "text")
