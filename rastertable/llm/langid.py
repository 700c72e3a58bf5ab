"""Language identification by error-correcting output codes.

Every language gets a codeword; each bit of it splits the languages in two
groups, and a linear classifier over hashed byte trigrams predicts the bit.
The classifiers' weights are log-odds between the two groups' trigram
distributions, counted over all learning documents; a bit's threshold lies
between the margins expected of the two groups and the gap between them says
how much its loss counts.  A text gets the language whose codeword has the
least weighted logistic loss; it is ambiguous if the runner-up is close.

Edge cases: a text that is null or has no letter gets ``und`` with score 0, and
so does every text if nothing can be learned.  With one learned language that
one is always chosen.  Ties go to the language first in order.  Only doc_id,
text and lang are read.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.llm.text import fold, map_arrow, raw_text

BUCKETS = 1 << 12


@dataclass(frozen=True)
class CodeParams:
    smoothing: float = 0.5
    steepness: float = 3.0
    sharpness: float = 8.0
    ambiguous_below: float = 0.1
    bits_per_doubling: int = 10


def _letters_table() -> np.ndarray:
    """Lower-case ASCII letters and all bytes beyond ASCII; the rest is a space."""
    t = np.full(256, 32, np.uint32)
    for c in range(26):
        t[97 + c] = t[65 + c] = 97 + c
    t[128:] = np.arange(128, 256)
    return t


FOLD = _letters_table()


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    a = FOLD[np.frombuffer(text, np.uint8)]
    if ((a >= 97) & (a <= 122)).any():
        return True
    return bool((a >= 128).any()) and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed trigrams; runs of anything but letters are one space."""
    a = FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    a = a[np.append(True, (a[1:] != 32) | (a[:-1] != 32))]
    if len(a) < 3:
        return np.zeros(BUCKETS, np.int64)
    x = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    return np.bincount((x * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)


def _count(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if has_letter(text):
                counts = trigrams(text)
                total[lang] = total[lang] + counts if lang in total else counts
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
            names=["lang", "bucket", "n"],
        )


def code_matrix(languages: int, p: CodeParams) -> np.ndarray:
    """Codewords (-1/+1): all splits of up to 7 languages, else drawn from a fixed seed."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 7:
        bits = [[1.0 if k == 0 or (s >> (k - 1)) & 1 else -1.0 for k in range(languages)] for s in range(2 ** (languages - 1) - 1)]
        return np.array(bits).T
    n = int(np.ceil(p.bits_per_doubling * np.log2(languages)))
    draw = np.random.default_rng(1).permuted(
        np.tile(np.where(np.arange(languages) % 2 == 0, 1.0, -1.0), (n, 1)), axis=1
    )
    return draw.T


class Model:
    """Bit classifiers and codewords from trigram counts per language."""

    def __init__(self, counts: dict[str, np.ndarray], p: CodeParams):
        self.params, self.languages = p, sorted(counts)
        self.code = code_matrix(len(self.languages), p)
        n_bits = self.code.shape[1]
        self.weights = np.zeros((BUCKETS, n_bits))
        self.threshold, self.half_gap = np.zeros(n_bits), np.ones(n_bits)
        if not n_bits:
            return
        prob = np.array([(counts[x] + p.smoothing) / (counts[x].sum() + p.smoothing * BUCKETS) for x in self.languages])
        for b in range(n_bits):
            one, zero = prob[self.code[:, b] > 0], prob[self.code[:, b] < 0]
            w = np.log(one.mean(0)) - np.log(zero.mean(0))
            expected = prob @ w
            low, high = expected[self.code[:, b] < 0].max(), expected[self.code[:, b] > 0].min()
            self.weights[:, b] = w
            self.threshold[b], self.half_gap[b] = (low + high) / 2, max((high - low) / 2, 1e-9)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score and whether it is ambiguous."""
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        counts, p = trigrams(text), self.params
        margin = counts @ self.weights / max(counts.sum(), 1)
        z = np.clip((margin - self.threshold) / self.half_gap, -3, 3)
        trust = self.half_gap / self.half_gap.sum()
        loss = (np.log1p(np.exp(-p.steepness * self.code * z)) * trust).sum(1)
        best = int(loss.argmin())
        likely = np.exp(-p.sharpness * (loss - loss[best]))
        likely /= likely.sum()
        second = np.partition(loss, 1)[1]
        return self.languages[best], float(likely[best]), bool(second - loss[best] < p.ambiguous_below)


def learn(docs: DataFrame, params: CodeParams | None = None) -> Model:
    """Count trigrams per language over all rows with text and language.

    What reaches the driver is bounded by languages x ``BUCKETS``.
    """
    rows = (
        map_arrow(
            docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
                raw_text().alias("text"), F.col("lang").cast("string")
            ),
            _count,
            "lang string, bucket int, n long",
        )
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
        .collect()
    )
    counts = {}
    for r in rows:
        counts[r["lang"]] = np.zeros(BUCKETS, np.int64)
        for c in r["counts"]:
            counts[r["lang"]][c["bucket"]] = c["n"]
    return Model(counts, params or CodeParams())


def predict(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document."""

    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column(2).to_pylist()]
            lang, score, unsure = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), (fold("doc_id", folds) == 0).alias("held_out"), raw_text().alias("text")),
        run,
        "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean",
    )


def identify(docs: DataFrame, params: CodeParams | None = None, folds: int = 5) -> DataFrame:
    """Learn from the rows that are not held out, then predict all rows."""
    return predict(docs, learn(docs.where(fold("doc_id", folds) != 0), params), folds)
