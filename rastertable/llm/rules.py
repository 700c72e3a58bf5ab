"""Quality rules: distribution divergence from language references.

Each language gets two reference histograms, taken over all its documents:
character classes and its most common words (plus one bin for the rest).  A
document's own histograms are compared with those of its language by
Jensen-Shannon distance (base 2, so 0..1).  Each comparison has a minimum
length below which a histogram says nothing and the rule does not fire.

Edge cases: a null text is an empty one; it has no words and fails the base
rules.  A null language is a language of its own.  References of the
``max_languages`` languages with the most words go to all tasks; documents of
other languages meet theirs by a join on the language.  Equal rows get equal results; ties among
common words are broken by the word.  Only doc_id, text and lang are read, so
extra columns cannot clash.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm.text import cut, map_arrow, raw_text

#: Character classes: a-z, A-Z, 0-9, white space, punctuation, other ASCII, beyond ASCII.
N_CLASSES = 7
PUNCTUATION = b".,;:!?'\"()-"
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class RuleParams:
    common_words: int = 100
    max_languages: int = 256
    min_chars: int = 200
    min_words: int = 100
    max_class_distance: float = 0.28
    max_word_distance: float = 0.44


def _class_table() -> np.ndarray:
    """Class of each byte; bytes inside a multi-byte character get ``N_CLASSES``."""
    table = np.full(256, 5, np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[list(WHITE)] = 3
    table[list(PUNCTUATION)] = 4
    table[0x80:0xC0] = N_CLASSES
    table[0xC0:] = 6
    return table


CLASS_OF_BYTE = _class_table()


def _classes(text: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF_BYTE[np.frombuffer(text, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]


FLUSH_WORDS = 200_000


def _count(batches):
    """Partial counts (lang, kind, key, n); kind 0: character class, 1: word, 2: all words."""
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def flush():
        rows = [(lang, 1, w, n) for lang, c in words.items() for w, n in c.items()]
        rows += [(lang, 2, b"", sum(c.values())) for lang, c in words.items()]
        rows += [(lang, 0, b"%d" % k, int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
        words.clear()
        classes.clear()
        for k in range(0, len(rows), 50_000):
            lang, kind, key, n = zip(*rows[k : k + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(key, pa.binary()), pa.array(n, pa.int64())],
                names=["lang", "kind", "key", "n"],
            )

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                words.setdefault(lang, Counter()).update(text.lower().split())
                classes[lang] = classes.get(lang, 0) + _classes(text)
        if sum(map(len, words.values())) > FLUSH_WORDS:
            yield from flush()
    yield from flush()


#: Class histogram, common words with their bins, word histogram.
Reference = tuple[np.ndarray, dict[bytes, int], np.ndarray]
NO_REFERENCE: Reference = (np.zeros(N_CLASSES), {}, np.zeros(1))


def _reference(rows) -> Reference:
    """The reference that a language's ranked counts (kind, rank, key, n) describe."""
    classes = np.zeros(N_CLASSES)
    common, total = [], 0
    for r in sorted(rows, key=lambda r: (r["kind"], r["rank"])):
        if r["kind"] == 0:
            classes[int(r["key"])] = r["n"]
        elif r["kind"] == 1:
            common.append((bytes(r["key"]), r["n"]))
        else:
            total += r["n"]
    hist = np.array([n for _, n in common] + [total - sum(n for _, n in common)], float)
    return classes / max(classes.sum(), 1), {w: k for k, (w, _) in enumerate(common)}, hist / max(hist.sum(), 1)


def references(docs: DataFrame, p: RuleParams) -> tuple[dict[str, Reference], DataFrame | None]:
    """References of the languages with most words, and (lang, ref) rows of the others, if there are any.

    The first are at most ``max_languages`` x ``common_words`` words; a row of
    the second holds at most ``common_words``.
    """
    counts = (
        map_arrow(
            docs.select(raw_text().alias("text"), F.coalesce("lang", F.lit("")).alias("lang")),
            _count,
            "lang string, kind int, key binary, n long",
        )
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    # Read several times below, so the counts are kept once in the shared folder.
    counts = cut(counts)
    totals = counts.where("kind = 2").orderBy(F.desc("n"), "lang").limit(p.max_languages + 1).collect()
    langs = [r["lang"] for r in totals[: p.max_languages]]
    # Two ranks: the first over a share of a language's words, the second over the winners.
    order = [F.desc("n"), "key"]
    share = F.pmod(F.xxhash64("key"), F.lit(64))
    ranked = (
        counts.where("kind = 1")
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order)))
        .where(F.col("rank") <= p.common_words)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= p.common_words)
        .unionByName(counts.where("kind <> 1").withColumn("rank", F.lit(0)))
    )
    of_lang: dict[str, list] = {}
    for r in ranked.where(F.col("lang").isin(langs)).collect() if langs else []:
        of_lang.setdefault(r["lang"], []).append(r)
    frequent = {lang: _reference(rows) for lang, rows in of_lang.items()}
    if len(totals) <= p.max_languages:
        return frequent, None
    others = ranked.where(~F.col("lang").isin(langs)).groupBy("lang")
    return frequent, others.agg(F.collect_list(F.struct("kind", "rank", "key", "n")).alias("ref"))


class _References:
    """The reference of each document of a task."""

    LIMIT = 256

    def __init__(self, frequent: dict[str, Reference]):
        self.frequent, self.met = frequent, {}

    def of(self, lang: str, rows: list | None = None) -> Reference:
        if lang in self.frequent or rows is None:
            return self.frequent.get(lang, NO_REFERENCE)
        if lang not in self.met:
            if len(self.met) >= self.LIMIT:
                self.met.clear()
            self.met[lang] = _reference(rows)
        return self.met[lang]


def _with_references(docs: DataFrame, p: RuleParams, fn, schema) -> DataFrame:
    """``fn(batch, reference of a row)`` over all documents; where needed the batch ends with the column of references."""
    frequent, others = references(docs, p)
    lang = F.coalesce("lang", F.lit(""))

    def near(batches):
        found = _References(frequent)
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            yield fn(batch, [found.of(x or "") for x in langs])

    if others is None:
        return map_arrow(docs, near, schema)
    # Only documents of languages that are rare by words are shuffled, so no language is hot.
    name = "ref_"
    while name in docs.columns:
        name += "_"
    known = lang.isin(list(frequent))
    rare = others.select(F.col("lang").alias(name), F.col("ref").alias(name + "_"))
    far_docs = docs.where(~known).join(rare, lang == F.col(name), "left").drop(name)

    def far(batches):
        found = _References({})
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            refs = [found.of(x or "", rows or []) for x, rows in zip(langs, batch.column(batch.num_columns - 1).to_pylist())]
            yield fn(batch.select(batch.schema.names[:-1]), refs)

    return map_arrow(docs.where(known), near, schema).union(map_arrow(far_docs, far, schema))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2; 0 if either histogram is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    m = (p + q) / 2

    def kl(a):
        k = a > 0
        return float((a[k] * np.log2(a[k] / m[k])).sum())

    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    repeated = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= repeated
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def _rate(text: bytes | None, ref: Reference, p: RuleParams) -> tuple:
    """The result columns of one document but its id."""
    text = text or b""
    words = text.split()
    n = len(words)
    classes = _classes(text)
    n_chars, n_repeat = int(classes.sum()), _repeat_words(words)
    failed = n < 50 or 100 * n_repeat > 50 * n
    ref_classes, common, ref_words = ref
    d_class = d_word = 0.0
    if n_chars >= p.min_chars:
        d_class = js_distance(classes / n_chars, ref_classes)
    if n >= p.min_words:
        bins = np.zeros(len(ref_words))
        for w, c in Counter(text.lower().split()).items():
            bins[common.get(w, -1)] += c
        d_word = js_distance(bins / n, ref_words)
    return (
        n,
        n_chars - int(classes[3]),
        sum(text.count(s) for s in SYMBOLS),
        _dup_lines(text),
        n_repeat,
        failed,
        not failed and d_class <= p.max_class_distance and d_word <= p.max_word_distance,
        round(d_class, 6),
        round(d_word, 6),
    )


KEPT = 6


def quality_rules(docs: DataFrame, params: RuleParams | None = None) -> DataFrame:
    """One row per document: base counts, both distances and the verdict."""
    p = params or RuleParams()

    def rate(batch, refs):
        rows = [_rate(text, ref, p) for text, ref in zip(batch.column(1).to_pylist(), refs)]
        cols = list(zip(*rows)) if rows else [()] * 9
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return _with_references(docs.select(F.col("doc_id").cast("long"), raw_text().alias("text"), "lang"), p, rate, SCHEMA)


def keep_good(docs: DataFrame, params: RuleParams | None = None) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    p = params or RuleParams()
    text_at = docs.columns.index("text")

    def keep(batch, refs):
        texts = batch.column(text_at).cast(pa.binary()).to_pylist()
        return batch.filter(pa.array([_rate(t, ref, p)[KEPT] for t, ref in zip(texts, refs)], pa.bool_()))

    return _with_references(docs, p, keep, docs.schema)
