"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of punctuation; numbers (with their units)
and names become typed placeholders.  Windows of canonical words are hashed and
joined with the windows of the benchmark items; what a placeholder stood for is
kept as a slot value.  Hits on one diagonal (same offset between document and
item) form runs.  A run counts if it is long enough and its slots are
consistent: every value of the item always became the same value of the
document, be it the same (a copy) or another one (a re-parameterised item).
Runs of windows with equal values are also judged on their own, so that one
changed value does not hide a copied passage.

A window that is mostly placeholders matches too much to be joined by itself.
It is compared on the diagonals where a window with enough plain words matched,
so that it continues a run but never starts one.  Copies need no plain words:
windows of the words themselves, case-folded and without placeholders, are
joined as well, and a run of them counts if it is long enough.  Whether a word
is taken for a name depends on its case and on the word before it; these
windows depend on neither, so copies are found in any case and after anything.

Only windows that pass a bounded filter of the benchmark's windows leave the
task that reads a text; the join then is exact.  Items shorter than a window
are searched whole; those with fewer than ``least`` words say too little and
are never matched.  Items without any window of enough plain words are found
as copies only.  The length of a run is in canonical words, that of a copy in
words.

Edge cases: null and empty texts hold nothing.  Repeated rows get the same
result.  Several items may share windows; the smallest item_id is reported.
Only doc_id and text (item_id and text) are read.  An empty benchmark flags
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm import bloom
from rastertable.llm.text import U64, Interner, cut, doc_key, map_arrow, raw_text, window_hashes

# --- fixed values: number words, units and common given names -----------------
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yards mile miles mg g kg lb lbs oz pounds ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars cent cents euro euros pound percent % degrees celsius fahrenheit mph kmh km/h m/s hz w kw v"
).split()
GIVEN_NAMES = (
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph "
    "jessica thomas sarah charles karen anna tom alice bob emma liam olivia noah sophia lucas mia paul marie pierre "
    "hans peter maria carlos juan jose lucia"
).split()
# --- end of fixed values -------------------------------------------------------

DROP, PLAIN, NUMBER, QUANTITY, UNIT, CAPITAL, NAME = range(7)
_NUMBER = re.compile(rb"[+-]?[0-9][0-9.,:/]*")
_QUANTITY = re.compile(rb"[+-]?[0-9][0-9.,:/]*(%|[A-Za-z]{1,3})")
_STRIP = b".,;:!?\"'()[]{}<>*_`|#&$"
#: Kinds of windows: the words themselves, enough plain words, mostly placeholders.
COPY, TEMPLATE, DENSE = range(3)
_PLACEHOLDER = {NUMBER: U64(0x11), QUANTITY: U64(0x22), NAME: U64(0x33)}


@dataclass(frozen=True)
class TemplateParams:
    window: int = 10
    run: int = 13
    least: int = 4
    plain_share: float = 0.6


class Canonical:
    """Flat canonical words of a batch of texts."""

    def __init__(self):
        self.kind, self.ends, self.hash = [], [], []
        self.words = Interner(self._build, self._clear)
        self.fixed = {w.encode(): NUMBER for w in NUMBER_WORDS} | {w.encode(): UNIT for w in UNITS} | {w.encode(): NAME for w in GIVEN_NAMES}
        self._arrays()

    def _clear(self) -> None:
        self.kind, self.ends, self.hash = [], [], []
        self._arrays()

    def _arrays(self) -> None:
        self.table = [np.zeros(0, np.int8), np.zeros(0, bool), np.zeros(0, U64)]

    def _build(self, word: bytes) -> None:
        core = word.strip(_STRIP)
        lower = core.decode("utf-8", "replace").lower().encode()
        kind = PLAIN
        if not core:
            kind = DROP
        elif lower in self.fixed and not (self.fixed[lower] == NAME and core[:1].islower()):
            kind = self.fixed[lower]
        elif _NUMBER.fullmatch(core):
            kind = NUMBER
        elif _QUANTITY.fullmatch(core):
            kind = QUANTITY
        else:
            text = core.decode("utf-8", "replace")
            if text[0].isupper() and len(text) > 1 and text[1:].islower():
                kind = CAPITAL
        self.kind.append(kind)
        self.ends.append(word.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b":"))
        # Folded, so that an upper-cased "ß" (SS) or final sigma is the same word.
        self.hash.append(xxhash.xxh3_64_intdigest(core.decode("utf-8", "replace").casefold().encode()))

    def of(self, texts: list[bytes | None]):
        """(document numbers, hashes, plain flags, starts in ``words``, words) of canonical
        words, and (document numbers, hashes) of the words themselves."""
        self.words.trim()
        split = [(t or b"").split() for t in texts]
        doc = np.repeat(np.arange(len(split)), [len(w) for w in split])
        words = [w for ws in split for w in ws]
        at = self.words.ids(words)
        if len(self.table[0]) < len(self.kind):
            new = len(self.table[0])
            extra = (np.array(self.kind[new:], np.int8), np.array(self.ends[new:], bool), np.array(self.hash[new:], U64))
            self.table = [np.concatenate(x) for x in zip(self.table, extra)]
        kind, ends, h = (t[at] for t in self.table)
        kept = np.flatnonzero(kind != DROP)
        doc, kind, ends, h = doc[kept], kind[kept], ends[kept], h[kept]
        own = doc, h
        n = len(kept)
        with_before = np.zeros(n, bool)
        with_before[1:] = doc[1:] == doc[:-1]
        before = lambda flags: np.append(False, flags[:-1])[:n] & with_before
        kind = np.where((kind == CAPITAL) & ~before(~ends), PLAIN, np.where(kind == CAPITAL, NAME, kind))
        unit = (kind == UNIT) & before(kind == NUMBER)
        kind = np.where((kind == UNIT) & ~unit, PLAIN, kind)
        followed = np.append(unit[1:], False)[:n]
        kind = np.where((kind == NUMBER) & followed, QUANTITY, kind)
        stay = ~unit & ~((kind == NAME) & before(kind == NAME))
        for k, value in _PLACEHOLDER.items():
            h = np.where(kind == k, value, h)
        return doc[stay], h[stay], (kind == PLAIN)[stay], kept[stay], words, own


def _slots(words: list[bytes], start: np.ndarray, plain: np.ndarray, first: int, size: int) -> list[str]:
    """Values of the placeholders in a window, in order."""
    out = []
    for k in range(first, first + size):
        if not plain[k]:
            end = start[k + 1] if k + 1 < len(start) and start[k + 1] - start[k] < 8 else start[k] + 1
            out.append(b" ".join(w.strip(_STRIP) for w in words[start[k] : end]).decode("utf-8", "replace").lower())
    return out


_WINDOWS = "key long, pos int, size int, w long, kind int, slots array<string>, total int"


def _joined_on(at: np.ndarray, doc: np.ndarray, enough: np.ndarray) -> np.ndarray:
    """Of consecutive windows ``at`` of one document, those of stretches with a window of enough plain words."""
    stretch = np.cumsum(np.append(True, (np.diff(at) != 1) | (doc[at[1:]] != doc[at[:-1]]))[: len(at)])
    return at[np.bincount(stretch, weights=enough[at])[stretch] > 0] if len(at) else at


def _windows(batches, p: TemplateParams, sizes: dict[int, list[int]] | None, bits):
    """(key, text) batches to windows; of whole items if ``sizes`` is None, else those in the filter."""
    canonical = Canonical()
    every = list(range(p.least, p.window + 1))
    for batch in batches:
        keys = np.array(batch.column(0).to_pylist(), np.int64)
        doc, h, plain, start, words, own = canonical.of(batch.column(1).to_pylist())
        plains = np.concatenate([[0], np.cumsum(plain)])
        rows = []

        def usable(doc, h, size, seed):
            """Window hashes, numbers of the windows to look at, and words before and in each document."""
            total = np.bincount(doc, minlength=len(keys))
            w = window_hashes(h, size, seed=seed)
            first = np.arange(len(w))
            ok = doc[first] == doc[first + size - 1] if len(w) else np.zeros(0, bool)
            if sizes is None:
                # An item has windows of the full size, or one of its own size if it is shorter.
                ok &= np.where(total[doc[first]] >= p.window, size == p.window, total[doc[first]] == size)
            else:
                ok &= bloom.maybe_in(bits.value, w)
            return w.view(np.int64), np.flatnonzero(ok), np.cumsum(total) - total, total

        for size in sizes[COPY] if sizes is not None else every:
            w, at, begin, total = usable(*own, size, 1000 + size)
            rows += [(keys[d], k - begin[d], size, w[k], COPY, [], total[d]) for k, d in zip(at, own[0][at])]
        for size in sizes[TEMPLATE] if sizes is not None else every:
            w, at, begin, total = usable(doc, h, size, size)
            enough = plains[size:] - plains[:-size] >= p.plain_share * size
            for k in _joined_on(at, doc, enough):
                d = doc[k]
                kind = TEMPLATE if enough[k] else DENSE
                rows.append((keys[d], k - begin[d], size, w[k], kind, _slots(words, start, plain, k, size), total[d]))
        if rows:
            cols = zip(*rows)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=["key", "pos", "size", "w", "kind", "slots", "total"]
            )


def contaminated(docs: DataFrame, benchmark: DataFrame, params: TemplateParams | None = None) -> DataFrame:
    """(dk, items, item_id, run): documents with a run that counts, their number of
    items, the smallest item_id and the longest run in canonical words."""
    p = params or TemplateParams()
    items = benchmark.select("item_id", F.xxhash64("item_id", "text").alias("ik"), raw_text().alias("text"))
    of_items = cut(
        map_arrow(items.select("ik", "text"), lambda b: _windows(b, p, None, None), _WINDOWS)
        .join(items.groupBy("ik").agg(F.min("item_id").alias("item_id")), F.col("key") == F.col("ik"))
        .select("ik", "item_id", F.col("pos").alias("ipos"), "size", "w", "kind", F.col("slots").alias("islots"), F.col("total"))
    )
    kinds = {(r["kind"], r["size"]) for r in of_items.select("kind", "size").distinct().collect()}
    sizes = {kind: sorted(size for k, size in kinds if k == kind) for kind in (COPY, TEMPLATE)}
    bits = docs.sparkSession.sparkContext.broadcast(bloom.build(of_items, "w"))
    found = map_arrow(docs.select(doc_key().alias("dk"), raw_text().alias("text")), lambda b: _windows(b, p, sizes, bits), _WINDOWS)
    # Read once for each kind: written once, so that texts are read once.
    found = cut(found.select(F.col("key").alias("dk"), "pos", "size", "w", "kind", "slots").distinct())

    def of_kind(windows: DataFrame, kind: int) -> DataFrame:
        return windows.where(F.col("kind") == kind).drop("kind")

    offset = (F.col("pos") - F.col("ipos")).alias("diag")
    columns = ["dk", "ik", "item_id", "pos", "ipos", "size", "slots", "islots", "total"]
    enough = cut(of_kind(found, TEMPLATE).join(of_kind(of_items, TEMPLATE), ["w", "size"]).select(*columns, F.lit(True).alias("enough")))
    dense = (
        enough.select("dk", "ik", "size", offset)
        .distinct()
        .join(of_kind(of_items, DENSE), ["ik", "size"])
        .withColumn("pos", F.col("ipos") + F.col("diag"))
        .join(of_kind(found, DENSE), ["dk", "pos", "size", "w"])
        .select(*columns, F.lit(False).alias("enough"))
    )
    copies = of_kind(found, COPY).drop("slots").join(of_kind(of_items, COPY), ["w", "size"])
    hits = enough.union(dense).withColumn("diag", offset).withColumn("same", F.col("slots") == F.col("islots"))
    # Consecutive windows of one diagonal; a group holds at most the windows of one item.
    diag = ["dk", "ik", "diag"]
    hits = hits.withColumn("island", F.col("ipos") - F.row_number().over(Window.partitionBy(*diag).orderBy("ipos")))
    number = F.row_number().over(Window.partitionBy(*diag, "enough").orderBy("ipos"))
    hits = hits.withColumn("island_enough", F.col("ipos") - number)
    # Read three times below.
    hits = cut(hits)
    hits = hits.withColumn("island_same", F.col("ipos") - F.row_number().over(Window.partitionBy(*diag, "same").orderBy("ipos")))
    pairs = F.array_distinct(F.flatten(F.collect_list(F.arrays_zip(F.col("islots").alias("i"), F.col("slots").alias("d")))))
    need = F.least(F.lit(p.run), F.col("total"))
    run = [(F.count("*") + F.max("size") - 1).alias("run"), F.max("total").alias("total"), F.min("item_id").alias("item_id")]

    def runs(rows: DataFrame, island: str) -> DataFrame:
        return (
            rows.groupBy(*diag, island)
            .agg(*run, pairs.alias("pairs"), F.max("enough").alias("enough"))
            .where(F.col("run") >= need)
            .where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["i"]))))
            .select("dk", "ik", "item_id", "run", "enough")
        )

    # A run with other values needs a window of enough plain words.  Runs without windows of
    # mostly placeholders are also judged on their own: the others may not be consistent.
    changed = runs(hits, "island").where("enough").union(runs(hits.where("enough"), "island_enough"))
    copies = copies.withColumn("diag", offset)
    copies = copies.withColumn("island", F.col("ipos") - F.row_number().over(Window.partitionBy(*diag).orderBy("ipos")))
    copied = copies.groupBy(*diag, "island").agg(*run).where(F.col("run") >= need).select("dk", "ik", "item_id", "run")
    every = changed.union(runs(hits.where("same"), "island_same")).drop("enough").union(copied)
    return every.groupBy("dk").agg(F.countDistinct("ik").alias("items"), F.min("item_id").alias("item_id"), F.max("run").alias("run"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: TemplateParams | None = None) -> DataFrame:
    """The documents without a run that counts, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), doc_key().alias("dk"))
    return rows.join(contaminated(docs, benchmark, params), "dk", "left_anti").select("row.*")


def report(docs: DataFrame, benchmark: DataFrame, params: TemplateParams | None = None) -> DataFrame:
    """doc_id, n_items, item_id, longest_run and kept of every document."""
    rows = docs.select("doc_id", doc_key().alias("dk"))
    return rows.join(contaminated(docs, benchmark, params), "dk", "left").select(
        "doc_id",
        F.coalesce("items", F.lit(0)).cast("long").alias("n_items"),
        "item_id",
        F.coalesce("run", F.lit(0)).cast("long").alias("longest_run"),
        F.col("items").isNull().alias("kept"),
    )
