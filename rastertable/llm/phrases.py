"""Phrase collocation mining with HAT-trie counting.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into
words ``[^\\x20\\x09]+``.  Every task counts phrases in a trie over word ids:
its leaves are hash tables ("containers") for a range of the first word, and a
container that grows beyond ``burst`` phrases is split at a word boundary, on
the first word while it holds several, below it on the second and third.  When
a task holds more than ``entries`` phrases, it spills whole containers, those
with the fewest repetitions first.  Every subtree of them, the phrases of one
first word, becomes ``spread`` runs by a digit of the second word, sorted by
their words; one row holds a run.  The shuffle brings the runs of one prefix
(language, first word, digit) to one partition, where they are merged; the
digits spread the subtree of a frequent word.

Texts are read three times.  First 64-bit hashes of words are added up, then
those of longer phrases of frequent words.  What occurs ``min_count`` times is
marked in a filter of bounded size, which the last pass uses where texts are
read, so that the tries hold frequent phrases only.  Counts are of the words
themselves: equal hashes or a full filter cost work and decide nothing.

A phrase of ``min_count`` occurrences is scored by its weakest cut,
``floor(1000000 a a / (l r))`` in decimals of 38 digits (exact for counts below
10^15), and dropped if a longer candidate holds it in half of its occurrences.

Edge cases: a null text has no words, a null lang is ``und``; both together
with empty texts add nothing.  Repeated rows count as often as they occur.  A
lang without candidates has no rows.  A word may hold any character that is no
separator, NUL included.  Only lang and text are read.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm import bloom
from rastertable.llm.text import U64, Interner, cut, map_arrow, mix64, odd_constants, raw_text

#: Bits of a word id in a packed phrase of up to three words; id 0 marks a break or no word.
BITS = 21
MASK = (1 << BITS) - 1

#: Separators of pieces become full stops; a word holds no full stop.
_BREAKS = bytes(ord(".") if chr(i) in ".,;:!?\x0a\x0b\x0c\x0d" else i for i in range(256))


@dataclass(frozen=True)
class PhraseParams:
    min_count: int = 10
    top: int = 2000
    contained_percent: int = 50
    burst: int = 16_384
    entries: int = 1_200_000
    words: int = 500_000
    hashes: int = 4_000_000
    spread: int = 8
    filter_bits: int = 27


class HatTrie:
    """Counts of packed phrases in containers over ranges of the trie's leaves."""

    def __init__(self, burst: int):
        self.burst = burst
        self.starts: list[int] = [0]
        self.tables: list[Counter] = [Counter()]
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        """Count every key once for each time it is given."""
        if not len(keys):
            return
        keys = np.sort(keys)
        cuts = np.searchsorted(keys, np.array([*self.starts[1:], np.iinfo(np.int64).max]), "left")
        listed, begin, full = keys.tolist(), 0, []
        for i, end in enumerate(cuts.tolist()):
            if end > begin:
                table = self.tables[i]
                before = len(table)
                table.update(listed[begin:end])
                self.size += len(table) - before
                if len(table) > self.burst:
                    full.append(i)
            begin = end
        for i in reversed(full):
            self._split(i)

    def _split(self, i: int) -> None:
        """Burst a container into two or more of at most ``burst`` phrases, at word boundaries."""
        items = sorted(self.tables[i].items())
        starts, tables = [], []
        todo = [(self.starts[i], items)]
        while todo:
            start, part = todo.pop()
            if len(part) <= self.burst:
                starts.append(start)
                tables.append(Counter(dict(part)))
                continue
            at = self._boundary(part)
            todo.append((part[at][0] >> self.shift << self.shift, part[at:]))
            todo.append((start, part[:at]))
        self.starts[i : i + 1] = starts
        self.tables[i : i + 1] = tables

    def _boundary(self, part: list) -> int:
        """Where to cut a sorted container: between words, at the shallowest depth that has several."""
        low, high = part[0][0], part[-1][0]
        self.shift = next(s for s in (2 * BITS, BITS, 0) if low >> s != high >> s)
        middle = len(part) // 2
        word = part[middle][0] >> self.shift
        keys = np.fromiter((k >> self.shift for k, _ in part), np.int64, len(part))
        at = int(np.searchsorted(keys, word, "left"))
        return at if at else int(np.searchsorted(keys, word, "right"))

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of whole containers, until at most ``keep`` phrases are left."""
        order = sorted(range(len(self.tables)), key=lambda i: sum(self.tables[i].values()) / max(len(self.tables[i]), 1))
        keys, counts = [], []
        for i in order:
            if self.size <= keep:
                break
            table = self.tables[i]
            keys.append(np.fromiter(table.keys(), np.int64, len(table)))
            counts.append(np.fromiter(table.values(), np.int64, len(table)))
            self.size -= len(table)
            self.tables[i] = Counter()
        if not keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(keys), np.concatenate(counts)


class Vocabulary:
    """Ids and hashes of the words a task has met."""

    def __init__(self):
        self.words = Interner(lambda word: self.fresh.append(xxhash.xxh3_64_intdigest(word)), lambda: None)
        self.start()

    def start(self) -> None:
        self.words.clear()
        self.fresh: list[int] = []
        self.known = np.empty(0, U64)
        self.words[b"."]  # the break is id 0

    def ids(self, words: list[bytes]) -> np.ndarray:
        return self.words.ids(words)

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        if self.fresh:
            self.known = np.append(self.known, np.array(self.fresh, U64))
            self.fresh.clear()
        return self.known[ids]


def phrase_hashes(h: np.ndarray, words: np.ndarray, lang: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For phrases of 1, 2 and 3 words: the hash of the phrase at each place, and whether there is one."""
    a, b, c = odd_constants(3, 13)
    base = h * a + U64(xxhash.xxh3_64_intdigest(lang.encode()))
    pair = base[:-1] + h[1:] * b
    two = words[:-1] & words[1:]
    return [(mix64(base), words), (mix64(pair), two), (mix64(pair[:-1] + h[2:] * c), two[:-1] & two[1:])]


#: One row per run: the words after the first as lines, and their counts.
SCHEMA = "lang string, w1 string, digit int, tails string, n array<bigint>"


class _Counting:
    """The tries of one task, by language."""

    def __init__(self, p: PhraseParams, frequent: np.ndarray):
        self.p, self.frequent = p, frequent
        self.vocabulary = Vocabulary()
        self.tries: dict[str, HatTrie] = {}
        self.totals: Counter = Counter()

    def add(self, lang: str, ids: np.ndarray, starts: int) -> None:
        """Count the phrases that begin at the first ``starts`` of the ids, which have breaks between pieces."""
        trie = self.tries.setdefault(lang, HatTrie(self.p.burst))
        words = ids != 0
        self.totals[lang] += int(words[:starts].sum())
        key = ids << (2 * BITS)
        for size, (h, there) in enumerate(phrase_hashes(self.vocabulary.hashes(ids), words, lang)):
            if size:
                key = key[:-1] | ids[size:] << (2 - size) * BITS
            at = np.flatnonzero(there[:starts])
            trie.add(key[at[bloom.maybe_in(self.frequent, h[at])]])

    def many_words(self) -> bool:
        return len(self.vocabulary.words) > self.p.words

    def many_phrases(self) -> bool:
        return sum(t.size for t in self.tries.values()) > self.p.entries

    def take(self, parts: list[tuple[str, np.ndarray, int]]):
        """Count some texts; yields the runs that have to be spilled."""
        for lang, ids, starts in parts:
            self.add(lang, ids, starts)
            if self.many_phrases():
                yield from self.runs(self.p.entries // 2)
        # With new ids the tries start anew, so they are spilled whole.
        if self.many_words():
            yield from self.runs(0)
            self.tries.clear()
            self.vocabulary.start()

    def runs(self, keep: int):
        """Spill all tries down to ``keep`` phrases in all; each run is sorted by its words."""
        held = max(sum(t.size for t in self.tries.values()), 1)
        for lang, trie in self.tries.items():
            keys, counts = trie.spill(keep * trie.size // held)
            if len(keys):
                yield from self._batches(lang, keys, counts)

    def _batches(self, lang: str, keys: np.ndarray, counts: np.ndarray):
        listed = list(self.vocabulary.words)
        parts = [keys >> (2 * BITS), (keys >> BITS) & MASK, keys & MASK]
        used = np.unique(np.concatenate(parts))
        # Ranks of the words in byte order; id 0, no word, is the empty one.
        texts = [b"" if i == 0 else listed[i] for i in used.tolist()]
        order = sorted(range(len(texts)), key=texts.__getitem__)
        words = [texts[j].decode() for j in order]
        rank = np.empty(len(used), np.int64)
        rank[order] = np.arange(len(used))
        first, second, third = (rank[np.searchsorted(used, part)] for part in parts)
        digit = np.array([xxhash.xxh3_64_intdigest(w) % self.p.spread for w in words])[second]
        run = np.lexsort((third, second, digit, first))
        first, second, third, digit, counts = (x[run] for x in (first, second, third, digit, counts))
        starts = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (digit[1:] != digit[:-1])))
        ends = np.append(starts[1:], len(first))
        for s in range(0, len(starts), 5_000):
            a, b = starts[s : s + 5_000], ends[s : s + 5_000]
            lines = [f"{words[x]} {words[y]}" if y else words[x] for x, y in zip(second[a[0] : b[-1]].tolist(), third[a[0] : b[-1]].tolist())]
            tails = ["\n".join(lines[i:j]) for i, j in zip((a - a[0]).tolist(), (b - a[0]).tolist())]
            offsets = pa.array(np.append(a - a[0], b[-1] - a[0]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(a), pa.string()),
                    pa.array([words[x] for x in first[a].tolist()], pa.string()),
                    pa.array(digit[a], pa.int32()),
                    pa.array(tails, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(counts[a[0] : b[-1]])),
                ],
                names=["lang", "w1", "digit", "tails", "n"],
            )


#: Words that are turned into ids and counted at a time.
CHUNK = 200_000


def _pieces(batches, vocabulary: Vocabulary, chunk: int = CHUNK):
    """Lists of (lang, word ids, number of starts); a longer text comes in parts that know the next two words."""
    stop = np.zeros(1, np.int64)
    for batch in batches:
        by_lang: dict[str, list[np.ndarray]] = {}
        held = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = text.as_py().lower().translate(_BREAKS).replace(b".", b" . ").split()
            if len(words) > chunk:
                for s in range(0, len(words), chunk):
                    yield _joined(by_lang) + [(lang, vocabulary.ids(words[s : s + chunk + 2]), chunk)]
                    by_lang, held = {}, 0
                continue
            by_lang.setdefault(lang, []).extend((vocabulary.ids(words), stop))
            held += len(words)
            if held > chunk:
                yield _joined(by_lang)
                by_lang, held = {}, 0
        yield _joined(by_lang)


def _joined(by_lang: dict[str, list[np.ndarray]]) -> list[tuple[str, np.ndarray, int]]:
    parts = [(lang, np.concatenate(ids)) for lang, ids in by_lang.items()]
    return [(lang, ids, len(ids)) for lang, ids in parts]


def _texts(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), raw_text().alias("text"))
    return texts.where(F.col("text").isNotNull())


def frequent_filter(docs: DataFrame, p: PhraseParams, words: np.ndarray | None = None) -> np.ndarray:
    """The filter of all words with ``min_count``, or of phrases of 2 and 3 words that ``words`` holds."""
    shared = None if words is None else docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        vocabulary, held, size = Vocabulary(), [], 0

        def summed():
            h, n = np.unique(np.concatenate(held) & ~U64(255), return_counts=True)
            while len(h):
                # A row is one number: the hash, and a count of up to 255 in its last byte.
                packed = (h | np.minimum(n, 255).astype(U64)).view(np.int64)
                for s in range(0, len(packed), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(packed[s : s + 100_000])], names=["h"])
                h, n = h[n > 255], n[n > 255] - 255

        for parts in _pieces(batches, vocabulary):
            for lang, ids, starts in parts:
                h, there = vocabulary.hashes(ids), ids != 0
                found = phrase_hashes(h, there, lang)[:1]
                if shared is not None:
                    found = phrase_hashes(h, there & bloom.maybe_in(shared.value, found[0][0]), lang)[1:]
                for key, there in found:
                    held.append(key[:starts][there[:starts]])
                    size += len(held[-1])
            if size > p.hashes:
                yield from summed()
                held.clear()
                size = 0
            if len(vocabulary.words) > p.words:
                vocabulary.start()
        if held:
            yield from summed()

    # Rows are summed in the tasks already, so they are dealt out before Spark sums them.
    key = F.shiftright("h", 8).alias("key")
    sums = map_arrow(_texts(docs), run, "h long").select(key, F.col("h").bitwiseAND(255).alias("n")).repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    return bloom.build(sums.where(F.col("n") >= p.min_count).select(F.shiftleft("key", 8).alias("h")), "h", p.filter_bits)


def frequent_phrases(docs: DataFrame, params: PhraseParams | None = None) -> DataFrame:
    """(lang, w1, w2, w3, n, size): phrases of 1 to 3 words with ``min_count``; size 0 holds all words of a language.

    Words that a phrase does not have are empty.
    """
    p = params or PhraseParams()
    words = frequent_filter(docs, p)
    shared = docs.sparkSession.sparkContext.broadcast(words | frequent_filter(docs, p, words))

    def run(batches):
        here = _Counting(p, shared.value)
        for parts in _pieces(batches, here.vocabulary):
            yield from here.take(parts)
        yield from here.runs(0)
        if here.totals:
            langs, n = zip(*here.totals.items())
            rows = [[x, None, -1, "", [k]] for x, k in zip(langs, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64())))],
                names=["lang", "w1", "digit", "tails", "n"],
            )

    runs = map_arrow(_texts(docs), run, SCHEMA).repartition("lang", "w1", "digit")
    lines = runs.select("lang", "w1", "digit", F.explode(F.arrays_zip(F.split("tails", "\n", -1).alias("tail"), F.col("n").alias("n"))).alias("x"))
    counts = lines.groupBy("lang", "w1", "digit", F.col("x.tail").alias("tail")).agg(F.sum("x.n").alias("n"))
    found = cut(counts.where(F.col("w1").isNull() | (F.col("n") >= p.min_count)))
    at = F.instr("tail", " ")
    w2 = F.when(at > 0, F.substring("tail", F.lit(1), at - 1)).otherwise(F.col("tail"))
    w3 = F.when(at > 0, F.substring("tail", at + 1, F.length("tail"))).otherwise(F.lit(""))
    size = F.when(F.col("w1").isNull(), 0).when(F.col("tail") == "", 1).when(at == 0, 2).otherwise(3)
    return found.select("lang", "w1", w2.alias("w2"), w3.alias("w3"), "n", size.alias("size"))


def _cut_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exact."""
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def candidates(found: DataFrame, p: PhraseParams) -> DataFrame:
    """(lang, phrase, a, l, r, score): all phrases of two and three words that are not dropped."""
    space = F.lit(" ")
    words = found.where("size = 1").select("lang", F.col("w1").alias("w"), F.col("n").alias("f"))
    pairs = found.where("size = 2").select("lang", F.col("w1").alias("x"), F.col("w2").alias("y"), F.col("n").alias("f"))

    def word(of: str, name: str) -> DataFrame:
        return words.select("lang", F.col("w").alias(of), F.col("f").alias(name))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select("lang", F.col("x").alias(first), F.col("y").alias(second), F.col("f").alias(name))

    three = found.where("size = 3").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    within = three.select("lang", "w1", "w2", "a").union(three.select("lang", F.col("w2"), F.col("w3"), "a"))
    longer = within.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    dropped = 100 * F.col("longer") >= p.contained_percent * F.col("a")
    two = found.where("size = 2").select("lang", "w1", "w2", F.col("n").alias("a")).join(longer, ["lang", "w1", "w2"], "left")
    two = two.where(~F.coalesce(dropped, F.lit(False))).join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat("w1", space, "w2").alias("phrase"), "a", "l", "r", _cut_score("a", "l", "r").alias("score"))
    # Every part of a phrase occurs at least as often, so no join loses one.
    three = three.join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
    three = three.join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
    cuts = [F.struct(_cut_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.select("lang", F.concat("w1", space, "w2", space, "w3").alias("phrase"), "a", F.least(*cuts).alias("cut"))
    return two.union(three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def mine(docs: DataFrame, params: PhraseParams | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of every language."""
    p = params or PhraseParams()
    found = frequent_phrases(docs, p)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each share of a language, so that no task sorts all its phrases.
    shares = candidates(found, p).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    shares = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= p.top)
    best = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= p.top)
    totals = found.where("size = 0").select("lang", "n")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
