"""Language-model scoring by logistic mixing of hashed-context bit predictors.

The model predicts a lower-cased text byte by byte, each byte bit by bit, and
an end mark after the last byte.  For contexts of 1 to 5 bytes it knows, per
context and leading bits of the byte, how often the next bit was 0 and 1 over
the learning texts.  The predictions meet in the logistic domain: a weight
set, chosen by the longest context seen before, how often it was seen, and the
bit's position (the gate), mixes them, and a final map from (previous byte,
mixed prediction) to observed frequency refines the result.  Weights and map
are learned online from a share of the learning texts that the contexts do not
count, so long contexts are trusted as far as they deserve on unseen texts.

All a byte's cost depends on is a window of six bytes.  Windows are counted
once per learning text and merged by Spark.  Contexts of 1 and 2 bytes, at
most 2^16, are packed into tables of at most 32 MB.  Longer contexts grow with
the corpus and stay distributed: counts are dealt by the hash of the three
bytes before the predicted one, so that whole contexts of 3 to 5 bytes meet in
one task, sorted, and are read in chunks of whole contexts.  One such group
holds at most the 2^24 windows of its other three bytes, at any scale.

Costs of at most ``top_windows`` frequent windows are broadcast; all others
are computed beside their contexts and joined to the documents exactly.

The base score is add-one over words and one end per text.  Counts of at most
``top_words`` frequent words are broadcast; all other words are joined exactly.

Edge cases: a null text is an empty one: no word, one end mark.  Rows of equal
id and text share results.  Without learning texts every word is unknown and
all bits are even.  Only doc_id and text are read.  An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertable.llm.text import U64, Interner, cut, doc_key, fold, id_text, map_arrow, mix64, raw_text

SHORT = (1, 2)
LONG = (3, 4, 5)
ORDERS = SHORT + LONG
WINDOW = 6
END_BYTE = b"\xff"
# Kinds of counts: words, windows of learning texts, windows of texts kept for tuning; and windows to be scored.
WORD, LEARNING, TUNING, ASKED = range(4)
END_WORD = xxhash.xxh3_64_intdigest(b" ")
# Bounds of a Python worker's and of Spark's memory: bytes of texts cut to windows at once (about 50 bytes
# each), windows counted before they leave, and rows of a batch that leaves.
TEXT_BYTES = 1 << 19
HELD = 2_000_000
OUT_ROWS = 1 << 16
CONFIDENCES = 3
GATES = (len(ORDERS) + 1) * CONFIDENCES * 8
STEP = 12 / 2047
LIMIT = 8.3


@dataclass(frozen=True)
class MixParams:
    top_windows: int = 1 << 20
    top_words: int = 1 << 19
    tuning_share: int = 8
    rate: float = 0.3
    buckets: int = 33


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows that predict each byte and the end mark, and the text each belongs to."""
    pad = b"\0" * (WINDOW - 1)
    flat = np.frombuffer(b"".join(pad + t + END_BYTE for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    w = np.zeros(max(len(flat) - WINDOW + 1, 0), U64)
    for k in range(WINDOW):
        w |= flat[k : k + len(w)].astype(U64) << U64(8 * (WINDOW - 1 - k))
    owner = np.repeat(np.arange(len(texts)), sizes)
    # A window starts inside its own text's padding or text; those that would end in the next padding go.
    starts = np.cumsum(sizes + WINDOW - 1) - (sizes + WINDOW - 1)
    at = np.arange(len(owner)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return w[at], owner


def _parts(texts: list[bytes]):
    """Runs of texts of at most ``TEXT_BYTES`` bytes, longer texts alone: (place of the first, texts)."""
    s, size = 0, 0
    for e, t in enumerate(texts):
        if e > s and size + len(t) > TEXT_BYTES:
            yield s, texts[s:e]
            s, size = e, 0
        size += len(t) + WINDOW
    if texts:
        yield s, texts[s:]


def _count(batches):
    """(tuning, text) batches to partial counts of words and of windows for learning and tuning."""
    words: Counter = Counter()
    parts: dict[int, list[np.ndarray]] = {LEARNING: [], TUNING: []}
    held, texts_seen = 0, 0

    def batch(kind, key, n):
        # Spark holds a batch outside its heap, so they are to be small.
        for s in range(0, len(key), OUT_ROWS):
            k, part = key[s : s + OUT_ROWS], n[s : s + OUT_ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(part, pa.int64())], names=["kind", "key", "n"]
            )

    def flush():
        nonlocal held, texts_seen
        if words or texts_seen:
            keys = np.array([xxhash.xxh3_64_intdigest(w) for w in words] + [END_WORD], U64)
            n = np.array([*words.values(), texts_seen], np.int64)
            words.clear()
            yield from batch(WORD, keys, n)
        for kind, arrays in parts.items():
            if arrays:
                w = np.concatenate(arrays)
                arrays.clear()
                w.sort()
                first = np.append(np.flatnonzero(np.append(True, w[1:] != w[:-1])), len(w))
                yield from batch(kind, w[first[:-1]], np.diff(first))
        held = texts_seen = 0

    for b in batches:
        groups: dict[int, list[bytes]] = {LEARNING: [], TUNING: []}
        for tuning, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            text = (text or b"").lower()
            words.update(text.split())
            texts_seen += 1
            groups[TUNING if tuning else LEARNING].append(text)
        for kind, texts in groups.items():
            # A batch of very long texts does not hold all windows at once.
            for _, some in _parts(texts):
                w = windows_of(some)[0]
                parts[kind].append(w)
                held += len(w)
                if held > HELD:
                    yield from flush()
        if len(words) > 200_000:
            yield from flush()
    yield from flush()


def _slots(windows: np.ndarray, order: int, bit: int) -> np.ndarray:
    """Slots of a short context and of the byte's leading bits, for one bit."""
    byte = windows & U64(255)
    context = (windows >> U64(8)) & U64((1 << (8 * order)) - 1)
    node = (U64(1) << U64(bit)) | (byte >> U64(8 - bit))
    return ((context << U64(8)) | node).astype(np.int64)


def _bit(windows: np.ndarray, bit: int) -> np.ndarray:
    return ((windows >> U64(7 - bit)) & U64(1)).astype(np.int64)


def _stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + 0.3) / (n0 + 0.3)), -12, 12)


def _short_counts(batches):
    """Window counts to partial (order, slot, n0, n1) of the short contexts."""
    for b in batches:
        w = b.column(0).to_numpy().view(U64)
        n = b.column(1).to_numpy()
        for order in SHORT:
            slot = np.concatenate([_slots(w, order, k) for k in range(8)])
            one = np.concatenate([_bit(w, k) for k in range(8)])
            u, inv = np.unique(slot, return_inverse=True)
            n8 = np.tile(n, 8).astype(float)
            n1 = np.bincount(inv, n8 * one, len(u)).astype(np.int64)
            n0 = np.bincount(inv, n8 * (1 - one), len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(u), order, np.int32)), pa.array(u, pa.int32()), pa.array(n0), pa.array(n1)],
                names=["order", "slot", "n0", "n1"],
            )


PACK = 16


def _pack(table: pa.Table) -> pa.Table:
    """One block of 2^16 slots: prediction in the high 12 bits, confidence in the low 4."""
    slot = table.column("slot").to_numpy() & ((1 << PACK) - 1)
    n0, n1 = table.column("n0").to_numpy().astype(float), table.column("n1").to_numpy().astype(float)
    confidence = np.minimum(1 + np.log2(n0 + n1).astype(np.int64), 15)
    out = np.zeros(1 << PACK, np.int16)
    out[slot] = (np.round(_stretch(n0, n1) / STEP).astype(np.int64) * 16 + confidence).astype(np.int16)
    return pa.table({"order": table.column("order")[:1].cast(pa.int32()), "block": table.column("block")[:1], "data": pa.array([out.tobytes()], pa.binary())})


class ShortContexts:
    """Predictions after contexts of 1 and 2 bytes: the blocks that hold any, and an empty one."""

    def __init__(self, blocks: list[tuple[int, int, bytes]]):
        self.place = {order: np.zeros(1 << (8 * order - 8), np.int64) for order in SHORT}
        self.data = np.zeros((len(blocks) + 1, 1 << PACK), np.int16)
        for k, (order, block, data) in enumerate(blocks, 1):
            self.place[order][block] = k
            self.data[k] = np.frombuffer(data, np.int16)

    def of(self, order: int, w: np.ndarray, bit: int) -> np.ndarray:
        slot = _slots(w, order, bit)
        return self.data[self.place[order][slot >> PACK], slot & ((1 << PACK) - 1)]


class LongContexts:
    """Counts after contexts of 3 to 5 bytes, for windows whose 3-byte contexts are here as a whole."""

    def __init__(self, w: np.ndarray, n: np.ndarray):
        self.levels = {}
        for order in LONG:
            key = w & U64((1 << (8 * order + 8)) - 1)
            by = np.argsort(key, kind="stable")
            self.levels[order] = key[by], np.append(0, np.cumsum(n[by]))

    def path(self, order: int, w: np.ndarray):
        """(zeros, ones) seen after the context and the leading bits of the byte, for each bit."""
        keys, total = self.levels[order]
        key = w & U64((1 << (8 * order + 8)) - 1)
        # Windows that agree in context and leading bits are neighbours; each bit halves their range.
        lo, hi = np.searchsorted(keys, key & ~U64(255)), np.searchsorted(keys, key | U64(255), "right")
        for bit in range(8):
            half = ((key >> U64(8 - bit)) << U64(8 - bit)) | U64(128 >> bit)
            mid = np.searchsorted(keys, half)
            yield total[mid] - total[lo], total[hi] - total[mid]
            one = _bit(w, bit) == 1
            lo, hi = np.where(one, mid, lo), np.where(one, hi, mid)


class Mixer:
    """Short contexts, weights and final map; computes the cost of windows beside their long contexts."""

    def __init__(self, short: ShortContexts, p: MixParams):
        self.short, self.p = short, p
        self.weights = np.full((GATES, len(ORDERS) + 1), 0.3, np.float32)
        self.weights[:, -1] = 0
        self.map: np.ndarray | None = None

    def inputs(self, w: np.ndarray, long: LongContexts):
        """Stretched predictions (with a constant) and the gate, for each bit."""
        paths = [long.path(order, w) for order in LONG]
        for bit in range(8):
            x = np.zeros((len(w), len(ORDERS) + 1), np.float32)
            seen, sure = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
            for k, order in enumerate(SHORT):
                v = self.short.of(order, w, bit)
                x[:, k] = (v >> 4) * np.float32(STEP)
                met = (v & 15) > 0
                seen[met] = k + 1
                sure = np.where(met, (v & 15) - 1, sure)
            for k, path in enumerate(paths, len(SHORT)):
                n0, n1 = next(path)
                met = np.flatnonzero(n0 + n1)
                a, b = n0[met].astype(float), n1[met].astype(float)
                x[met, k] = _stretch(a, b)
                seen[met] = k + 1
                sure[met] = np.log2(a + b).astype(np.int64)
            x[:, -1] = 0.3
            # Seen once, 2 to 7 times, or more often.
            level = (sure > 0).astype(np.int64) + (sure > 2)
            yield x, (seen * CONFIDENCES + level) * 8 + bit

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip((x * self.weights[gate]).sum(1), -LIMIT, LIMIT)

    def bucket(self, w: np.ndarray, s: np.ndarray) -> np.ndarray:
        at = np.round((s + LIMIT) / (2 * LIMIT) * (self.p.buckets - 1)).astype(np.int64)
        return ((w >> U64(8)) & U64(255)).astype(np.int64) * self.p.buckets + at

    def log10(self, w: np.ndarray, long: LongContexts) -> np.ndarray:
        """log10 probability of the last byte of each window."""
        out = np.zeros(len(w))
        for bit, (x, gate) in enumerate(self.inputs(w, long)):
            s = self.mixed(x, gate)
            p1 = 1 / (1 + np.exp(-s.astype(float)))
            if self.map is not None:
                p1 = (p1 + self.map[self.bucket(w, s)]) / 2
            out += np.log10(np.where(_bit(w, bit) == 1, p1, 1 - p1))
        return out


def _chunks(batches, rows: int = 200_000):
    """Tables of whole 3-byte contexts from batches (key, ...) sorted by them."""
    held, n, least = [], 0, rows
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        context = (table.column(0).to_numpy() >> 8) & 0xFFFFFF
        # The last context may go on in the next batch.
        end = int(np.flatnonzero(context != context[-1])[-1]) + 1 if context[0] != context[-1] else 0
        if end:
            yield table.slice(0, end)
        rest = table.slice(end)
        held, n = rest.to_batches(), rest.num_rows
        least = max(rows, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _chunk_windows(table: pa.Table):
    """Windows, kinds and counts of a chunk, and its long contexts."""
    w, kind, n = table.column("key").to_numpy().view(U64), table.column("kind").to_numpy(), table.column("n").to_numpy()
    return w, kind, n, LongContexts(w[kind == LEARNING], n[kind == LEARNING])


def _tuning(batches, size: int):
    """Parts of the tuning windows in an order that keeps no context together."""
    for table in _chunks(batches):
        w, kind, n, long = _chunk_windows(table)
        w, n = w[kind == TUNING], n[kind == TUNING].astype(float)
        by = np.argsort(mix64(w))
        w, n = w[by], n[by]
        for s in range(0, len(w), size):
            yield w[s : s + size], n[s : s + size], long


def _online(batches, mixer: Mixer):
    """Learn weights from tuning windows; one row per weight: (gate, input, mass, mass * mean weight)."""
    mass = np.zeros(GATES)
    # Steps are scaled by the curvature seen lately.
    curvature = np.full(mixer.weights.shape, 1e-3)
    path, steps = np.zeros(mixer.weights.shape), 0
    for all_w, all_n, long in _tuning(batches, 16384):
        seen = list(mixer.inputs(all_w, long))
        for s in range(0, len(all_w), 256):
            w, n = all_w[s : s + 256], all_n[s : s + 256]
            for bit in range(8):
                x, gate = (a[s : s + 256] for a in seen[bit])
                p1 = 1 / (1 + np.exp(-mixer.mixed(x, gate).astype(float)))
                pull, bend = n * (_bit(w, bit) - p1), n * p1 * (1 - p1)
                mass += np.bincount(gate, n, GATES)
                now = np.unique(gate)
                for k in range(x.shape[1]):
                    g, h = np.bincount(gate, pull * x[:, k], GATES)[now], np.bincount(gate, bend * x[:, k] ** 2, GATES)[now]
                    curvature[now, k] = 0.99 * curvature[now, k] + h
                    mixer.weights[now, k] += np.clip(mixer.p.rate * g / curvature[now, k], -0.2, 0.2)
            path, steps = path + mixer.weights, steps + 1
    gate, inp = np.divmod(np.arange(mixer.weights.size), mixer.weights.shape[1])
    m = mass[gate]
    yield pa.RecordBatch.from_arrays(
        [pa.array(gate, pa.int32()), pa.array(inp, pa.int32()), pa.array(m), pa.array(m * (path / max(steps, 1)).ravel())],
        names=["gate", "input", "mass", "total"],
    )


def _map_counts(batches, mixer: Mixer):
    """Observed bits per (previous byte, bucket of the mixed prediction)."""
    n0, n1 = np.zeros(256 * mixer.p.buckets), np.zeros(256 * mixer.p.buckets)
    for w, n, long in _tuning(batches, 50_000):
        for bit, (x, gate) in enumerate(mixer.inputs(w, long)):
            at, one = mixer.bucket(w, mixer.mixed(x, gate)), _bit(w, bit)
            n1 += np.bincount(at, n * one, len(n1))
            n0 += np.bincount(at, n * (1 - one), len(n0))
    at = np.flatnonzero(n0 + n1)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n0[at]), pa.array(n1[at])], names=["cell", "n0", "n1"])


def _costs(batches, mixer: Mixer):
    """(key, cost) of the wanted windows."""
    for table in _chunks(batches):
        w, _, _, long = _chunk_windows(table)
        w = w[table.column("wanted").to_numpy()]
        for s in range(0, len(w), 50_000):
            part = w[s : s + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(mixer.log10(part, long))], names=["key", "cost"])


def learn_counts(docs: DataFrame, folds: int, held: int, p: MixParams) -> DataFrame:
    """(kind, key, n) over all learning texts."""
    learning = docs.where(fold("doc_id", folds) != held)
    tuning = F.pmod(F.xxhash64(id_text(), F.lit(23)), F.lit(p.tuning_share)) == 0
    partial = map_arrow(learning.select(tuning.alias("tuning"), raw_text().alias("text")), _count, "kind int, key long, n long")
    return cut(partial.groupBy("kind", "key").agg(F.sum("n").alias("n")))


def by_context(windows: DataFrame) -> DataFrame:
    """Windows dealt and sorted by the three bytes before the predicted one."""
    context = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFFFF))
    # The rows are few numbers but much work, so their partitions are not to be merged.
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return windows.repartition(parts, context).sortWithinPartitions(F.xxhash64(context), context, "key", "kind")


def frequent(counts: DataFrame, most: int) -> Column:
    """Whether ``n`` is among the largest counts, cut at a step of a power scale so that at most ``most`` rows are."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    least, so_far = None, 0
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        so_far += r["count"]
        if so_far > most:
            break
        least = r["level"]
    return F.lit(False) if least is None else level >= least


def _in_large_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """Rows here are two numbers, so batches may be larger than those of texts."""
    def run(batches):
        def grouped():
            held, n = [], 0
            for b in batches:
                held.append(b)
                n += b.num_rows
                if n >= 100_000:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, n = [], 0
            if n:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield from fn(grouped())

    return df.mapInArrow(run, schema)


def fit(windows: DataFrame, p: MixParams) -> Mixer:
    """Short contexts, then weights and final map from the tuning windows; ``windows`` are dealt by context."""
    blocks = (
        _in_large_batches(windows.where(F.col("kind") == LEARNING).select("key", "n"), _short_counts, "order int, slot int, n0 long, n1 long")
        .groupBy("order", "slot")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .withColumn("block", F.shiftright("slot", PACK))
        .groupBy("order", "block")
        .applyInArrow(_pack, "order int, block int, data binary")
        .toArrow()
    )
    mixer = Mixer(ShortContexts(list(zip(*(blocks.column(c).to_pylist() for c in ("order", "block", "data"))))), p)
    context = windows.sparkSession.sparkContext
    rows = windows.select("key", "kind", "n")
    # Every task learns from its own share in an order fixed by the keys; the weights are averaged by mass.
    shared = context.broadcast(mixer)
    learned = map_arrow(rows, lambda b: _online(b, shared.value), "gate int, input int, mass double, total double")
    for r in learned.groupBy("gate", "input").agg(F.sum("mass").alias("mass"), F.sum("total").alias("total")).collect():
        if r["mass"]:
            mixer.weights[r["gate"], r["input"]] = r["total"] / r["mass"]
    weighted = context.broadcast(mixer)
    cells = map_arrow(rows, lambda b: _map_counts(b, weighted.value), "cell int, n0 double, n1 double")
    center = 1 / (1 + np.exp(-(np.arange(p.buckets) / (p.buckets - 1) * 2 - 1) * LIMIT))
    n0, n1 = np.tile((1 - center) * 20, 256), np.tile(center * 20, 256)
    for r in cells.groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
        n0[r["cell"]] += r["n0"]
        n1[r["cell"]] += r["n1"]
    mixer.map = np.clip(n1 / (n0 + n1), 1e-4, 1 - 1e-4)
    return mixer


class WindowCosts:
    """Costs of the frequent windows in a hash table."""

    EMPTY = U64(1 << 63)

    def __init__(self, key: np.ndarray, cost: np.ndarray):
        self.bits = max(int(2 * len(key)).bit_length(), 4)
        self.keys, self.cost = np.full(1 << self.bits, self.EMPTY, U64), np.zeros(1 << self.bits, np.float64)
        at, todo = self._home(key), np.arange(len(key))
        while len(todo):
            free = self.keys[at[todo]] == self.EMPTY
            self.keys[at[todo[free]]] = key[todo[free]]
            won = self.keys[at[todo]] == key[todo]
            self.cost[at[todo[won]]] = cost[todo[won]]
            todo = todo[~won]
            at[todo] = self._next(at[todo])

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (mix64(key) >> U64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def of(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs, 0 for windows that are not here, and where those are."""
        out, missing = np.zeros(len(w)), np.zeros(len(w), bool)
        at, todo = self._home(w), np.arange(len(w))
        while len(todo):
            found = self.keys[at]
            hit, empty = found == w[todo], found == self.EMPTY
            out[todo[hit]] = self.cost[at[hit]]
            missing[todo[empty]] = True
            on = ~(hit | empty)
            todo, at = todo[on], self._next(at[on])
        return out, np.flatnonzero(missing)


def _score(batches, windows: tuple[np.ndarray, np.ndarray], top: np.ndarray, top_n: np.ndarray, total: float):
    """Model score of frequent windows and base counts of frequent words; the other windows and words leave as lists."""
    costs, hashes = WindowCosts(*windows), []
    values = [np.zeros(0), np.zeros(0, U64)]

    def clear():
        hashes.clear()
        values[:] = [np.zeros(0), np.zeros(0, U64)]

    words = Interner(lambda w: hashes.append(xxhash.xxh3_64_intdigest(w)), clear, 500_000)
    end = np.flatnonzero(top == U64(END_WORD))
    end_n = float(top_n[end[0]]) if len(end) else 0.0
    for batch in batches:
        texts = [(t or b"").lower() for t in batch.column(1).to_pylist()]
        score, rare_window, rare_window_doc = np.zeros(len(texts)), [], []
        for s, some in _parts(texts):
            w, owner = windows_of(some)
            cost, missing = costs.of(w)
            score[s : s + len(some)] = np.bincount(owner, cost, len(some))
            rare_window.append(w[missing])
            rare_window_doc.append(owner[missing] + s)
        rare_window = np.concatenate(rare_window) if rare_window else np.zeros(0, U64)
        window_ends = np.cumsum(np.bincount(np.concatenate(rare_window_doc), minlength=len(texts))) if texts else np.zeros(0, np.int64)
        words.trim()
        split = [t.split() for t in texts]
        n_words = np.array([len(w) for w in split])
        at = words.ids([w for ws in split for w in ws])
        if len(values[0]) < len(hashes):
            new = np.array(hashes[len(values[0]) :], U64)
            pos = np.minimum(np.searchsorted(top, new), len(top) - 1) if len(top) else np.zeros(len(new), np.int64)
            count = np.where(top[pos] == new, top_n[pos], 0) if len(top) else np.zeros(len(new))
            values[:] = [np.append(values[0], count), np.append(values[1], new)]
        count, word = values[0][at], values[1][at]
        doc = np.repeat(np.arange(len(texts)), n_words)
        known = count > 0
        base = np.bincount(doc[known], np.log10((count[known] + 1) / total), len(texts)) + math.log10((end_n + 1) / total)
        n_known = np.bincount(doc[known], minlength=len(texts)) + (end_n > 0)
        rare_doc, rare_word = doc[~known], word[~known]
        ends = np.cumsum(np.bincount(rare_doc, minlength=len(texts)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                batch.column(3),
                pa.array(n_words + 1, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base),
                pa.array(score),
                pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(rare_word.view(np.int64))),
                pa.ListArray.from_arrays(pa.array(np.append(0, window_ends), pa.int32()), pa.array(rare_window.view(np.int64))),
            ],
            names=["doc_id", "dk", "held_out", "n_tokens", "n_bytes", "n_known", "base", "known_score", "rare", "rare_windows"],
        )


def score(docs: DataFrame, params: MixParams | None = None, folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    p = params or MixParams()
    counts = learn_counts(docs, folds, held, p)
    context = docs.sparkSession.sparkContext
    windows = cut(by_context(counts.where(F.col("kind") != WORD).select("key", "kind", "n")))
    mixer = context.broadcast(fit(windows, p))
    learning = windows.where(F.col("kind") == LEARNING)
    often = (F.col("kind") == LEARNING) & frequent(learning, p.top_windows)
    top_windows = map_arrow(windows.select("key", "kind", "n", often.alias("wanted")), lambda b: _costs(b, mixer.value), "key long, cost double").toArrow()
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    # The end mark counts as a word only if there is a text to learn from.
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total = size["n"] + size["v"] + 1.0
    top_words = words.where(frequent(words, p.top_words) | (F.col("key") == _signed(END_WORD))).toArrow()
    top = top_words.column("key").to_numpy().view(U64)
    order = np.argsort(top)
    shared = context.broadcast(
        (
            (top_windows.column("key").to_numpy().view(U64), top_windows.column("cost").to_numpy()),
            top[order],
            top_words.column("n").to_numpy()[order],
        )
    )
    rows = cut(
        map_arrow(
            docs.select(F.col("doc_id").cast("long"), raw_text().alias("text"), doc_key().alias("dk"), (fold("doc_id", folds) == held).alias("held_out")),
            lambda b: _score(b, *shared.value, total),
            "doc_id long, dk long, held_out boolean, n_tokens long, n_bytes long, n_known long, base double, known_score double, rare array<bigint>, rare_windows array<bigint>",
        )
    )

    def by_document(column: str) -> DataFrame:
        # Equal rows have one key and equal texts, so each (document, key) is taken once.
        return rows.select("dk", F.explode(column).alias("key")).groupBy("dk", "key").agg(F.count("*").alias("times"))

    rare_words = by_document("rare").join(words, "key", "left").select(
        "dk",
        (F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(total))).alias("base"),
        F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"),
        F.lit(0.0).alias("score"),
    )
    asked = rows.select(F.explode("rare_windows").alias("key")).distinct().select("key", F.lit(ASKED).alias("kind"), F.lit(0).cast("long").alias("n"))
    beside = by_context(learning.select("key", "kind", "n").union(asked)).select("key", "kind", "n", (F.col("kind") == ASKED).alias("wanted"))
    costs = map_arrow(beside, lambda b: _costs(b, mixer.value), "key long, cost double")
    rare_windows = by_document("rare_windows").join(costs, "key").select(
        "dk", F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("known"), (F.col("times") * F.col("cost")).alias("score")
    )
    copies = rows.groupBy("dk").agg(F.count("*").alias("copies"))
    rest = (
        rare_words.union(rare_windows)
        .groupBy("dk")
        .agg(F.sum("base").alias("base"), F.sum("known").alias("known"), F.sum("score").alias("score"))
        .join(copies, "dk")
        .select(
            "dk",
            (F.col("base") / F.col("copies")).alias("rest"),
            (F.col("known") / F.col("copies")).cast("long").alias("rest_known"),
            (F.col("score") / F.col("copies")).alias("rest_score"),
        )
    )
    model = F.col("known_score") + F.coalesce("rest_score", F.lit(0.0))
    bits = -model * math.log2(10) / F.greatest("n_bytes", F.lit(1))
    return rows.join(rest, "dk", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(size["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        model.alias("score"),
        bits.alias("bits_per_byte"),
    )
