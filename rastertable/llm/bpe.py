"""Byte-level BPE: encoding and decoding with padded numpy matrices.

Texts are cut by the tokenizer's pattern.  Each distinct piece is encoded once
and kept in a bounded cache: pieces of similar length form a padded matrix of
token ids, and every round each row merges its leftmost pair of minimum rank,
looked up in a hash table of pairs, and is compacted by one column; rows that
have no pair left leave the matrix.  A row costs rounds x width, so pieces
beyond ``MATRIX_WIDTH`` bytes take the same merges from a heap instead, which
is exact too and stays fast for pieces of any length.

Edge cases: a null text is an empty one, which has no ids and decodes to empty
bytes.  Equal rows give equal ids.  Extra columns are not read.  An empty table
gives an empty result.  Special tokens are never produced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.llm.text import Interner, mix64

WIDTHS = np.array([4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256])
MATRIX_WIDTH = int(WIDTHS[-1])
NONE = np.int32(1 << 30)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

# White space only: pieces never cross these chunks, so a chunk met before needs
# no second look.  Python's own engine counts FS..US as white space, the
# tokenizer's pattern does not; texts with those take the other engine.
_CHUNK = r" ?\S+|\s+(?!\S)|\s+"
_FAST, _EXACT = re.compile(_CHUNK), regex.compile(_CHUNK)
_SEPARATORS = re.compile("[\x1c-\x1f]")


class PairTable:
    """Open-addressing hash table (left id, right id) -> merged id."""

    BITS = 20

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        while len(left) * 3 > 1 << self.BITS:
            self.BITS += 1
        self.mask = np.int64((1 << self.BITS) - 1)
        self.keys = np.full(1 << self.BITS, EMPTY, np.uint64)
        self.values = np.full(1 << self.BITS, NONE, np.int32)
        key = self._key(left, right)
        at = self._slot(key)
        todo = np.arange(len(key))
        while len(todo):
            free = self.keys[at[todo]] == EMPTY
            self.keys[at[todo[free]]] = key[todo[free]]
            won = self.keys[at[todo]] == key[todo]
            self.values[at[todo[won]]] = merged[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & self.mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key):
        return (mix64(key) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids; ``NONE`` where the pair does not merge or is padding (-1)."""
        out = np.full(len(left), NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = self._key(left[todo], right[todo])
        at = self._slot(key)
        while len(todo):
            found = self.keys[at]
            hit = found == key
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (found != EMPTY)
            todo, key, at = todo[on], key[on], (at[on] + 1) & self.mask
        return out


class Codec:
    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: token for token, i in self.ranks.items()}
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get = self.ranks.get
        pairs = [
            (a, b, i)
            for token, i in self.ranks.items()
            for s in range(1, len(token))
            if (a := get(token[:s])) is not None and (b := get(token[s:])) is not None
        ]
        self.table = PairTable(*(np.array(c, np.int64) for c in zip(*pairs)))
        self.pair_of = {(a, b): i for a, b, i in pairs}

    def _matrix(self, flat: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Encode pieces of up to ``width`` bytes together: (sizes, flat ids).

        ``flat`` holds the byte tokens of all pieces, ``size`` their numbers.
        """
        cols = np.arange(width)
        ids = np.full((len(size), width), -1, np.int32)
        ids[cols < size[:, None]] = flat
        rank = np.full(ids.shape, NONE, np.int32)
        rank[:, :-1] = self.table.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(size), width - 1)
        final = np.empty_like(ids)
        row_of = np.arange(len(size))
        while True:
            rows = np.arange(len(row_of))
            j = rank.argmin(axis=1)
            best = rank[rows, j]
            go = best != NONE
            if not go.all():
                # Rows without a pair left are finished and leave the matrix.
                final[row_of[~go]] = ids[~go]
                ids, rank, row_of, j, best = ids[go], rank[go], row_of[go], j[go], best[go]
                rows = rows[: len(row_of)]
            if not len(row_of):
                break
            ids[rows, j] = best
            # Drop the right half of the merged pair; the last column becomes padding.
            take = np.minimum(cols + (cols > j[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, take, 1), np.take_along_axis(rank, take, 1)
            ids[:, -1], rank[:, -1] = -1, NONE
            nxt = np.minimum(j + 1, width - 1)
            rank[rows, j] = np.where(j + 1 < width, self.table.ranks(ids[rows, j], ids[rows, nxt]), NONE)
            left = np.flatnonzero(j > 0)
            rank[left, j[left] - 1] = self.table.ranks(ids[left, j[left] - 1], ids[left, j[left]])
        filled = final >= 0
        return filled.sum(1), final[filled]

    def _heap(self, piece: bytes) -> tuple:
        """The same merges for one long piece, by a heap over a linked list."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, get = list(range(1, n + 1)), list(range(-1, n - 1)), self.pair_of.get
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            m = after[k]
            if ids[k] != a or m >= n or ids[m] != b:
                continue
            ids[k], ids[m] = r, -1
            after[k] = after[m]
            if after[k] < n:
                before[after[k]] = k
                if (s := get((r, ids[after[k]]))) is not None:
                    heapq.heappush(heap, (s, k, r, ids[after[k]]))
            if before[k] >= 0 and (s := get((ids[before[k]], r))) is not None:
                heapq.heappush(heap, (s, before[k], ids[before[k]], r))
        return tuple(i for i in ids if i >= 0)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, flat ids) of distinct pieces."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        start = np.cumsum(length) - length
        bucket = np.searchsorted(WIDTHS, length)
        bucket[whole >= 0] = -1
        at = [np.flatnonzero(whole >= 0)]
        parts = [(np.ones(len(at[0]), np.int64), whole[at[0]])]
        for b in np.unique(bucket[bucket >= 0]):
            members = np.flatnonzero(bucket == b)
            if b == len(WIDTHS):
                rows = [self._heap(pieces[k]) for k in members]
                at.append(members)
                parts.append((np.array([len(r) for r in rows], np.int64), np.array([i for r in rows for i in r], np.int64)))
                continue
            step = max(1, 1_000_000 // int(WIDTHS[b]))
            for s in range(0, len(members), step):
                part = members[s : s + step]
                at.append(part)
                parts.append(self._matrix(flat[spans(start[part], length[part])], length[part], int(WIDTHS[b])))
        order = np.concatenate(at)
        size = np.concatenate([p[0] for p in parts])
        ids = np.concatenate([p[1] for p in parts]).astype(np.int32)
        begin = np.cumsum(size) - size
        back = np.argsort(order)
        return size[back], ids[spans(begin[back], size[back])]


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all elements of the slices [start, start + size), one after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Pool:
    """Slices of one growing array."""

    def __init__(self):
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, size: np.ndarray, ids: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, flat values) of the numbered slices."""
        size = self.size[numbers]
        return size, self.ids[spans(self.start[numbers], size)]


_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec(ranks_file: bytes, pattern: str) -> Codec:
    """A codec, built once per Python worker."""
    key = (hashlib.sha256(ranks_file).digest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks_file, pattern)
    return _CODECS[key]


class ChunkCache:
    """Ids of the chunks and pieces met so far, as slices of growing arrays."""

    LIMIT = 500_000

    def __init__(self, c: Codec):
        self.codec, self.new_chunks, self.new_pieces = c, [], []
        self.chunk = Interner(self.new_chunks.append, self._clear, self.LIMIT)
        self.piece = Interner(self.new_pieces.append, lambda: None, self.LIMIT)
        self._clear()

    def _clear(self) -> None:
        self.piece.clear()
        self.chunks, self.pieces = Pool(), Pool()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of the texts."""
        self.chunk.trim()
        numbers = []
        for t in texts:
            find = (_EXACT if _SEPARATORS.search(t) else _FAST).findall
            numbers.append(self.chunk.ids(find(t)))
        self._resolve()
        size, ids = self.chunks.take(np.concatenate(numbers) if numbers else np.zeros(0, np.int64))
        bounds = np.cumsum([0, *map(len, numbers)])
        return np.concatenate([[0], np.cumsum(size)])[bounds], ids

    def _resolve(self) -> None:
        """Encode the chunks met for the first time."""
        if not self.new_chunks:
            return
        split = self.codec.pattern.findall
        found = [split(c) for c in self.new_chunks]
        per_chunk = np.fromiter(map(len, found), np.int64, len(found))
        numbers = self.piece.ids([p for ps in found for p in ps])
        if self.new_pieces:
            self.pieces.add(*self.codec.encode_pieces([p.encode() for p in self.new_pieces]))
        size, ids = self.pieces.take(numbers)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(per_chunk)]
        self.chunks.add(np.diff(ends, prepend=0), ids)
        self.new_chunks.clear()
        self.new_pieces.clear()


def encode_batches(batches, vocabulary):
    """(doc_id, text) batches to (doc_id, ids) batches."""
    cache = ChunkCache(codec(*vocabulary.value))
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        offsets, ids = cache.encode(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
            names=["doc_id", "ids"],
        )


def decode_batches(batches, vocabulary):
    """(doc_id, ids) batches to (doc_id, ids, decoded) batches."""
    token = codec(*vocabulary.value).bytes_of.__getitem__
    for batch in batches:
        ids = batch.column(1)
        decoded = [b"".join(map(token, row or ())) for row in ids.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), ids, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"]
        )


def digest_batches(batches, keep_ids: bool = False):
    """(doc_id, ids, decoded) batches to counts and digests, with the ids if asked for."""
    for batch in batches:
        ids = batch.column(1)
        joined = pc.binary_join(ids.cast(pa.list_(pa.string())), " ").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pc.list_value_length(ids).cast(pa.int64()),
                pa.array([hashlib.sha256((j or "").encode()).hexdigest() for j in joined], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in batch.column(2).to_pylist()], pa.string()),
                *([ids] if keep_ids else []),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])],
        )


def vocabulary(spark, path: str, pattern: str):
    """The rank file at ``path`` and its pattern, shipped to the executors; under 1 MB."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast((f.read(), pattern))


def _texts(docs: DataFrame) -> DataFrame:
    from rastertable.llm.text import small_batches

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, vocab) -> DataFrame:
    """(doc_id, ids array<int>) of every document."""
    return _texts(docs).mapInArrow(lambda b: encode_batches(b, vocab), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocab) -> DataFrame:
    """(doc_id, ids, decoded binary) from (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda b: decode_batches(b, vocab), "doc_id long, ids array<int>, decoded binary"
    )


def round_trip(docs: DataFrame, vocab, keep_ids: bool = False) -> DataFrame:
    """Encode and decode every document in one pass; counts and digests, with the ids if asked for."""
    return _texts(docs).mapInArrow(
        lambda b: digest_batches(decode_batches(encode_batches(b, vocab), vocab), keep_ids),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids,
    )
