"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct 5-word shingles as 64-bit hashes.  Two
small collections of bands are hashed, and a table key combines one band of
each: ``bands`` x ``bands`` tables cost 2 x ``bands`` x ``rows`` minhashes
instead of ``bands``^2 x 2 x ``rows``.  A table can only match where both of
its bands match, so bands that no other document shares are dropped before the
keys are formed.

Equal sets are one node, so exact copies are never paired.  Within a table
bucket every node is compared with one hub; buckets whose other members are
not all in one component are then compared member by member, in cells of
bounded size, so no bucket size loses a link that the tables found.  Every link
is confirmed on full sets, which only nodes with a candidate ship (a bounded
filter, then an exact join).  With the defaults a pair at the threshold of
0.85 shares no table with probability 1.5e-4, at 0.9 with 4e-6.

Edge cases: a null or empty text has an empty set and is linked with nothing.
Fewer words than a shingle make one shingle of the whole sequence.  Repeated
rows share a set and so a component.  A component of null ids has a null
component_id and keeps its rows.  Only doc_id and text are read.  An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm import bloom
from rastertable.llm.components import components
from rastertable.llm.text import U64, WordHashes, cut, doc_key, map_arrow, mix64, odd_constants, raw_text, window_hashes


@dataclass(frozen=True)
class NearDupParams:
    shingle: int = 5
    percent: int = 85
    bands: int = 10
    rows: int = 3


def shingle_set(words: list[bytes], hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    if not words:
        return np.empty(0, U64)
    h = hashes.of(words)
    if len(words) < size:
        # The whole sequence counts as one shingle; its length keeps it apart.
        return window_hashes(h, len(words), seed=100 + len(words))
    return np.unique(window_hashes(h, size))


def _band_keys(shingles: np.ndarray, p: NearDupParams, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Keys of the 2 x ``bands`` small bands."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, U64)
    for s in range(0, len(shingles), 4096):
        np.minimum(low, (shingles[s : s + 4096, None] * mult + add).min(0), out=low)
    per_band = low.reshape(2 * p.bands, p.rows)
    key = mix64(np.arange(1, 2 * p.bands + 1, dtype=U64))
    for k in range(p.rows):
        key = mix64(key * U64(0x9E3779B97F4A7C15) + per_band[:, k])
    return key


def _sets(texts, hashes: WordHashes, p: NearDupParams):
    """The set of each text."""
    for text in texts.to_pylist():
        yield shingle_set((text or b"").lower().split(), hashes, p.shingle)


def _node(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(docs: DataFrame, p: NearDupParams) -> DataFrame:
    """doc_id, dk, node (digest of the set; null if empty), n_shingles, band keys as bytes."""
    mult, add = odd_constants(2 * p.bands * p.rows, 3), odd_constants(2 * p.bands * p.rows, 5)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = list(_sets(batch.column(2), hashes, p))
            bands = [_band_keys(s, p, mult, add).astype("<i8").tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(list(map(len, sets)), pa.int64()),
                    pa.array(bands, pa.binary()),
                ],
                names=["doc_id", "dk", "node", "n_shingles", "bands"],
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), doc_key().alias("dk"), raw_text().alias("text")),
        run,
        "doc_id long, dk long, node binary, n_shingles long, bands binary",
    )


def table_keys(nodes: DataFrame, p: NearDupParams) -> DataFrame:
    """(key, node): the tensored table keys of nodes whose bands are shared."""
    bands = nodes.select(
        "node", F.posexplode(F.array(*[F.substring("bands", 8 * k + 1, 8) for k in range(2 * p.bands)])).alias("side", "band")
    ).withColumn("band", F.xxhash64("band"))
    shared = bands.groupBy("band").count().where("count > 1").select("band")
    left, right = F.col("side") < p.bands, F.col("side") >= p.bands
    own = (
        bands.join(shared, "band")
        .groupBy("node")
        .agg(F.collect_list(F.when(left, F.col("band"))).alias("l"), F.collect_list(F.when(right, F.col("band"))).alias("r"))
        .where((F.size("l") > 0) & (F.size("r") > 0))
    )
    return own.select("node", F.explode("l").alias("x"), "r").select("node", "x", F.explode("r").alias("y")).select(
        F.xxhash64("x", "y").alias("key"), "node"
    )


def candidate_sets(docs: DataFrame, wanted: DataFrame, p: NearDupParams) -> DataFrame:
    """(node, shingles) of the wanted nodes: a bounded filter where texts are read, then an exact join."""
    # The first 8 bytes of the digest, as a signed number: what the filter sees below.
    prefix = wanted.select(F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long").alias("h"))
    bits = docs.sparkSession.sparkContext.broadcast(bloom.build(prefix, "h"))

    def run(batches):
        seen: set[bytes] = set()
        rows: list[tuple[bytes, np.ndarray]] = []

        def batch():
            node, sets = zip(*rows)
            offsets = np.cumsum([0, *map(len, sets)])
            return pa.RecordBatch.from_arrays(
                [pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))],
                names=["node", "shingles"],
            )

        size, hashes = 0, WordHashes()
        for s in (s for b in batches for s in _sets(b.column(0), hashes, p)):
            if not len(s):
                continue
            node = _node(s)
            if node in seen or not bloom.maybe_in(bits.value, np.frombuffer(node[:8], ">u8").astype(U64))[0]:
                continue
            seen.add(node)
            rows.append((node, s))
            size += len(s)
            if size > 500_000:
                yield batch()
                rows.clear()
                size = 0
        if rows:
            yield batch()

    found = map_arrow(docs.select(raw_text().alias("text")), run, "node binary, shingles array<bigint>")
    # Copies of a set may come from several tasks; they are equal, so one is enough.
    return found.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    inter = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - inter
    size_ok = 100 * F.least(F.size("sa"), F.size("sb")) >= p.percent * F.greatest(F.size("sa"), F.size("sb"))
    joined = pairs.distinct().join(of_a, "a").join(of_b, "b")
    return joined.where(size_ok).where(100 * inter >= p.percent * union).select("a", "b")


def links(docs: DataFrame, nodes: DataFrame, p: NearDupParams) -> DataFrame:
    """(node, root) of every node with a confirmed link."""
    keys = cut(table_keys(nodes, p))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    members = cut(keys.join(hubs, "key"))
    sets = cut(candidate_sets(docs, members.select("node").distinct(), p))
    spokes = members.where("node <> hub")
    star = spokes.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    edges = cut(_confirm(star, sets, p))
    roots = components(edges)
    # What is left: buckets whose members besides the hub are not yet one component.
    rest = spokes.where("n > 2").select("key", "node")
    now = rest.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("node").alias("first")).where("lo <> hi")
    left = cut(now.join(several, "key").select("node", "root", "first"))
    if left.isEmpty():
        return roots
    # Buckets that share members form one group; groups are compared in cells of bounded size.
    group = components(left.select(F.col("first").alias("a"), F.col("node").alias("b")))
    group = group.select("node", F.col("root").alias("grp"))
    rows = left.select("node", "root").distinct().join(group, "node").join(sets, "node")
    more = compare_in_cells(cut(rows), p)
    return components(edges.union(more))


#: Shingles that one side of a cell holds at about most (0.5 MB).
CELL_SHINGLES = 60_000


def compare_in_cells(rows: DataFrame, p: NearDupParams) -> DataFrame:
    """Links (a, b) between nodes of one group and different roots: (node, root, grp, shingles).

    Sizes of linked sets differ by less than ``percent``, so a node meets only
    its own and the next size class.  Each class of a group is dealt into
    chunks of bounded total size; a cell holds two chunks, and every pair of
    chunks that can hold a link has a cell.  Within a cell 64 sets at a time
    become one bit mask per shingle, against which all others are counted.
    """
    base = float(np.log(100 / p.percent))
    rows = rows.withColumn("cls", F.floor(F.log(F.size("shingles").cast("double")) / base).cast("int"))
    sizes = rows.groupBy("grp", "cls").agg(F.ceil(F.sum(F.size("shingles")) / CELL_SHINGLES).cast("int").alias("chunks"))
    near = sizes.select("grp", F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)).alias("cls"), F.col("cls").alias("other"), "chunks")
    near = near.groupBy("grp", "cls").agg(
        *[F.coalesce(F.max(F.when(F.col("other") - F.col("cls") == d, F.col("chunks"))), F.lit(0)).alias(c) for d, c in ((-1, "lower"), (0, "own"), (1, "upper"))]
    )
    chunk = F.pmod(F.xxhash64("node"), F.col("own")).cast("int")

    def cells(count: str, make) -> F.Column:
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)).otherwise(F.array())

    def cell(cls, i, upper, j, side):
        return F.struct(cls.alias("cls"), i.alias("i"), upper.alias("up"), j.alias("j"), side.alias("side"))

    c, none = F.col("cls"), F.lit(0)
    dealt = rows.join(near, ["grp", "cls"]).withColumn("chunk", chunk)
    k = F.col("chunk")
    dealt = dealt.withColumn(
        "cell",
        F.explode(
            F.concat(
                cells("own", lambda j: cell(c, F.least(k, j), none, F.greatest(k, j), F.when(k <= j, 0).otherwise(1))),
                cells("upper", lambda j: cell(c, k, F.lit(1), j, F.lit(0))),
                cells("lower", lambda j: cell(c - 1, j, F.lit(1), k, F.lit(1))),
            )
        ),
    )
    dealt = dealt.select("grp", "cell.cls", "cell.i", "cell.up", "cell.j", "cell.side", "node", "root", "shingles")
    return dealt.groupBy("grp", "cls", "i", "up", "j").applyInArrow(lambda t: _compare(t, p.percent), "a binary, b binary")


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    sets = table.column("shingles").combine_chunks()
    return sets.flatten().to_numpy(zero_copy_only=False).view(U64), pa.compute.list_value_length(sets).to_numpy().astype(np.int64)


def _compare(table: pa.Table, percent: int) -> pa.Table:
    """Links of one cell that join different roots, as a spanning forest."""
    same = table.column("up")[0].as_py() == 0 and table.column("i")[0].as_py() == table.column("j")[0].as_py()
    side = table.column("side").to_numpy()
    left, right = (table, table) if same else (table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1)))
    found: list[tuple[bytes, bytes]] = []
    if len(left) and len(right):
        parent: dict[bytes, bytes] = {}

        def top(x):
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        (fl, nl), (fr, nr) = _flat(left), _flat(right)
        at = np.cumsum(nl) - nl
        starts = np.cumsum(nr) - nr
        names_l, names_r = left.column("node").to_pylist(), right.column("node").to_pylist()
        root_l, root_r = left.column("root").to_pylist(), right.column("root").to_pylist()
        for s in range(0, len(nl), 64):
            n = min(64, len(nl) - s)
            values = fl[at[s] : at[s + n - 1] + nl[s + n - 1]]
            mask = np.repeat(U64(1) << np.arange(n, dtype=U64), nl[s : s + n])
            order = np.argsort(values, kind="stable")
            values, mask = values[order], mask[order]
            first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            values, mask = values[first], np.bitwise_or.reduceat(mask, first)
            for t in range(0, len(nr), 256):
                m = min(256, len(nr) - t)
                other = fr[starts[t] : starts[t + m - 1] + nr[t + m - 1]]
                pos = np.minimum(np.searchsorted(values, other), len(values) - 1)
                hit = np.where(values[pos] == other, mask[pos], U64(0))
                bits = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :n]
                inter = np.add.reduceat(bits, starts[t : t + m] - starts[t], axis=0, dtype=np.int64)
                union = nr[t : t + m, None] + nl[None, s : s + n] - inter
                for y, x in np.argwhere(100 * inter >= percent * union):
                    a, b = top(root_l[s + x]), top(root_r[t + y])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        found.append((names_l[s + x], names_r[t + y]))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _grouped(docs: DataFrame, p: NearDupParams) -> DataFrame:
    """(doc_id, dk, n_shingles, root, component_id) per row; root and component_id are null for empty sets."""
    rows = cut(signatures(docs, p))
    nodes = cut(rows.where("node IS NOT NULL").groupBy("node", "bands").agg(F.min("doc_id").alias("first_id")))
    roots = links(docs, nodes, p)
    named = nodes.select("node", "first_id").join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = named.join(ids, "root").select("node", "root", "component_id")
    return rows.join(of_node, "node", "left").select("doc_id", "dk", "n_shingles", "root", "component_id")


def near_duplicates(docs: DataFrame, params: NearDupParams | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    alone = F.col("root").isNull()
    return _grouped(docs, params or NearDupParams()).select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def keep_first(docs: DataFrame, params: NearDupParams | None = None) -> DataFrame:
    """One document of each group, the one of least id, with all columns; empty texts stay."""
    rows = cut(_grouped(docs, params or NearDupParams()))
    # Ids may repeat within a group: of equal ids the least key stays, of equal rows the first.
    best = rows.where(F.col("root").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("dk").alias("dk"))
    chosen = best.select("dk", F.lit(True).alias("once")).union(rows.where("root IS NULL").select("dk", F.lit(False)).distinct())
    keyed = docs.select(F.struct("*").alias("row"), doc_key().alias("dk")).join(chosen, "dk")
    copy = F.row_number().over(Window.partitionBy("dk").orderBy("dk"))
    return keyed.withColumn("copy", copy).where(~F.col("once") | (F.col("copy") == 1)).select("row.*")
