"""Clusters, nearest neighbours and collocations: edge cases, small limits and brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastertable.llm import catalog, clusters, neighbours, phrases

from .conftest import DIR, LONG

INF, NAN = float("inf"), float("nan")
VECTORS = "vec_id long, embedding array<float>"


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in ("v", "far", "cluster", "x", "h", "dims", "block", "grp", "rank", "score")])


def edge_vectors(dims):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=dims).tolist()) for i in range(60)]
    same = rows[3][1]
    return rows, [
        *rows,
        (3, same),  # a repeated row
        (100, same),  # a tie
        (101, same),
        (None, same),
        (102, None),
        (103, []),
        (104, [1.0] * (dims - 1)),
        (105, [None] + [1.0] * (dims - 1)),
        (106, [INF] + [1.0] * (dims - 1)),
        (107, [NAN] + [1.0] * (dims - 1)),
        (108, [0.0] * dims),
        (109, [-1.0] * dims),
        (20, [0.5] * dims),  # one id, two vectors
    ]


def plain_clusters(rows, p):
    kept = [
        (i, tuple(int(np.floor(p.scale * float(np.float32(x)))) for x in e))
        for i, e in rows
        if e is not None and len(e) == p.dims and all(x is not None and np.isfinite(x) for x in e)
    ]
    key = lambda r: (hashlib.sha256(f"{p.salt}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[1])
    cents = [v for _, v in sorted(kept, key=key)[: p.k]]

    def assign():
        d = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents] for _, v in kept]
        return [(min(range(len(cents)), key=lambda j: (r[j], j)), min(r)) for r in d]

    for _ in range(p.rounds):
        groups = defaultdict(list)
        for (j, _), (_, v) in zip(assign(), kept):
            groups[j].append(v)
        for j, vs in groups.items():
            cents[j] = tuple(sum(c) // len(vs) for c in zip(*vs))
    out = assign()
    inertia = Counter()
    for j, d in out:
        inertia[j] += d
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((repr(i), j, d, inertia[j], sum(inertia.values()), sha(cents[j])) for (i, _), (j, d) in zip(kept, out))


@pytest.mark.parametrize("recache", [0.0, 0.5, 1.0])
def test_cluster_edges(spark, recache):
    p = clusters.ClusterParams(k=6, rounds=3, dims=8, recache=recache)
    _, rows = edge_vectors(8)
    df = clashing(spark.createDataFrame(rows, VECTORS))
    got = sorted((repr(r[0]), *r[1:]) for r in clusters.report(df, p).collect())
    assert got == plain_clusters(rows, p)
    assert clusters.report(df.where("false"), p).count() == 0


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    p = clusters.ClusterParams(k=40, rounds=2, dims=2)
    rows = [(i, [1.0, 2.0]) for i in range(5)] + [(9, [0.25, 0.5])]
    got = sorted((repr(r[0]), *r[1:]) for r in clusters.report(spark.createDataFrame(rows, VECTORS), p).collect())
    assert got == plain_clusters(rows, p)


def test_large_components(spark):
    p = clusters.ClusterParams(k=2, rounds=1, dims=2)
    rows = [(i, [float(i * 130_000), -500_000.0]) for i in range(4)]
    got = sorted((repr(r[0]), *r[1:]) for r in clusters.report(spark.createDataFrame(rows, VECTORS), p).collect())
    assert got == plain_clusters(rows, p)
    with pytest.raises(Exception, match="2\\^27"):
        clusters.report(spark.createDataFrame([(1, [1e30, 1.0])], VECTORS), p).count()


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, (400, 16))
    pivots = v[:9]
    cents = pivots + rng.integers(-20, 20, pivots.shape)
    far = np.sqrt(clusters.distances(v, pivots).astype(float)).astype(np.float32)
    low = clusters.PivotBounds(pivots, cents).lower(far.astype(float))
    exact = clusters.distances(v, cents)
    assert (low <= np.sqrt(exact)).all()
    cluster, best, checked = clusters.nearest(v, far, cents, clusters.PivotBounds(pivots, cents))
    assert (cluster == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert checked < 0.7 * exact.size


def recall(got, want):
    hits = sum(len(set(got[q]) & set(w)) for q, w in want.items())
    return hits / sum(len(w) for w in want.values())


def brute_neighbours(ids, x, k, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        others = np.flatnonzero(ids != ids[i])
        scores = x[others] @ x[i]
        out[int(ids[i])] = [int(ids[others[j]]) for j in np.lexsort((ids[others], -scores))[:k]]
    return out


def test_neighbour_recall(spark):
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute_neighbours(ids, x, 20, 20)
    where = {i: k for k, i in enumerate(ids.tolist())}
    # Small blocks and groups are the many tasks of a large table.
    for p in (neighbours.NeighbourParams(), neighbours.NeighbourParams(block=100, group=7)):
        got = defaultdict(list)
        for r in neighbours.search(catalog.embeddings(spark, DIR), p).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.vec_id)
            assert r["rank"] == len(got[r.query_id])
            assert abs(r.score - x[where[r.query_id]] @ x[where[r.vec_id]]) < 1e-12
        assert set(got) == set(want) and all(len(g) == 20 and len(set(g)) == 20 for g in got.values())
        assert recall(got, want) >= 0.95


def test_neighbours_of_copies_and_long_vectors():
    """One vector thousands of times, norms of many sizes: the guarantee holds for both."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 40)) * np.exp(rng.normal(size=(4000, 1)))
    x[:1500] = x[0]
    x[3999] *= 1e6
    ids = np.arange(4000)
    want = brute_neighbours(ids, x, 10, 80)
    p = neighbours.NeighbourParams(k=10)
    here = neighbours.Block(ids, x, p)
    queries = ids[::80]
    got = {int(i): here.ids[rows].tolist() for i, (rows, _) in zip(queries, here.search(queries, x[queries]))}
    assert recall(got, want) >= 0.95
    assert got[0][0] == want[0][0]


def test_neighbour_edges(spark):
    good, rows = edge_vectors(8)
    p = neighbours.NeighbourParams(k=5)
    df = clashing(spark.createDataFrame(rows, VECTORS))
    out = neighbours.search(df, p).collect()
    assert neighbours.search(df.where("false"), p).count() == 0
    by_query = defaultdict(list)
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        by_query[r["query_id"]].append(r)
    # Of the valid rows 0, 20 (two vectors), 40 and 100 are queries.
    assert {q: len(rs) for q, rs in by_query.items()} == {0: 5, 20: 10, 40: 5, 100: 5}
    assert not {r["vec_id"] for r in out} & {102, 103, 104, 105, 106, 107, 108}
    # Ties by id, a null id last; the repeated row counts once.
    assert [r["vec_id"] for r in by_query[100]][:3] == [3, 101, None]
    few = neighbours.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 2.0])], VECTORS), p).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in few] == [(2, 0.0), (1, -1.0)]
    assert neighbours.search(spark.createDataFrame([(0, [1.0])], VECTORS), p).count() == 0


def plain_phrases(rows, min_count=10, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", t):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            for m in (1, 2, 3):
                counts[lang or "und" if lang is None else lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        longer = Counter()
        for g, a in cand.items():
            if len(g) == 3:
                for part in (g[:2], g[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for g, a in cand.items():
            if longer[g] and 100 * longer[g] >= 50 * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -s))
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(3)
    word = ["the", "New", "york", "city", "é", "😀", "a-b", "x\x00y", "two words", "of"]
    some = [" ".join(rng.choice(word, 40)) for _ in range(40)]
    return [
        *[("en", t) for t in some],
        *[(None, t + ", " + t) for t in some[:15]],
        *[("de", "new york city. " * 3 + "the the the the\n")] * 8,
        ("fr", LONG),
        ("fr", None),
        (None, None),
        ("", ""),
        ("", " \t.,;:!?\n\x0b\x0c\r"),
        ("it", "einmal\tzweimal"),
    ]


@pytest.mark.parametrize("limits", [{}, {"burst": 4, "entries": 30, "words": 5, "spread": 2, "hashes": 50}, {"top": 7, "filter_bits": 15}])
def test_phrases_match_brute_force(spark, limits):
    rows = phrase_rows()
    p = phrases.PhraseParams(**limits)
    df = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("n", "w1", "a", "l", "r", "phrase", "share", "digit")]).repartition(3)
    got = phrases.mine(df, p)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, top=p.top)
    assert phrases.mine(df.where("false"), p).count() == 0


def test_long_texts_in_parts(spark, monkeypatch):
    """Every part knows the next words, so a cut inside a piece loses and doubles nothing."""
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["a", "b", "c", "d.", "e"], n)) for n in (3, 50, 51, 52, 900)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([t.encode() for t in texts])], names=["lang", "text"])
    here = phrases._Counting(phrases.PhraseParams(), np.full(1 << 12, 255, np.uint8))
    for parts in phrases._pieces([batch], here.vocabulary, chunk=17):
        assert not list(here.take(parts))
    words = [w.decode() for w in here.vocabulary.words]
    got = Counter()
    for table in here.tries["en"].tables:
        for key, n in table.items():
            got[" ".join(words[i] for i in (key >> 42, key >> 21 & phrases.MASK, key & phrases.MASK) if i)] += n
    want = Counter()
    for text in texts:
        for piece in text.split("."):
            w = piece.split()
            want.update(" ".join(w[i : i + m]) for m in (1, 2, 3) for i in range(len(w) - m + 1))
    assert got == want and here.totals["en"] == sum(n for g, n in want.items() if " " not in g)


def test_trie_splits_and_spills():
    rng = np.random.default_rng(4)
    trie, want = phrases.HatTrie(50), Counter()
    for _ in range(20):
        keys = (rng.integers(1, 9, 300) << 42) | (rng.integers(0, 30, 300) << 21) | rng.integers(0, 3, 300)
        trie.add(keys)
        want.update(keys.tolist())
    assert trie.size == len(want) and len(trie.tables) > 10
    assert all(len(t) <= 50 for t in trie.tables) and trie.starts == sorted(set(trie.starts))
    got = Counter()
    for keep in (200, 0):
        keys, counts = trie.spill(keep)
        assert trie.size <= keep
        for k, c in zip(keys.tolist(), counts.tolist()):
            got[k] += c
    assert got == want


def test_scores_beyond_64_bits(spark):
    a = 4_000_000_000_000
    found = spark.createDataFrame(
        [("en", "x", "", "", a, 1), ("en", "y", "", "", 3 * a + 1, 1), ("en", "x", "y", "", a - 1, 2), ("en", None, None, None, 9 * a, 0)],
        "lang string, w1 string, w2 string, w3 string, n long, size int",
    )
    (r,) = phrases.candidates(found, phrases.PhraseParams()).collect()
    assert r["score"] == 1_000_000 * (a - 1) ** 2 // (a * (3 * a + 1))
