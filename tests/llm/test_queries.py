"""The registered queries: SQL where there is any, plain Python or held-out accuracy elsewhere."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from rastertable.llm import catalog

from .conftest import DIR

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rel = duck.sql(SQL[name])
    assert cols == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(map(tuple, rel.select(*cols).fetchall()), key=repr)


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def base_spans(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        luhn = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and luhn % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_pii_base(spark, docs):
    got = by_id(QUERIES["op4_weak_pii"](spark, DIR))
    added = 0
    for d in docs.collect():
        r, spans = got[d["doc_id"]], base_spans(d["text"])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert r["spans"].startswith(text)
        added += r["n_added"]
    assert added > 0


def test_base_language_score(spark, docs):
    got, rows = by_id(QUERIES["op6_context_mixing"](spark, DIR)), docs.collect()
    words = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for d in rows if not held(d["doc_id"]) for w in words(d["text"]))
    n, v = sum(counts.values()), len(counts)
    bits = size = 0
    for d in rows:
        r, w = got[d["doc_id"]], words(d["text"])
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(d["doc_id"]), len(w), sum(x in counts for x in w), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        if r["held_out"]:
            bits -= r["score"] * math.log2(10)
            size += len((d["text"] or "").encode())
    # Far below the 8 bits of a byte, and below what single letters tell.
    assert bits / size < 3.2


def test_toxicity_held_out(spark, labels):
    got = by_id(QUERIES["op5_pattern_grammar"](spark, DIR))
    rows = [(r["toxic"], got[r["doc_id"]]) for r in labels.collect()]
    clean = [g["predicted"] for t, g in rows if not t and g["held_out"]]
    toxic = [g["predicted"] for t, g in rows if t]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


def test_languages_held_out(spark, docs):
    got = by_id(QUERIES["op7_language_codes"](spark, DIR))
    rows = [(d["lang"], got[d["doc_id"]]) for d in docs.collect()]
    held = [lang == g["lang_pred"] for lang, g in rows if g["held_out"]]
    assert sum(held) >= 0.99 * len(held)


def test_grades_held_out(spark, labels):
    got = by_id(QUERIES["op1_ordinal_quality"](spark, DIR))
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    good, poor = ([g["expected_grade"] for q, g in held if q == k] for k in (1, 0))
    assert sum(good) / len(good) > sum(poor) / len(poor) + 1
    assert all(0 <= g["expected_grade"] <= 2 and 0 <= g["tail_probability"] <= 1 for _, g in held)


def canonical_hit(text, item):
    return " ".join(item.lower().split()) in " ".join((text or "").lower().split())


def test_contamination(spark, docs):
    """In this table items are held whole or not at all."""
    items = spark.read.parquet(f"{DIR}/benchmark.parquet").collect()
    got = by_id(QUERIES["op10_templates"](spark, DIR))
    for d in docs.collect():
        assert got[d["doc_id"]]["kept"] == (not any(canonical_hit(d["text"], i["text"]) for i in items))


@pytest.fixture(scope="module")
def reference_encoding():
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, docs, reference_encoding):
    got = by_id(QUERIES["op9_byte_bpe"](spark, DIR))
    for d in docs.collect():
        ids = reference_encoding.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_pipeline_against_plain_python(spark, duck, docs, reference_encoding):
    """Rules from SQL; the other stages in plain Python on what is kept."""
    kept = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({SQL['op2_quality_rules']}) WHERE kept").fetchall()}
    texts = {d["doc_id"]: d["text"] for d in docs.collect() if d["doc_id"] in kept}
    texts = plain_line_dedup(texts)
    texts = plain_near_dedup(texts, percent=80)
    items = [r["text"] for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    texts = {i: t for i, t in texts.items() if not any(canonical_hit(t, x) for x in items)}
    got = by_id(corpus_pipeline.run(spark, DIR))
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert got[i]["ids"] == reference_encoding.encode_ordinary(t)


def plain_line_dedup(texts, min_chars=40):
    """Runs of every length, each compared with all earlier ones."""
    seqs = {i: [(k, t.strip(" \t\x0b\x0c\r")) for k, t in enumerate(texts[i].split("\n")) if t.strip(" \t\x0b\x0c\r")] for i in sorted(texts)}
    gone, d = {i: set() for i in texts}, 1
    while any(len(seq) >= d for seq in seqs.values()):
        seen = set()
        for i, seq in seqs.items():
            for s in range(len(seq) - d + 1):
                block = tuple(t for _, t in seq[s : s + d])
                if block in seen and sum(map(len, block)) >= min_chars:
                    gone[i].update(k for k, _ in seq[s : s + d])
                seen.add(block)
        d += 1
    return {i: "\n".join(t for k, t in enumerate(texts[i].split("\n")) if k not in gone[i]) for i in texts}


def plain_near_dedup(texts, percent=85):
    sets, parent = {}, {}
    for i, t in texts.items():
        w = tuple(t.encode().lower().split())
        sets[i] = {w[k : k + 5] for k in range(len(w) - 4)} if len(w) >= 5 else {w} if w else set()

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        shared = Counter(j for x in s for j in where.get(x, ()))
        for j, c in shared.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
        for x in s:
            where.setdefault(x, []).append(i)
    return {i: t for i, t in texts.items() if top(i) == i}
