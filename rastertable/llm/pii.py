"""Personal data by patterns and weakly supervised spans, in DataFrame functions only.

Four kinds (email, ip, card, phone) are exact patterns with checks.  Two more,
``secret`` and ``name``, are found by weak supervision: wide patterns propose
candidates, labelers (shape patterns, gazetteers, context words, counter
signs) vote for or against or abstain, expectation-maximisation estimates the
labelers' reliabilities without labels, and a logistic span classifier is
trained on its posteriors.  Votes and features are small numbers, so all
candidates of the corpus fold into a table of vote patterns whose size does not
grow; only that table reaches the driver.

A pattern's positions follow from the lengths of its matches and of the gaps
between them, added up per document.  Patterns are written without
backtracking (possessive repeats, starts only where a run starts), so very
long texts take linear time.

Edge cases: a null text is an empty one, without spans.  Rows of equal id and
text share results.  Added spans that overlap a base span are dropped.  Without
candidates no span is added.  Only doc_id and text are read.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastertable.llm.text import cut, doc_key

KINDS = ("email", "ip", "card", "phone", "secret", "name")
BASE = KINDS[:4]

# --- fixed values: gazetteers and context words ---------------------------------
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sra".split()
GIVEN = (
    "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Anna Emma Olivia Sophia Lucas Paul Marie Pierre Hans Peter Maria Carlos Juan "
    "José Lucia Ahmed Fatima Wei"
).split()
ISSUERS = "AKIA ASIA ghp_ gho_ ghs_ xoxb- xoxp- sk_live_ sk_test_ pk_live_ AIza glpat- eyJ".split()
SECRET_CONTEXT = "password passwd pwd secret token key apikey api_key credential auth passwort contraseña"
NAME_CONTEXT = "name is|named|contact|signed|sincerely|regards|my name|by|from|to|dear"
# --- end of fixed values ----------------------------------------------------------

_LOCAL, _DOM = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_TOKEN = "[A-Za-z0-9_/+-]"
PATTERNS = {
    # A match may start where the one before ended, even inside a run.
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOM}++(?:\.{_DOM}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": rf"(?<!{_TOKEN})(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z]){_TOKEN}{{10,}}+",
    "name": rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.?\x20\p{{Lu}}\p{{L}}++(?:\x20\p{{Lu}}\p{{L}}++)?|(?:{'|'.join(GIVEN)})\x20\p{{Lu}}\p{{L}}++)",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
LEFT = 24
_ROWS = "array<struct<kind:int,idx:int,gap:int,left:string,m:string>>"


@dataclass(frozen=True)
class PiiParams:
    rounds: int = 60
    steps: int = 400
    at_least: float = 0.5


def _matches(text: Column, kind: str) -> Column:
    """(kind, idx, gap, left, m) of all matches; gap: characters since the match before."""
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda g: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(LEFT if kind not in BASE else 0)).alias("left")))
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0).alias("m"), gaps.alias("g"))
    numbered = F.transform(
        zipped,
        lambda x, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("idx"), x["g"]["gap"].alias("gap"), x["g"]["left"].alias("left"), x["m"].alias("m")),
    )
    return F.filter(numbered, lambda x: x["m"].isNotNull()).cast(_ROWS)


def _luhn(digits: Column) -> Column:
    def add(total, k):
        d = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(k % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    """Whether a base match passes its kind's check; candidates pass."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == KINDS.index("ip"), m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == KINDS.index("card"), F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == KINDS.index("phone"), n.between(8, 15))
        .otherwise(True)
    )


def matches(docs: DataFrame) -> DataFrame:
    """(dk, kind, start, end, left, m): base spans that pass and all candidates."""
    text = F.col("text")
    digit = text.rlike("[0-9]")
    found = F.concat(
        F.when(F.contains(text, F.lit("@")), _matches(text, "email")).otherwise(F.array().cast(_ROWS)),
        *[F.when(digit & more, _matches(text, k)).otherwise(F.array().cast(_ROWS)) for k, more in (
            ("ip", F.contains(text, F.lit("."))), ("card", F.lit(True)), ("phone", F.contains(text, F.lit("+"))), ("secret", F.lit(True)))],
        _matches(text, "name"),
    )
    rows = (
        docs.select(doc_key().alias("dk"), F.col("text").cast("string").alias("text"))
        .where(text.isNotNull())
        .select("dk", F.explode(found).alias("x"))
        .select("dk", "x.*")
        # Equal rows of documents give equal matches.
        .dropDuplicates(["dk", "kind", "idx"])
    )
    so_far = Window.partitionBy("dk", "kind").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("m")
    return (
        rows.withColumn("end", F.sum((F.col("gap") + size).cast("long")).over(so_far))
        .withColumn("start", F.col("end") - size)
        .where(_valid(F.col("kind"), F.col("m")))
        .select("dk", "kind", "start", "end", "left", "m")
    )


def _vote(yes: Column | None = None, no: Column | None = None) -> Column:
    v = F.lit(0)
    if no is not None:
        v = F.when(no, -1).otherwise(v)
    return (F.when(yes, 1).otherwise(v) if yes is not None else v).cast("int")


VOTES = ("shape", "gazetteer", "context", "delimited", "counter")
FEATURES = ("size", "digits", "capitals")


def labelers(candidates: DataFrame) -> DataFrame:
    """The votes and features of each candidate, as small integers."""
    m, left, secret = F.col("m"), F.col("left"), F.col("kind") == KINDS.index("secret")
    first = F.substring_index(F.substring_index(m, " ", 1), ".", 1)
    n, digits = F.length(m), F.length(F.regexp_replace(m, "[^0-9]", ""))
    capitals = F.length(F.regexp_replace(m, r"[^\p{Lu}]", ""))
    shape = F.when(secret, m.rlike(r"^(?:[0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z0-9]{20}|(?=.*[a-z])(?=.*[A-Z]).{20,})$")).otherwise(
        m.rlike(r"^\p{Lu}\p{Ll}+\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?$")
    )
    gazetteer = F.when(secret, m.rlike("^(?:" + "|".join(ISSUERS) + ")")).otherwise(first.isin(GIVEN))
    context = F.when(secret, left.rlike(rf"(?i)(?:{'|'.join(SECRET_CONTEXT.split())})[^\p{{L}}]{{0,4}}$")).otherwise(
        first.isin(TITLES) | left.rlike(rf"(?i)\b(?:{NAME_CONTEXT})[\s:,]{{1,2}}$")
    )
    delimited = F.when(secret, left.rlike("[\"'=:]\\s?$")).otherwise(left.rlike("[,;:(]\\s?$"))
    counter = F.when(secret, (digits * 8 < n) | m.rlike("^[A-Za-z]+[-_/]?[0-9]{1,4}$") | m.rlike("^[0-9]+[-/][A-Za-z]+$")).otherwise(
        left.rlike(r"[.!?]\s*$") & ~first.isin(GIVEN) & ~first.isin(TITLES)
    )
    return candidates.withColumns(
        {
            "shape": _vote(shape, ~shape),
            "gazetteer": _vote(gazetteer),
            "context": _vote(context),
            "delimited": _vote(delimited),
            "counter": _vote(None, counter),
            "size": F.least(F.floor(F.log2(n.cast("double"))), F.lit(7)).cast("int"),
            "digits": F.floor(4 * digits / n).cast("int"),
            "capitals": F.floor(4 * capitals / n).cast("int"),
        }
    )


def _reliabilities(table: list[tuple[tuple[int, ...], int]], rounds: int) -> dict[tuple[int, ...], float]:
    """Posterior of each vote pattern by EM over (pattern, times); a table of bounded size."""
    values = (-1, 0, 1)
    prior = 0.5
    # At first, votes for are thought more likely among true spans, votes against among others.
    like = [[{-1: 0.2, 0: 0.4, 1: 0.4}, {-1: 0.4, 0: 0.5, 1: 0.1}] for _ in VOTES]
    like = [[dict(on), dict(off)] for on, off in like]
    total = sum(n for _, n in table)
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in table:
            on = math.log(prior) + sum(math.log(k[0][v]) for k, v in zip(like, votes))
            off = math.log(1 - prior) + sum(math.log(k[1][v]) for k, v in zip(like, votes))
            post[votes] = 1 / (1 + math.exp(min(off - on, 500)))
        mass = sum(post[v] * n for v, n in table)
        prior = min(max((mass + 1) / (total + 2), 1e-4), 1 - 1e-4)
        for j, k in enumerate(like):
            for side in (0, 1):
                weight = {x: 1.0 if x == 0 else 0.5 for x in values}
                # A labeler keeps its direction: half a count in its favour.
                weight[1 if side == 0 else -1] += 1.0
                for votes, n in table:
                    weight[votes[j]] += n * (post[votes] if side == 0 else 1 - post[votes])
                s = sum(weight.values())
                k[side] = {x: w / s for x, w in weight.items()}
    return post


def _classifier(rows: list[tuple[tuple[float, ...], float, int]], steps: int) -> list[float]:
    """Logistic weights (constant last) on (inputs, soft label, times)."""
    if not rows:
        return []
    size = len(rows[0][0]) + 1
    w, total = [0.0] * size, sum(n for *_, n in rows)
    for t in range(steps):
        g = [-0.001 * x for x in w]
        for x, y, n in rows:
            z = sum(a * b for a, b in zip(w, x)) + w[-1]
            e = (y - 1 / (1 + math.exp(-max(min(z, 30), -30)))) * n / total
            for k, a in enumerate(x):
                g[k] += e * a
            g[-1] += e
        w = [a + 0.5 * b for a, b in zip(w, g)]
    return w


def train(voted: DataFrame, p: PiiParams) -> dict[int, list[float]]:
    """Classifier weights per kind; the collected table has a bounded number of patterns."""
    patterns = voted.groupBy("kind", *VOTES, *FEATURES).count().collect()
    out = {}
    for kind in sorted({r["kind"] for r in patterns}):
        rows = [r for r in patterns if r["kind"] == kind]
        table: dict[tuple[int, ...], int] = {}
        for r in rows:
            votes = tuple(r[v] for v in VOTES)
            table[votes] = table.get(votes, 0) + r["count"]
        post = _reliabilities(sorted(table.items()), p.rounds)
        inputs = sorted((tuple(float(r[c]) for c in (*VOTES, *FEATURES)), post[tuple(r[v] for v in VOTES)], r["count"]) for r in rows)
        out[kind] = _classifier(inputs, p.steps)
    return out


def _chosen(voted: DataFrame, weights: dict[int, list[float]], p: PiiParams) -> DataFrame:
    """Candidates that the classifier of their kind takes."""
    logit = F.lit(None).cast("double")
    for kind, w in weights.items():
        z = F.lit(w[-1])
        for c, a in zip((*VOTES, *FEATURES), w):
            z = z + F.lit(a) * F.col(c)
        logit = F.when(F.col("kind") == kind, z).otherwise(logit)
    return voted.where(logit >= math.log(p.at_least / (1 - p.at_least)))


def find(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """(dk, kind, start, end): base spans and added spans."""
    p = params or PiiParams()
    found = cut(matches(docs))
    base = found.where(F.col("kind") < len(BASE))
    voted = labelers(found.where(F.col("kind") >= len(BASE)))
    added = _chosen(voted, train(voted, p), p)
    both = base.select("dk", "kind", "start", "end").union(added.select("dk", "kind", "start", "end"))
    # An added span overlaps a base span if one that starts before it ends after its start, or one starts inside it.
    is_base = F.col("kind") < len(BASE)
    order = Window.partitionBy("dk").orderBy("start", "kind")
    before = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    marked = both.withColumn("free", F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True)))
    return marked.where(is_base | F.col("free")).drop("free")


def report(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_added of every document."""
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    text = F.concat_ws(":", name, F.col("start"), F.col("end"))
    item = F.struct("kind", "start", "end", text.alias("t"))
    spans = find(docs, params).withColumn("item", item)

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(items), lambda x: x["t"]), ",")

    per_doc = spans.groupBy("dk").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        joined(F.collect_list(F.when(F.col("kind") < len(BASE), F.col("item")))).alias("base"),
        joined(F.collect_list("item")).alias("spans"),
        F.count(F.when(F.col("kind") >= len(BASE), 1)).alias("n_added"),
    )
    zero = F.lit(0).cast("long")
    return docs.select("doc_id", doc_key().alias("dk")).join(per_doc, "dk", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{kind}", zero).alias(f"n_{kind}") for kind in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_added", zero).alias("n_added"),
    )
