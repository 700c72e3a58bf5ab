"""Toxicity by a weighted finite-state pattern grammar.

Words map to symbols (insult, threat, target, negation, report, other).  Five
small transducers read the symbols of a clause and are composed into one
machine: the insult and threat machines emit matches, the target, negation and
report machines keep the context that says which pattern a match belongs to
(plain, targeted, negated, reported, threat).  A text's score comes from its
matched clauses, each weighted by its strongest word and by what is learned
for its pattern; a word alone has no score.

The insult machine's words are learned: words and word beginnings that toxic
texts have far more often than clean ones, with enough different words before
them, so that the vocabulary of one copied text is not mistaken for insults.
Learning uses at most ``per_class`` labelled rows of each class, chosen by a
hash of the id, and one text of each id, the smallest.

Edge cases: null and empty texts match nothing and get the score of no match.
Label rows whose label or id is null are not used.  Several labels of one id:
toxic if any is.  Without labels every score is 0.5 minus a little.  Rows are
scored one by one, so repeated rows get equal scores.  Only doc_id and text are
read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertable.llm.text import Interner, cut, fold, map_arrow, one_text, raw_text

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
PLAIN, TARGETED, NEGATED, REPORTED, THREATENED = range(5)

# --- fixed values: closed word classes of the four languages -------------------
WORDS = {
    THREAT: "kill hurt destroy beat shoot stab burn hang töten umbringen schlagen tuer frapper brûler matar golpear quemar",
    TARGET: "you your you're u ur he she they him her them these those du dich dir ihr euch sie tu te toi vous ils elle tú usted ustedes ellos ella",
    NEGATION: "not no never nobody don't isn't aren't nicht kein keine nie ne pas jamais aucun nunca jamás ningún",
    REPORT: "said says say told tells claimed claims called wrote quoted reported sagte sagt schrieb dit disait écrit dijo dice escribió",
}
# --- end of fixed values --------------------------------------------------------

_STRIP = b".,;:!?\"'()[]{}<>*_`|#&$%-"
_ENDS = (b".", b"!", b"?", b";", b":")
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class ToxicParams:
    per_class: int = 20_000
    min_toxic: int = 8
    min_log_odds: float = 3.5
    min_contexts: int = 8
    candidates: int = 20_000
    lexicon: int = 5_000
    reach: int = 3


def core(word: bytes) -> str:
    return word.strip(_STRIP).decode("utf-8", "replace").lower()


def features(word: str) -> list[str]:
    """The word and its beginnings; beginnings end in ``*``."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)] if word else []


class Grammar:
    """The composition of the five transducers; transitions are filled in as they occur."""

    def __init__(self, reach: int):
        self.reach, self.arcs = reach, {}
        self.start = (0, 0, 0, 0)

    def _step(self, state: tuple, symbol: int) -> tuple[tuple, int | None]:
        negation, report, target, threat = state
        emitted = None
        if symbol == INSULT:
            emitted = NEGATED if negation else REPORTED if report else TARGETED if target else PLAIN
        elif symbol == TARGET and threat and not negation:
            emitted = REPORTED if report else THREATENED
        negation = self.reach if symbol == NEGATION else max(negation - 1, 0)
        report, target = report or symbol == REPORT, target or symbol == TARGET
        threat = symbol == THREAT or (threat and symbol != TARGET)
        return (negation, int(report), int(target), int(threat)), emitted

    def read(self, symbols, weights) -> list[tuple[int, float]]:
        """Matches (pattern, weight) of one clause."""
        state, found = self.start, []
        for s, w in zip(symbols, weights):
            arc = self.arcs.get((state, s))
            if arc is None:
                arc = self.arcs[state, s] = self._step(state, s)
            state, pattern = arc
            if pattern is not None:
                found.append((pattern, w if s == INSULT else 3.0))
        if state[2]:
            # A target after the insult makes it a targeted one, too.
            found = [(TARGETED if p == PLAIN else p, w) for p, w in found]
        return found


N_FEATURES = 11


class Matcher:
    """Clause features of texts, given the learned lexicon."""

    def __init__(self, lexicon: dict[str, float], p: ToxicParams):
        self.lexicon, self.grammar = lexicon, Grammar(p.reach)
        self.symbol, self.weight, self.ends = [], [], []
        self.fixed = {w: k for k, ws in WORDS.items() for w in ws.split()}
        self.words = Interner(self._build, self._clear)
        self._clear()

    def _clear(self) -> None:
        self.symbol, self.weight, self.ends = [], [], []
        self.interesting = np.zeros(0, bool)

    def _build(self, word: bytes) -> None:
        w = core(word)
        weight = max((self.lexicon.get(f, 0.0) for f in features(w)), default=0.0)
        self.symbol.append(INSULT if weight > 0 else self.fixed.get(w, OTHER))
        self.weight.append(weight)
        self.ends.append(word.rstrip(b"\"')]")[-1:] in _ENDS)

    def of(self, texts: list[bytes | None]) -> np.ndarray:
        """Per text: strongest and summed weight of each pattern, and the number of matched clauses."""
        self.words.trim()
        out = np.zeros((len(texts), N_FEATURES))
        split = [self.words.ids((t or b"").split()) for t in texts]
        new = len(self.interesting)
        more = np.array([s in (INSULT, THREAT) for s in self.symbol[new:]], bool)
        self.interesting = np.append(self.interesting, more)
        for row, ids in zip(out, split):
            hits = np.flatnonzero(self.interesting[ids])
            if not len(hits):
                continue
            ends = np.append([k for k, i in enumerate(ids.tolist()) if self.ends[i]], len(ids) - 1)
            clause = np.searchsorted(ends, hits)
            for c in np.unique(clause):
                part = ids[(ends[c - 1] + 1 if c else 0) : int(ends[min(c, len(ends) - 1)]) + 1].tolist()
                found = self.grammar.read([self.symbol[i] for i in part], [self.weight[i] for i in part])
                row[10] += bool(found)
                for pattern, w in found:
                    row[pattern] = max(row[pattern], w)
                    row[5 + pattern] += w
        out[:, 5:] = np.log1p(out[:, 5:])
        return out


def _count_features(batches):
    counts = (Counter(), Counter())

    def flush():
        for toxic, c in enumerate(counts):
            items = list(c.items())
            for s in range(0, len(items), 50_000):
                f, n = zip(*items[s : s + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f, pa.string()), pa.array([toxic] * len(f), pa.int32()), pa.array(n, pa.int64())], names=["feature", "toxic", "n"]
                )
            c.clear()

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = {core(w) for w in set((text or b"").split())}
            counts[toxic].update({f for w in words for f in features(w)})
        if sum(map(len, counts)) > 400_000:
            yield from flush()
    yield from flush()


def _contexts(batches, candidates: set[str]):
    """Different words before each candidate, in toxic texts."""
    seen: set[tuple[str, int]] = set()

    def flush():
        if seen:
            f, before = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(before, pa.int64())], names=["feature", "before"])
            seen.clear()

    for batch in batches:
        for text in batch.column(0).to_pylist():
            last = b""
            for w in (text or b"").split():
                for f in features(core(w)):
                    if f in candidates:
                        seen.add((f, xxhash.xxh3_64_intdigest(last) >> 1))
                last = w
        if len(seen) > 400_000:
            yield from flush()
    yield from flush()


def sample(labels: DataFrame, folds: int, p: ToxicParams) -> DataFrame:
    """(doc_id, toxic) of at most ``per_class`` rows a class, by a hash of the id."""
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(fold("doc_id", folds) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return rows.where("toxic = 1").orderBy(*order).limit(p.per_class).union(rows.where("toxic = 0").orderBy(*order).limit(p.per_class))


def learn_lexicon(rows: DataFrame, p: ToxicParams) -> dict[str, float]:
    """Insults with their log-odds; at most ``lexicon`` entries."""
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return {}
    counted = map_arrow(rows.select("text", "toxic"), _count_features, "feature string, toxic int, n long")
    t, c = (F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)) for k in (1, 0))
    odds = F.log(((F.col("t") + 0.5) / (n1 + 1)) / ((F.col("c") + 0.5) / (n0 + 1)))
    found = (
        counted.groupBy("feature")
        .agg(t.alias("t"), c.alias("c"))
        .where(F.col("t") >= p.min_toxic)
        .withColumn("odds", odds)
        .where(F.col("odds") >= p.min_log_odds)
        .orderBy(F.desc("t"), "feature")
        .limit(p.candidates)
        .collect()
    )
    candidates = {r["feature"]: r["odds"] for r in found}
    if not candidates:
        return {}
    names = set(candidates)
    contexts = map_arrow(rows.where("toxic = 1").select("text"), lambda b: _contexts(b, names), "feature string, before long")
    kept = (
        contexts.distinct().groupBy("feature").count().where(F.col("count") >= p.min_contexts)
        .orderBy(F.desc("count"), "feature").limit(p.lexicon).collect()
    )
    return {r["feature"]: float(min(candidates[r["feature"]], 6.0)) for r in kept}


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


_COLUMNS = ", ".join(f"f{k} double" for k in range(N_FEATURES))


def score(docs: DataFrame, labels: DataFrame, params: ToxicParams | None = None, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted, clauses of every document."""
    p = params or ToxicParams()
    # The sample has a bounded number of ids, so it may be broadcast; only their texts are moved, one an id.
    chosen = F.broadcast(sample(labels, folds, p))
    rows = cut(one_text(docs.select(F.col("doc_id").cast("long"), raw_text().alias("text")).join(chosen, "doc_id"), "toxic"))
    lexicon = learn_lexicon(rows, p)

    def match(batches):
        matcher = Matcher(lexicon, p)
        for batch in batches:
            x = matcher.of(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), *map(pa.array, x.T.copy())], names=["toxic", *(f"f{k}" for k in range(N_FEATURES))])

    # One row of numbers for each of the bounded sample's rows.
    table = map_arrow(rows.select("text", "toxic"), match, f"toxic int, {_COLUMNS}").toArrow()
    y = table.column("toxic").to_numpy().astype(float)
    x = np.stack([table.column(f"f{k}").to_numpy() for k in range(N_FEATURES)], 1)
    w = _logistic(x, y) if len(y) else np.append(np.zeros(N_FEATURES), -0.01)

    def rate(batches):
        matcher = Matcher(lexicon, p)
        for batch in batches:
            x = matcher.of(batch.column(2).to_pylist())
            s = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(np.round(np.expm1(x[:, 10])).astype(np.int64))],
                names=["doc_id", "held_out", "score", "predicted", "clauses"],
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), (fold("doc_id", folds) == 0).alias("held_out"), raw_text().alias("text")),
        rate,
        "doc_id long, held_out boolean, score double, predicted int, clauses long",
    )
