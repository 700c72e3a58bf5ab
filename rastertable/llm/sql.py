"""SQL (DuckDB) that computes the operators' rows from the same tables."""

from __future__ import annotations

from rastertable.llm.rules import RuleParams

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[x FOR x IN regexp_split_to_array({0}, '[\x20\x09-\x0D]+') IF x <> '']"


def lowered(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


def words(column: str) -> str:
    return WORDS.format(column)


_CLASSES = ("[^a-z]", "[^A-Z]", "[^0-9]", r"[^\x20\x09-\x0D]", r"[^.,;:!?''\"()-]")


def rules_sql(p: RuleParams = RuleParams()) -> str:
    kinds = [f"length(regexp_replace(t, '{c}', '', 'g'))" for c in _CLASSES]
    ascii_all = r"length(regexp_replace(t, '[^\x00-\x7F]', '', 'g'))"
    classes = ", ".join([*kinds, f"{ascii_all} - {' - '.join(kinds)}", f"length(t) - {ascii_all}"])
    js = "sqrt(greatest(0.0, sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
base AS (
  SELECT doc_id, t, lang, {words("t")} AS w, {words(lowered("t"))} AS lw, [{classes}] AS cls FROM d
),
pos AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM base),
win AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM pos
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
rep AS (SELECT doc_id, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS r FROM win),
cov AS (
  SELECT doc_id, i, r OR coalesce(lag(r, 1) OVER o, false) OR coalesce(lag(r, 2) OVER o, false) AS c FROM rep
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
n_rep AS (SELECT doc_id, count(*) FILTER (WHERE c) AS n_repeat_words FROM cov GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
),
ref_c AS (
  SELECT lang, i, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q
  FROM (SELECT lang, unnest(cls) AS c, unnest(range(7)) AS i FROM base) GROUP BY lang, i
),
doc_c AS (SELECT doc_id, lang, unnest(cls) / length(t)::DOUBLE AS p, unnest(range(7)) AS i FROM base WHERE length(t) >= {p.min_chars}),
dist_c AS (SELECT doc_id, {js} AS class_d FROM doc_c JOIN ref_c USING (lang, i) GROUP BY doc_id),
tok AS (SELECT doc_id, lang, unnest(lw) AS word FROM base),
freq AS (SELECT lang, word, count(*) AS n FROM tok GROUP BY lang, word),
top AS (
  SELECT lang, word, n FROM freq QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {p.common_words}
),
total AS (SELECT lang, sum(n) AS n FROM freq GROUP BY lang),
ref_w AS (
  SELECT top.lang, word, top.n / total.n::DOUBLE AS q FROM top JOIN total USING (lang)
  UNION ALL
  SELECT total.lang, NULL, (any_value(total.n) - sum(top.n)) / any_value(total.n)::DOUBLE FROM total JOIN top USING (lang) GROUP BY total.lang
),
doc_w AS (
  SELECT tok.doc_id, tok.lang, top.word, count(*) AS c FROM tok LEFT JOIN top ON tok.lang = top.lang AND tok.word = top.word
  GROUP BY tok.doc_id, tok.lang, top.word
),
dist_w AS (
  SELECT b.doc_id, {js} AS word_d FROM (
    SELECT b.doc_id, coalesce(doc_w.c, 0) / len(b.w)::DOUBLE AS p, r.q FROM base b
    JOIN ref_w r ON b.lang = r.lang
    LEFT JOIN doc_w ON doc_w.doc_id = b.doc_id AND doc_w.word IS NOT DISTINCT FROM r.word
    WHERE len(b.w) >= {p.min_words}
  ) b GROUP BY b.doc_id
),
flat AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed,
    coalesce(class_d, 0.0) AS class_d, coalesce(word_d, 0.0) AS word_d
  FROM base b LEFT JOIN n_rep USING (doc_id) LEFT JOIN dup USING (doc_id)
  LEFT JOIN dist_c USING (doc_id) LEFT JOIN dist_w USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND class_d <= {p.max_class_distance} AND word_d <= {p.max_word_distance} AS kept,
  round(class_d, 6) AS class_distance, round(word_d, 6) AS word_distance
FROM flat
"""


RULES_SQL = rules_sql()


def near_duplicates_sql(percent: int = 85, shingle: int = 5) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words(lowered("coalesce(text, '')"))} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {shingle - 1}), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {shingle - 2})) AS i FROM d WHERE len(w) >= {shingle})
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND {shingle - 1}
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id
),
link AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= {percent} * (na.n + nb.n - c)
),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a
),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""


NEAR_DUPLICATES_SQL = near_duplicates_sql()


def lines_sql(min_chars: int = 40) -> str:
    # Every run with the characters is covered by such runs of at most as many lines.
    sizes = list(range(1, min_chars + 1))
    return f"""
WITH raw AS (
  SELECT doc_id, text IS NULL AS missing, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS raw FROM documents
),
t AS (SELECT doc_id, missing, l, raw, trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM raw),
ln AS (SELECT doc_id, raw, t, row_number() OVER (PARTITION BY doc_id ORDER BY raw) - 1 AS line FROM t WHERE t <> ''),
doc AS (SELECT doc_id, list(t ORDER BY line) AS ts FROM ln GROUP BY doc_id),
blk AS (
  SELECT doc_id, i, d, list_slice(ts, i + 1, i + d) AS b FROM (
    SELECT doc_id, ts, d, unnest(range(len(ts) - d + 1)) AS i FROM doc, (SELECT unnest({sizes}) AS d) WHERE len(ts) >= d
  )
),
cop AS (
  SELECT doc_id, i, d FROM blk WHERE length(array_to_string(b, '')) >= {min_chars}
  QUALIFY row_number() OVER (PARTITION BY d, b ORDER BY doc_id, i) > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + d)) AS line FROM cop),
runs AS (
  SELECT doc_id, count(*) AS n_runs FROM gone g WHERE NOT EXISTS (SELECT 1 FROM gone h WHERE h.doc_id = g.doc_id AND h.line = g.line - 1)
  GROUP BY doc_id
),
gone_raw AS (SELECT doc_id, raw FROM gone JOIN ln USING (doc_id, line))
SELECT t.doc_id, (CASE WHEN any_value(missing) THEN 0 ELSE count(*) END)::BIGINT AS n_lines, count(g.raw)::BIGINT AS n_deleted,
  coalesce(any_value(n_runs), 0)::BIGINT AS n_runs,
  CASE WHEN NOT any_value(missing) THEN sha256(coalesce(string_agg(l, chr(10) ORDER BY t.raw) FILTER (WHERE g.raw IS NULL), '')) END AS text_sha256
FROM t LEFT JOIN gone_raw g ON g.doc_id = t.doc_id AND g.raw = t.raw LEFT JOIN runs ON runs.doc_id = t.doc_id
GROUP BY t.doc_id
"""


LINES_SQL = lines_sql()


def clusters_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Lloyd's rounds as one chain of tables: x holds components, c0, c1, ... the centroids."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
d{t} AS MATERIALIZED (
  SELECT x.r, c.j, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{t} c USING (i) GROUP BY x.r, c.j
),
a{t} AS MATERIALIZED (SELECT r, j, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if t < rounds:
            steps.append(f"""
m{t} AS (SELECT j, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{t} JOIN x USING (r) GROUP BY j, i),
c{t + 1} AS MATERIALIZED (
  SELECT j, i, CASE WHEN n IS NULL THEN c.x ELSE s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END END::BIGINT AS x
  FROM c{t} c LEFT JOIN m{t} USING (j, i)
)""")
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len([z FOR z IN embedding IF z IS NULL OR NOT isfinite(z)]) = 0
),
x AS MATERIALIZED (SELECT r, i, floor(256 * x)::BIGINT AS x FROM (SELECT r, unnest(range({dims})) AS i, unnest(e) AS x FROM v)),
s AS (SELECT r, row_number() OVER (ORDER BY sha256(concat('2:', vec_id)), vec_id, e) - 1 AS j FROM v QUALIFY j < {k}),
c0 AS MATERIALIZED (SELECT j, i, x FROM s JOIN x USING (r)),
{",".join(steps)},
h AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
SELECT v.vec_id, a.j::INTEGER AS cluster, a.d AS distance,
  (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN h USING (j)
"""


CLUSTERS_SQL = clusters_sql()


def phrases_sql(min_count: int = 10, top: int = 2000, percent: int = 50) -> str:
    return f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lowered("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM p),
g AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS g FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m
  )
),
f AS MATERIALIZED (SELECT lang, g, count(*) AS f FROM g GROUP BY lang, g),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= {min_count}),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM cand),
scored AS (
  SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, (1000000 * a::HUGEINT * a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, list_slice(g, 1, 2) AS g, a FROM cand WHERE len(g) = 3 UNION ALL SELECT lang, list_slice(g, 2, 3), a FROM cand WHERE len(g) = 3
),
longer AS (SELECT lang, g, max(a) AS b FROM inner_ GROUP BY lang, g),
kept AS (
  SELECT b.lang, array_to_string(b.g, ' ') AS phrase, a, l, r, score FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.g = b.g
  WHERE x.b IS NULL OR 100 * x.b < {percent} * a
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank::INTEGER AS rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {top}
"""


PHRASES_SQL = phrases_sql()
