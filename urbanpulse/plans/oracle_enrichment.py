"""DuckDB SQL of the queries in ``enrichment``."""

from ..operators.text import LEXICON_SCALE, VECTOR_SCALE
from .enrichment import CODES, LEAST, MIN_LINKS, NEGATORS, PHRASES, REGIONS, ROUNDS, SEEDS
from .oracle_structured import WITH_IND
from .oracle_textual import _TOKS, _lit

REGION_APPORTION = f"""
WITH t AS (
  SELECT CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey % {CODES} END AS code,
    year(l_shipdate) * 10 + quarter(l_shipdate) AS period, sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT)) AS total
  FROM lineitem GROUP BY ALL),
w AS (SELECT s_suppkey % {CODES} AS code, 'R' || (s_nationkey % {REGIONS}) AS region_code, sum(s_suppkey % 9 + 1)::HUGEINT AS weight
      FROM supplier WHERE s_suppkey % {CODES} % 13 <> 5 GROUP BY ALL),
p AS (SELECT t.*, region_code, weight, sum(weight) OVER (PARTITION BY period, t.code) AS whole FROM t LEFT JOIN w ON t.code = w.code),
r AS (SELECT *, total * weight // whole AS part, total * weight % whole AS rest FROM p),
x AS (SELECT *, total - sum(part) OVER (PARTITION BY period, code) AS spare,
        row_number() OVER (PARTITION BY period, code ORDER BY rest DESC, region_code) AS k FROM r)
SELECT CAST(period AS INTEGER) AS period, region_code,
  CAST(sum(CASE WHEN weight IS NULL THEN total ELSE part + CASE WHEN k <= spare THEN 1 ELSE 0 END END) AS BIGINT) AS cents
FROM x GROUP BY ALL"""

CALENDAR_SPINE = WITH_IND + """,
s AS (SELECT region_code, period, sales FROM ind WHERE (period // 10 * 4 + period % 10 + length(region_code)) % 5 <> 0),
q AS (SELECT unnest(generate_series(min(period // 10 * 4 + period % 10 - 1), max(period // 10 * 4 + period % 10 - 1))) AS q FROM s),
g AS (SELECT region_code, CAST(q // 4 * 10 + q % 4 + 1 AS INTEGER) AS period FROM (SELECT DISTINCT region_code FROM s) CROSS JOIN q)
SELECT g.region_code, g.period, s.sales, s.period IS NULL AS is_missing,
  last_value(s.sales IGNORE NULLS) OVER (PARTITION BY g.region_code ORDER BY g.period
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
FROM g LEFT JOIN s ON s.region_code = g.region_code AND s.period = g.period"""

_SEEDS = ", ".join(f"({_lit(t)}, {round(w * LEXICON_SCALE)})" for t, w in SEEDS.items())


def _round(i: int) -> str:
    return f""",
w{i + 1} AS (
  SELECT tok, w FROM seeds UNION ALL
  SELECT tok, w FROM (
    SELECT l.tok, CAST(floor(CAST(sum(n * w{i}.w) AS DOUBLE) / max(degree)) AS BIGINT) AS w
    FROM links l JOIN w{i} ON l.near = w{i}.tok JOIN deg ON deg.tok = l.tok
    WHERE degree >= {MIN_LINKS} AND l.tok NOT IN (SELECT tok FROM seeds) GROUP BY l.tok)
  WHERE abs(w) >= {LEAST * LEXICON_SCALE})"""


_LEXICON = f"""
tk AS (SELECT {_TOKS} AS toks FROM documents),
pr AS (SELECT unnest(list_transform(range(1, len(toks)), lambda i: {{'a': toks[i], 'b': toks[i + 1]}})) AS p FROM tk WHERE len(toks) > 1),
pc AS (SELECT p.a AS a, p.b AS b, count(*) AS n FROM pr WHERE p.a <> p.b GROUP BY ALL),
links AS (SELECT tok, near, sum(n) AS n FROM (SELECT a AS tok, b AS near, n FROM pc UNION ALL SELECT b, a, n FROM pc) GROUP BY ALL),
deg AS (SELECT tok, CAST(sum(n) AS DOUBLE) AS degree FROM links GROUP BY tok),
seeds AS (SELECT * FROM (VALUES {_SEEDS}) v(tok, w)),
w0 AS (SELECT tok, CAST(w AS BIGINT) AS w FROM seeds)""" + "".join(map(_round, range(ROUNDS)))

LEXICON_INDUCED = f"""WITH {_LEXICON}
SELECT tok, CAST(w AS DOUBLE) / {LEXICON_SCALE} AS weight, tok IN (SELECT tok FROM seeds) AS is_seed FROM w{ROUNDS}"""

_NEG = "(" + ", ".join(map(_lit, NEGATORS)) + ")"
_KEYED = f"""SELECT 'NATION_' || substr(source, 4) AS region_code, CAST(1995 + (doc_id // 12) % 6 AS INTEGER) AS YEAR,
    CAST(doc_id % 12 + 1 AS INTEGER) AS MONTH, {_TOKS} AS toks FROM documents"""

SENTIMENT_INDUCED = f"""WITH {_LEXICON},
dk AS ({_KEYED}),
ds AS (SELECT region_code, YEAR, MONTH, count(*) AS n_docs, sum(len(toks)) AS n_tokens FROM dk GROUP BY ALL),
tt AS (SELECT region_code, YEAR, MONTH, unnest(list_transform(toks, lambda t, i: {{'t': t,
    'turned': coalesce(toks[i - 1] IN {_NEG} AND i > 1, false) OR coalesce(toks[i - 2] IN {_NEG} AND i > 2, false)}})) AS x FROM dk),
hs AS (SELECT region_code, YEAR, MONTH, count(*) AS hits, sum(CASE WHEN x.turned THEN -w ELSE w END) AS s
       FROM tt JOIN w{ROUNDS} ON x.t = w{ROUNDS}.tok GROUP BY ALL)
SELECT region_code, YEAR, MONTH, n_docs, CAST(n_tokens AS BIGINT) AS n_tokens,
  round(CAST(coalesce(s, 0) AS DOUBLE) / {LEXICON_SCALE} / nullif(n_tokens, 0), 9) + 0.0::DOUBLE AS sentiment,
  round(coalesce(hits, 0) / nullif(n_tokens, 0), 9) AS hit_rate
FROM ds LEFT JOIN hs USING (region_code, YEAR, MONTH)"""


def _cell(k, r, c):
    return f"CASE WHEN {k} > 0 THEN {k} * ln({k} * nn / (({r}) * ({c}))) ELSE 0 END"


PHRASES_REGION_MONTH = f"""
WITH dk AS ({_KEYED}),
pr AS (SELECT region_code, YEAR, MONTH, unnest(list_transform(range(1, len(toks)), lambda i: {{'a': toks[i], 'b': toks[i + 1]}})) AS p
       FROM dk WHERE len(toks) > 1),
tf AS (SELECT region_code, YEAR, MONTH, p.a AS a, p.b AS b, count(*) AS tf FROM pr GROUP BY ALL),
c AS (SELECT a, b, CAST(sum(tf) AS DOUBLE) AS k, count(*) AS gf FROM tf GROUP BY ALL),
l AS (SELECT *, sum(k) OVER (PARTITION BY a) AS r, sum(k) OVER (PARTITION BY b) AS s, sum(k) OVER () AS nn FROM c),
m AS (SELECT *, 2 * ({_cell("k", "r", "s")} + {_cell("(r - k)", "r", "nn - s")} + {_cell("(s - k)", "nn - r", "s")}
        + {_cell("(nn - r - s + k)", "nn - r", "nn - s")}) AS llr FROM l),
g AS (SELECT count(*) AS g FROM (SELECT DISTINCT region_code, YEAR, MONTH FROM dk)),
x AS (SELECT region_code, YEAR, MONTH, a || ' ' || b AS phrase, tf, llr, tf * ln((g + 1.0) / (gf + 1.0)) AS score
      FROM tf JOIN m USING (a, b) CROSS JOIN g WHERE llr >= 10.83 AND k * nn > r * s)
SELECT region_code, YEAR, MONTH, CAST(row_number() OVER (PARTITION BY region_code, YEAR, MONTH ORDER BY score DESC, phrase) AS INTEGER) AS rank,
  phrase, tf, round(llr, 4) AS llr, round(score, 4) AS score
FROM x QUALIFY rank <= {PHRASES}"""

EMBEDDING_DRIFT = f"""
WITH k AS (SELECT doc_id, 'NATION_' || substr(source, 4) AS region_code, CAST(1995 + (doc_id // 12) % 6 AS INTEGER) AS YEAR,
             CAST(doc_id % 12 + 1 AS INTEGER) AS MONTH FROM documents),
x AS (SELECT region_code, YEAR, MONTH, unnest(generate_series(1, len(embedding))) AS pos, unnest(embedding) AS v
      FROM k JOIN embeddings ON vec_id = doc_id),
s AS (SELECT region_code, YEAR, MONTH, pos, sum(floor(CAST(v AS DOUBLE) * {VECTOR_SCALE})) AS s, count(*) AS n FROM x GROUP BY ALL),
m AS (SELECT region_code, YEAR, MONTH, list(s ORDER BY pos) AS v, max(n) AS n_vectors FROM s GROUP BY ALL),
w AS (SELECT *, lag(v) OVER o AS before, lag(YEAR * 12 + MONTH) OVER o AS last FROM m WINDOW o AS (PARTITION BY region_code ORDER BY YEAR, MONTH))
SELECT region_code, YEAR, MONTH, n_vectors,
  round(CASE WHEN last = YEAR * 12 + MONTH - 1 THEN list_cosine_similarity(v, before) END, 6) AS drift FROM w"""
