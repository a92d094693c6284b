"""DuckDB oracle SQL for the text layer, UGI/GPI, crosswalk and W1-W3."""

from .oracle_structured import SGI_CTES, WITH_IND
from ..operators.text import SHARE_PRIOR, SHARE_SCALE, START_WEIGHT, TOPIC_SCALE, WORD_PRIOR
from .textual import LEXICON, MIN_CHARS, SHARE_PASSES, TOPIC_PASSES, TOPICS

_TOKS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '')"
_URL = r"""(?i)(?:https?://|www\.)[^\s<>"']+"""
_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _clean(x: str) -> str:
    s = f"regexp_replace({x}, {_lit(_URL)}, ' ', 'g')"
    s = f"regexp_replace({s}, {_lit(_CONTROL)}, ' ', 'g')"
    s = rf"regexp_replace({s}, '\s+', ' ', 'g')"
    return f"regexp_replace({s}, '^ | $', '', 'g')"


def _strip_tags(x: str) -> str:
    s = rf"regexp_replace({x}, '(?is)<script[^>]*>.*?</script\s*>', ' ', 'g')"
    s = rf"regexp_replace({s}, '(?is)<style[^>]*>.*?</style\s*>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?s)<[^>]*>', ' ', 'g')"
    return f"regexp_replace({s}, '&(?:[a-zA-Z]+|#[0-9]+);', ' ', 'g')"


TEXT_CLEAN_FILTER = f"""
WITH u AS (
  SELECT 'doc' AS src, doc_id AS id, text FROM documents
  UNION ALL SELECT 'page' AS src, page_id AS id, {_strip_tags('html')} AS text FROM pages),
c AS (SELECT src, id, {_clean('text')} AS clean FROM u),
f AS (SELECT *, id * 2 + CASE WHEN src = 'page' THEN 1 ELSE 0 END AS uid FROM c WHERE length(clean) >= {MIN_CHARS}),
k AS (SELECT min(uid) AS uid FROM f GROUP BY clean)
SELECT src, id, length(clean) AS n_chars, md5(clean) AS text_md5 FROM f WHERE uid IN (SELECT uid FROM k)"""

_WEIGHT = ("CASE t " + " ".join(f"WHEN {_lit(k)} THEN {float(v)}::DOUBLE" for k, v in LEXICON.items())
           + " ELSE 0.0::DOUBLE END")
_KEYS = "(" + ", ".join(_lit(k) for k in LEXICON) + ")"

_DOCS = f"""
dd AS (
  SELECT doc_id, 'NATION_' || substr(source, 4) AS region_code,
         CAST(1995 + (doc_id // 12) % 6 AS INTEGER) AS YEAR,
         CAST(doc_id % 12 + 1 AS INTEGER) AS MONTH,
         {_TOKS} AS toks
  FROM documents),
ds AS (
  SELECT *, CAST(len(toks) AS BIGINT) AS n_tok,
         CAST(len(list_filter(toks, lambda t: t IN {_KEYS})) AS BIGINT) AS hits,
         coalesce(list_sum(list_transform(toks, lambda t: {_WEIGHT})), 0.0::DOUBLE) AS w
  FROM dd)"""

SENTIMENT_MONTHLY = "WITH " + _DOCS + """
SELECT region_code, YEAR, MONTH, count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens,
       sum(w) / nullif(sum(n_tok), 0) AS sentiment, sum(hits) / nullif(sum(n_tok), 0) AS hit_rate
FROM ds GROUP BY region_code, YEAR, MONTH"""

KEYWORDS_TFIDF = f"""
WITH t AS (SELECT doc_id, unnest({_TOKS}) AS tok FROM documents),
tf AS (SELECT doc_id, tok, count(*) AS tf FROM t GROUP BY doc_id, tok),
df AS (SELECT tok, count(*) AS df FROM tf GROUP BY tok),
n AS (SELECT count(*) AS n FROM documents),
sc AS (SELECT tf.doc_id, tf.tok, tf.tf, tf.tf * ln((n.n + 1.0) / (df.df + 1.0)) AS score
       FROM tf JOIN df ON tf.tok = df.tok CROSS JOIN n),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, tok) AS rank FROM sc)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, tok, tf, round(score, 4) AS score FROM r WHERE rank <= 3"""

KEYWORDS_REGION_MONTH = f"""
WITH t AS (SELECT 'NATION_' || substr(source, 4) AS region_code, CAST(1995 + (doc_id // 12) % 6 AS INTEGER) AS YEAR,
                  CAST(doc_id % 12 + 1 AS INTEGER) AS MONTH, text FROM documents),
u AS (SELECT region_code, YEAR, MONTH, unnest({_TOKS}) AS tok FROM t),
tf AS (SELECT region_code, YEAR, MONTH, tok, count(*) AS tf FROM u GROUP BY ALL),
df AS (SELECT tok, count(*) AS df FROM tf GROUP BY tok),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT region_code, YEAR, MONTH FROM t)),
sc AS (SELECT tf.*, tf.tf * ln((n.n + 1.0) / (df.df + 1.0)) AS score FROM tf JOIN df USING (tok) CROSS JOIN n),
r AS (SELECT *, row_number() OVER (PARTITION BY region_code, YEAR, MONTH ORDER BY score DESC, tok) AS rank FROM sc)
SELECT region_code, YEAR, MONTH, CAST(rank AS INTEGER) AS rank, tok, tf, round(score, 4) AS score FROM r WHERE rank <= 3"""


def _topic_pass(i: int) -> str:
    """One pass: token counts per topic, their totals, document scores, the
    best topic."""
    ks = range(TOPICS)
    counts = ", ".join(f"CAST(sum(CASE WHEN topic = {t} THEN tf ELSE 0 END) AS BIGINT) AS n{t}" for t in ks)
    totals = ", ".join(f"CAST(sum(n{t}) + count(*) AS DOUBLE) AS s{t}" for t in ks)
    score = ", ".join(f"sum(tf * CAST(floor(ln((n{t} + 1) / s{t}) * {TOPIC_SCALE}) AS BIGINT))" for t in ks)
    return f""",
c{i} AS (SELECT tok, {counts} FROM tf JOIN a{i} USING (doc_id) GROUP BY tok),
s{i} AS (SELECT {totals} FROM c{i}),
a{i + 1} AS (SELECT doc_id, CAST(list_position(score, list_max(score)) - 1 AS INTEGER) AS topic FROM (
  SELECT doc_id, [{score}] AS score FROM tf JOIN c{i} USING (tok) CROSS JOIN s{i} GROUP BY doc_id))"""


TOPIC_SQL = f"""
WITH t AS (SELECT doc_id, unnest({_TOKS}) AS tok FROM documents),
tf AS (SELECT doc_id, tok, count(*) AS tf FROM t GROUP BY doc_id, tok),
a0 AS (SELECT DISTINCT doc_id, CAST((doc_id % 2147483648 * 2654435761 % 4294967296) // 65536 % {TOPICS} AS INTEGER) AS topic
       FROM tf)""" + "".join(map(_topic_pass, range(TOPIC_PASSES))) + f"""
SELECT doc_id, topic FROM documents LEFT JOIN a{TOPIC_PASSES} USING (doc_id)"""


def _share_pass(i: int) -> str:
    """One pass: dealt tokens summed by token and by document, and dealt again."""
    ks = range(TOPICS)
    sums = lambda n: ", ".join(f"CAST(sum(q{t}) AS BIGINT) AS {n}{t}" for t in ks)
    totals = ", ".join(f"CAST(sum(n{t}) + {WORD_PRIOR} * count(*) AS DOUBLE) AS u{t}" for t in ks)
    each = ", ".join(f"CAST(m{t} + {SHARE_PRIOR} AS DOUBLE) * (CAST(n{t} + {WORD_PRIOR} AS DOUBLE) / u{t}) AS p{t}" for t in ks)
    whole = " + ".join(f"p{t}" for t in ks)
    dealt = ", ".join(f"tf * CAST(floor(p{t} / p * {SHARE_SCALE}) AS BIGINT) AS q{t}" for t in ks)
    return f""",
n{i} AS MATERIALIZED (SELECT tok, {sums("n")} FROM d{i} GROUP BY tok),
u{i} AS MATERIALIZED (SELECT {totals} FROM n{i}),
m{i} AS (SELECT doc_id, {sums("m")} FROM d{i} GROUP BY doc_id),
d{i + 1} AS MATERIALIZED (SELECT doc_id, tok, {dealt} FROM (SELECT *, {whole} AS p FROM (
  SELECT doc_id, tok, tf, {each} FROM tf JOIN m{i} USING (doc_id) JOIN n{i} USING (tok) CROSS JOIN u{i})))"""


_START = ", ".join(f"tf * CASE WHEN topic = {t} THEN {SHARE_SCALE * START_WEIGHT // (START_WEIGHT + TOPICS - 1)} "
                   f"ELSE {SHARE_SCALE // (START_WEIGHT + TOPICS - 1)} END AS q{t}" for t in range(TOPICS))
_PARTS = ", ".join(f"CAST(floor(m{t} / n * 1000000) AS BIGINT)" for t in range(TOPICS))
_SHARES = ", ".join(f"parts[{t + 1}] + CASE WHEN topic = {t} THEN 1000000 - CAST(list_sum(parts) AS BIGINT) ELSE 0 END AS share{t}"
                    for t in range(TOPICS))

# the seeds are those of TOPIC_SQL
TOPIC_SHARES_SQL = TOPIC_SQL[:TOPIC_SQL.rindex("SELECT")].rstrip() + f""",
d0 AS (SELECT doc_id, tok, {_START} FROM tf JOIN a{TOPIC_PASSES} USING (doc_id))""" + "".join(
    map(_share_pass, range(SHARE_PASSES))) + f""",
m AS (SELECT doc_id, {", ".join(f"CAST(sum(q{t}) AS BIGINT) AS m{t}" for t in range(TOPICS))} FROM d{SHARE_PASSES} GROUP BY doc_id),
p AS (SELECT doc_id, [{_PARTS}] AS parts FROM (
  SELECT *, CAST({" + ".join(f"m{t}" for t in range(TOPICS))} AS DOUBLE) AS n FROM m)),
b AS (SELECT *, CAST(list_position(parts, list_max(parts)) - 1 AS INTEGER) AS topic FROM p)
SELECT doc_id, {_SHARES}, topic FROM documents LEFT JOIN b USING (doc_id)"""

_CENTROID = """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(generate_series(1, len(v))) AS pos, unnest(v) AS val FROM e),
c AS (SELECT label, pos, avg(val) AS m FROM x GROUP BY label, pos),
cc AS (SELECT label, list(m ORDER BY pos) AS centroid FROM c GROUP BY label),
cos AS (SELECT e.vec_id, e.label, list_cosine_similarity(e.v, cc.centroid) AS cosine
        FROM e LEFT JOIN cc ON e.label = cc.label)"""

EMBEDDING_CENTROID_COSINE = "WITH " + _CENTROID + "\nSELECT vec_id, label, round(cosine, 6) AS cosine FROM cos"

_UGI_FEATS = ["sentiment", "hit_rate", "n_docs", "cosine"]


def _z(c):
    return f"({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0)"


_UZ = ", ".join(f"{_z(c)} AS z_{c}" for c in _UGI_FEATS)
_URAW = ("(" + " + ".join(f"coalesce(z_{c}, 0)" for c in _UGI_FEATS) + ") / nullif("
         + " + ".join(f"CASE WHEN z_{c} IS NULL THEN 0 ELSE 1 END" for c in _UGI_FEATS) + ", 0)")

UGI_CTES = _DOCS + "," + _CENTROID + f""",
uf AS (
  SELECT ds.region_code, ds.YEAR, ds.MONTH,
         sum(ds.w) / nullif(sum(ds.n_tok), 0) AS sentiment,
         sum(ds.hits) / nullif(sum(ds.n_tok), 0) AS hit_rate,
         CAST(count(*) AS DOUBLE) AS n_docs,
         avg(cos.cosine) AS cosine
  FROM ds LEFT JOIN cos ON ds.doc_id = cos.vec_id
  GROUP BY 1, 2, 3),
uz AS (SELECT *, {_UZ} FROM uf),
ur AS (SELECT *, {_URAW} AS raw FROM uz),
u AS (SELECT *, 100.0 * ((raw - min(raw) OVER ()) / nullif(max(raw) OVER () - min(raw) OVER (), 0)) AS ugi FROM ur)"""

UGI_INDEX = "WITH " + UGI_CTES + """
SELECT region_code, YEAR, MONTH, sentiment, hit_rate, n_docs, round(cosine, 6) AS cosine, round(ugi, 4) AS ugi FROM u"""

GPI_INDEX = "WITH " + SGI_CTES + ",\n" + UGI_CTES + """,
uq AS (SELECT region_code, CAST(YEAR * 10 + ceil(MONTH / 3) AS INTEGER) AS period, avg(ugi) AS ugi
       FROM u GROUP BY 1, 2)
SELECT coalesce(s.region_code, uq.region_code) AS region_code, coalesce(s.period, uq.period) AS period,
       round(s.sgi, 4) AS sgi, round(uq.ugi, 4) AS ugi, round(s.sgi + uq.ugi, 4) AS gpi
FROM s FULL OUTER JOIN uq ON s.region_code = uq.region_code AND s.period = uq.period"""

REGION_STANDARDISE = """
SELECT c.c_custkey, c.c_nationkey, m.region_code
FROM customer c LEFT JOIN (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS code, r.r_name AS region_code
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) m
ON CAST(c.c_nationkey AS VARCHAR) = m.code"""

ZSCORE = WITH_IND + """
SELECT region_code, period, sales,
       round((sales - avg(sales) OVER ()) / nullif(stddev_pop(sales) OVER (), 0), 6) AS z
FROM ind"""

MINMAX_100 = WITH_IND + """
SELECT region_code, period, sales,
       round(100.0 * ((sales - min(sales) OVER (PARTITION BY period))
             / nullif(max(sales) OVER (PARTITION BY period) - min(sales) OVER (PARTITION BY period), 0)), 6) AS score
FROM ind"""

PERIOD_CHANGE = WITH_IND + """
SELECT region_code, period, sales,
       CASE WHEN lag(period) OVER (PARTITION BY region_code ORDER BY period) = CASE WHEN period % 10 = 1 THEN period - 7 ELSE period - 1 END
         THEN sales - lag(sales) OVER (PARTITION BY region_code ORDER BY period) END AS change
FROM ind"""
