"""DuckDB SQL of the queries in ``arrivals``."""

from .arrivals import BANDS, CODES, FILE_ORDERS, LIMIT, PAGE, PERIOD, REGIONS, RELOADED
from .city import CITY_INDICATORS_SQL
from .oracle_structured import _z

PAGE_RECONCILIATION = f"""
WITH e AS (SELECT event_id // {PERIOD} AS period, event_id % {PERIOD} // {PAGE} + 1 AS page FROM events),
p AS (SELECT period, page, count(*) AS n, period % 7 AS kind FROM e GROUP BY ALL),
t AS (SELECT period, sum(n) AS n FROM p GROUP BY 1),
-- what lands: without page 2 of kind 1; rows by kind
l AS (
  SELECT period, kind, page, (page - 1) * {PAGE} + 1 AS first, CASE WHEN kind = 4 AND page = 1 THEN 2 ELSE 1 END AS times,
    kind = 3 AND page = 3 AS bad, kind = 6 AND page = 4 AS error,
    CASE WHEN (kind = 3 AND page = 3) OR (kind = 6 AND page = 4) THEN 0 WHEN kind = 2 AND page = 1 THEN greatest(n - 10, 0) ELSE n END AS received
  FROM p WHERE NOT (kind = 1 AND page = 2)),
a AS (
  SELECT l.period, max(t.n) + CASE WHEN l.period % 7 = 5 THEN 500 ELSE 0 END AS announced, sum(times) AS n_pages,
    count_if(bad) AS n_malformed, sum(times - 1) AS n_repeated, sum(received) AS received,
    list(first) FILTER (NOT bad AND NOT error) AS have, list({{'first': first, 'received': received}}) FILTER (NOT bad AND NOT error) AS pages
  FROM l JOIN t ON t.period = l.period GROUP BY l.period),
x AS (SELECT *, CAST(least(announced, {LIMIT}) AS BIGINT) AS expected FROM a),
y AS (
  SELECT *, expected - list_sum(list_transform(pages, lambda p: least(p.received, least(p.first + {PAGE} - 1, expected) - p.first + 1))) AS missing_rows,
    list_filter(range(1, expected + 1, {PAGE}), lambda s: NOT list_contains(have, s)) AS gaps FROM x)
SELECT period, CAST(announced AS BIGINT) AS announced, CAST(n_pages AS BIGINT) AS n_pages, CAST(n_malformed AS BIGINT) AS n_malformed,
  CAST(len(list_filter(pages, lambda p: p.received < least(p.first + {PAGE} - 1, expected) - p.first + 1)) AS BIGINT) AS n_cut,
  CAST(n_repeated AS BIGINT) AS n_repeated, CAST(expected AS BIGINT) AS expected, CAST(received AS BIGINT) AS received,
  CAST(missing_rows AS BIGINT) AS missing_rows,
  array_to_string(list_transform(gaps, lambda s: s || '-' || least(s + {PAGE} - 1, expected)), ',') AS missing,
  CASE WHEN missing_rows > 0 THEN 'incomplete' WHEN announced > {LIMIT} THEN 'capped' ELSE 'complete' END AS status
FROM y"""

_KIND = "o_orderkey % 10"
_FILE = f"o_orderkey // {FILE_ORDERS}"

CSV_HOSTILE_RECORDS = f"""
SELECT o_orderkey, CASE WHEN {_KIND} <> 3 THEN o_custkey END AS o_custkey,
  CASE WHEN {_KIND} = 0 THEN 'say "' || o_orderpriority || '"' WHEN {_KIND} = 1 THEN o_orderpriority || chr(92)
       WHEN {_KIND} = 2 AND {_FILE} % 2 = 0 THEN o_orderpriority || chr(10) || o_orderstatus
       WHEN {_KIND} = 3 THEN NULL WHEN {_KIND} = 4 THEN o_orderpriority
       ELSE o_orderpriority || ', ' || o_orderstatus END AS o_note,
  {_KIND} NOT IN (3, 4) AS is_good
FROM orders"""

CSV_REJECT_TABLE = f"""
SELECT CAST({_FILE} AS BIGINT) AS file, CASE WHEN {_KIND} = 3 THEN 'short' ELSE 'long' END AS reason, 3 AS n_expected,
  CASE WHEN {_KIND} = 3 THEN 1 ELSE 5 END AS n_fields, CAST(o_orderkey AS VARCHAR) AS first_field,
  CASE WHEN {_KIND} = 3 THEN CAST(o_orderkey AS VARCHAR)
       ELSE concat_ws(',', o_orderkey, o_custkey, o_orderpriority, o_orderstatus, 'x') END AS raw
FROM orders WHERE {_KIND} IN (3, 4)"""

CSV_HEADER_DRIFT = """
SELECT o_orderkey, CASE WHEN year(o_orderdate) % 4 <> 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice,
  CASE WHEN year(o_orderdate) % 2 = 1 THEN o_orderpriority END AS o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS YEAR
FROM orders"""


def _bands(low, high):
    return " + ".join(f"o_orderkey % {m}" for _, lo, _, m in BANDS if low <= lo <= high)


_SHARES = f"""
pop AS (
  SELECT 'R' || (o_custkey % {CODES} % {REGIONS}) AS region_code, CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS period,
    avg(CAST({_bands(20, 35)} AS DOUBLE)) / avg(CAST(o_orderkey % 100 + 200 AS DOUBLE)) AS youth_share,
    avg(CAST({_bands(65, 999)} AS DOUBLE)) / avg(CAST(o_orderkey % 100 + 200 AS DOUBLE)) AS senior_share
  FROM orders WHERE o_orderdate IS NOT NULL AND o_custkey % {CODES} % 11 <> 0 GROUP BY 1, 2),
chg AS (
  SELECT *, CASE WHEN lag(period) OVER w = CASE WHEN period % 10 = 1 THEN period - 7 ELSE period - 1 END
      THEN youth_share - lag(youth_share) OVER w END AS youth_inflow,
    CASE WHEN lag(period) OVER w = CASE WHEN period % 10 = 1 THEN period - 7 ELSE period - 1 END
      THEN lag(senior_share) OVER w - senior_share END AS senior_outflow
  FROM pop WINDOW w AS (PARTITION BY region_code ORDER BY period))"""

YOUTH_INFLOW_BANDS = f"""WITH {_SHARES}
SELECT region_code, period, round(youth_share, 10) AS youth_share, round(senior_share, 10) AS senior_share,
  round(youth_inflow, 10) + 0.0::DOUBLE AS youth_inflow, round(senior_outflow, 10) + 0.0::DOUBLE AS senior_outflow FROM chg"""

_IND = ["price", "rent", "sales", "youth_inflow", "senior_outflow"]
_ZCOLS = [f"z_{c}" for c in _IND]
DAILY_RUN_INDEX = f"""
WITH city AS ({CITY_INDICATORS_SQL.replace("round(value, 3) AS value", "value")}),
{_SHARES},
long AS (
  SELECT * FROM city UNION ALL SELECT region_code, period, 'youth_inflow', youth_inflow FROM chg WHERE youth_inflow IS NOT NULL
  UNION ALL SELECT region_code, period, 'senior_outflow', senior_outflow FROM chg WHERE senior_outflow IS NOT NULL),
wide AS (SELECT region_code, period, {", ".join(f"max(value) FILTER (indicator = '{c}') AS {c}" for c in _IND)} FROM long GROUP BY 1, 2),
z AS (SELECT *, {", ".join(f"{_z(c)} AS z_{c}" for c in _IND)} FROM wide),
r AS (SELECT *, ({" + ".join(f"coalesce({z}, 0)" for z in _ZCOLS)})
    / nullif({" + ".join(f"CASE WHEN {z} IS NULL THEN 0 ELSE 1 END" for z in _ZCOLS)}, 0) AS raw FROM z)
SELECT region_code, period, {", ".join(f"round({c}, 4) + 0.0::DOUBLE AS {c}" for c in _IND)},
  round(100.0 * ((raw - min(raw) OVER ()) / nullif(max(raw) OVER () - min(raw) OVER (), 0)), 4) AS sgi FROM r"""

INDICATORS_INCREMENTAL = f"""
WITH city AS ({CITY_INDICATORS_SQL.replace("round(value, 3) AS value", "value")})
SELECT region_code, period,
  round(max(CASE WHEN indicator = 'price' THEN value * CASE WHEN period // 10 = {RELOADED} THEN 2 ELSE 1 END END), 3) AS price,
  round(max(value) FILTER (indicator = 'rent'), 3) AS rent, round(max(value) FILTER (indicator = 'sales'), 3) AS sales
FROM city GROUP BY ALL"""
