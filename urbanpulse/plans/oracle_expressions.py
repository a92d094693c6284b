"""DuckDB oracle SQL for the expression-level queries."""

from .expressions import PRIORITY_BANDS

STRING_CLEAN = """
SELECT p_partkey,
       CASE WHEN p_size > 45 THEN '' ELSE trim(p_name) END AS name_clean,
       p_brand || ',' || p_type || ',' || CAST(p_size AS VARCHAR) AS attrs
FROM part"""

NUMBER_LENIENT = """
SELECT o_orderkey, CAST(o_orderkey % 8 AS INTEGER) AS variant,
       CASE WHEN o_orderkey % 8 IN (0, 1, 5) THEN o_totalprice END AS price
FROM orders"""

NUMBER_STRICT = """
SELECT o_orderkey, CAST(o_orderkey % 8 AS INTEGER) AS variant,
       CASE WHEN o_orderkey % 8 IN (0, 1) THEN o_totalprice END AS price
FROM orders"""

NUMERIC_BY_LIST = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
       CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem"""

NUMERIC_BY_NAME = """
SELECT CAST(l_orderkey AS VARCHAR) AS TRDAR_CD, CAST(l_suppkey AS VARCHAR) AS SVC_INDUTY_CD,
       l_returnflag AS TRDAR_SE_CD, l_extendedprice AS THSMON_SELNG_AMT,
       l_quantity AS THSMON_SELNG_CO, l_discount AS WKEND_SELNG_AMT,
       l_tax AS TMZON_21_24_SELNG_AMT, l_linestatus AS "비고",
       CAST(l_linenumber AS DOUBLE) AS "기타_매출"
FROM lineitem"""

MINI_PROJECTION = """
SELECT CAST(l_orderkey AS VARCHAR) AS SGG_CD, CAST(l_partkey AS VARCHAR) AS BJDONG_CD,
       CAST(l_suppkey AS VARCHAR) AS BLDG_NM, CAST(l_linenumber AS DOUBLE) AS OBJ_AMT,
       CAST(l_quantity AS VARCHAR) AS DEAL_YMD
FROM lineitem"""

FILTER_ANY_COLUMN = """
SELECT * FROM part
WHERE contains(CAST(p_partkey AS VARCHAR), 'ring') OR contains(p_name, 'ring')
   OR contains(p_brand, 'ring') OR contains(p_type, 'ring')
   OR contains(CAST(p_size AS VARCHAR), 'ring') OR contains(CAST(p_retailprice AS VARCHAR), 'ring')"""

_ORDERS_OUT = """o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority"""

FILTER_CODE_SET = f"""
SELECT {_ORDERS_OUT} FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""

FILTER_OPTIONAL_COLUMN = """
SELECT strftime(ts, '%Y%m%d') AS STDR_DE_ID, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS TMZON_PD_SE,
       CAST(user_id AS VARCHAR) AS ADSTRD_CODE_SE, value AS TOT_LVPOP_CO, event_id
FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 250.0)"""

FILTER_PERIOD = """
WITH s AS (
  SELECT l_orderkey, l_linenumber,
         CAST(year(l_shipdate) AS VARCHAR) || CAST(quarter(l_shipdate) AS VARCHAR) AS STDR_YYQU_CD,
         CAST(year(l_shipdate) AS INTEGER) AS YEAR, CAST(quarter(l_shipdate) AS INTEGER) AS QUARTER
  FROM lineitem)
SELECT *, YEAR * 10 + QUARTER AS period FROM s WHERE YEAR * 10 + QUARTER BETWEEN 19962 AND 19983"""

FILTER_MONTH_END = """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS STDR_DE_ID
FROM lineitem
WHERE CAST(l_shipdate AS DATE) = last_day(CAST(l_shipdate AS DATE))
  AND year(l_shipdate) BETWEEN 1995 AND 2001"""

VALID_PERIOD = """
WITH t AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d')
              WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y.%-m.%-d')
              ELSE strftime(l_shipdate, '%Y%m%d') END AS CTRT_DAY
  FROM lineitem),
d AS (SELECT *, regexp_replace(CTRT_DAY, '[^0-9]', '', 'g') AS dg FROM t),
p AS (
  SELECT l_orderkey, l_linenumber, CTRT_DAY,
         CASE WHEN length(dg) >= 4 THEN TRY_CAST(substr(dg, 1, 4) AS INTEGER) END AS YEAR,
         CASE WHEN length(dg) >= 6 THEN TRY_CAST(substr(dg, 5, 2) AS INTEGER) END AS MONTH
  FROM d)
SELECT * FROM p WHERE MONTH BETWEEN 1 AND 12"""

DEDUP_ROWS = f"""
SELECT DISTINCT {_ORDERS_OUT}
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)"""


def _band_cols():
    ages = {"20세부터24세생활인구수": "20_24", "25세부터29세생활인구수": "25_29",
            "30세부터34세생활인구수": "30_34", "65세부터69세생활인구수": "65_69",
            "70세이상생활인구수": "70_ABOVE"}
    cols = []
    for gender, cond in (("MALE", "o_orderstatus = 'F'"), ("FEMALE", "o_orderstatus <> 'F'")):
        for pr, band in PRIORITY_BANDS.items():
            cols.append((f"{gender}_F{ages[band]}", f"{cond} AND o_orderpriority = '{pr}'"))
    return cols


BAND_COLS = _band_cols()

BAND_RENAME = """
SELECT CAST(c.c_nationkey AS VARCHAR) AS ADSTRD_CODE_SE,
       strftime(last_day(CAST(o.o_orderdate AS DATE)), '%Y%m%d') AS STDR_DE_ID,
       CAST(count(*) AS DOUBLE) AS TOT_LVPOP_CO,
       """ + ",\n       ".join(f"CAST(count_if({cond}) AS DOUBLE) AS {name}" for name, cond in BAND_COLS) + """
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2"""

BAND_UNPIVOT = "WITH w AS (" + BAND_RENAME + """)
SELECT ADSTRD_CODE_SE, STDR_DE_ID, TOT_LVPOP_CO, band,
       regexp_extract(band, '^([A-Z]+)_F', 1) AS gender,
       TRY_CAST(regexp_extract(band, '_F([0-9]+)_', 1) AS INTEGER) AS age_lo,
       TRY_CAST(regexp_extract(band, '_F[0-9]+_([0-9]+)$', 1) AS INTEGER) AS age_hi,
       n
FROM (UNPIVOT w ON """ + ", ".join(n for n, _ in BAND_COLS) + """ INTO NAME band VALUE n)"""
