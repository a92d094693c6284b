"""DuckDB oracle SQL for sources, sinks and processed jobs."""

from .oracle_structured import SGI

_ORDERS_TYPED = """o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
       o_orderpriority || ', ' || o_orderstatus AS o_note"""

CSV_LANDING_SCAN = f"SELECT {_ORDERS_TYPED}, false AS is_corrupt FROM orders"

PROCESSED_SALES = """
SELECT CAST(l_suppkey AS VARCHAR) AS TRDAR_CD, 'TRDAR_' || CAST(l_suppkey AS VARCHAR) AS TRDAR_CD_NM,
       'CS' || CAST(l_linenumber AS VARCHAR) AS SVC_INDUTY_CD, 'SVC_' || l_linestatus AS SVC_INDUTY_CD_NM,
       CAST(year(l_shipdate) AS INTEGER) AS YEAR, CAST(quarter(l_shipdate) AS INTEGER) AS QUARTER,
       l_extendedprice AS THSMON_SELNG_AMT, l_quantity AS THSMON_SELNG_CO, l_discount AS WKEND_SELNG_AMT,
       CAST(l_linenumber AS DOUBLE) AS TMZON_21_24_SELNG_AMT, l_tax AS TMZON_00_06_SELNG_AMT,
       CAST(l_partkey AS DOUBLE) AS AGRDE_20_SELNG_AMT, CAST(l_orderkey AS DOUBLE) AS AGRDE_30_SELNG_AMT,
       'sales' AS DATA_SRC
FROM lineitem"""

CSV_SUBSET_BY_NAME = PROCESSED_SALES

CSV_MULTI_YEAR = f"SELECT {_ORDERS_TYPED}, CAST(year(o_orderdate) AS INTEGER) AS YEAR FROM orders"

JSON_PAGES_INLINE = """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text
FROM events"""

PARQUET_MULTI_UNION = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"

EXTERNAL_TEXT_TABLE = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

PARQUET_SINK_ROUNDTRIP = CSV_MULTI_YEAR

REGION_PARTITIONED_SINK = SGI

_PROFILE_COLS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")]
PROFILE_TABLE = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count, "
    f"count(*) AS row_count FROM customer" for c, t in _PROFILE_COLS)

SAMPLE_ROWS = "SELECT * FROM customer ORDER BY c_custkey LIMIT 10"

HEADER_NORMALISE = """
SELECT CAST(n_nationkey AS VARCHAR) AS "기준일ID", n_name AS "시간대구분",
       CAST(n_regionkey AS VARCHAR) AS "행정동코드", 'x' || CAST(n_nationkey AS VARCHAR) AS "기타"
FROM nation"""

RENAME_MAP = """
SELECT CAST(n_nationkey AS VARCHAR) AS STDR_DE_ID, n_name AS TMZON_PD_SE,
       CAST(n_regionkey AS VARCHAR) AS ADSTRD_CODE_SE, 'x' || CAST(n_nationkey AS VARCHAR) AS "기타"
FROM nation"""

PROCESSED_DEALS = """
WITH t AS (
  SELECT *, CASE WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d')
                 WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y.%-m.%-d')
                 ELSE strftime(l_shipdate, '%Y%m%d') END AS CTRT_DAY
  FROM lineitem),
d AS (SELECT *, regexp_replace(CTRT_DAY, '[^0-9]', '', 'g') AS dg FROM t)
SELECT CAST(l_suppkey AS VARCHAR) AS CGG_CD, CAST(l_partkey AS VARCHAR) AS STDG_CD,
       CASE WHEN length(dg) >= 4 THEN TRY_CAST(substr(dg, 1, 4) AS INTEGER) END AS YEAR,
       CASE WHEN length(dg) >= 6 THEN TRY_CAST(substr(dg, 5, 2) AS INTEGER) END AS MONTH,
       l_extendedprice AS THING_AMT, l_quantity AS ARCH_AREA, l_tax AS LAND_AREA,
       CAST(l_linenumber AS VARCHAR) AS FLR, l_returnflag AS RGHT_SE, 'real_estate' AS DATA_SRC
FROM d"""

PROCESSED_RENT = """
SELECT CAST(o_custkey AS VARCHAR) AS CGG_CD, CAST(o_orderkey AS VARCHAR) AS STDG_CD,
       CAST(year(o_orderdate) AS INTEGER) AS YEAR, CAST(month(o_orderdate) AS INTEGER) AS MONTH,
       o_orderstatus AS RENT_SE,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey % 97 + 20 AS DOUBLE) END AS RENT_AREA,
       o_totalprice AS GRFE,
       CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE CAST(o_custkey % 50 AS DOUBLE) END AS RTFE,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS BFR_GRFE,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0::DOUBLE END AS BFR_RTFE,
       CASE WHEN o_orderstatus = 'O' THEN '신규' ELSE '갱신' END AS NEW_UPDT_YN,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS CTRT_UPDT_USE_YN,
       'rent' AS DATA_SRC
FROM orders"""

PROCESSED_POPULATION = """
SELECT CAST(user_id AS VARCHAR) AS ADSTRD_CODE_SE, CAST(year(ts) AS INTEGER) AS YEAR,
       CAST(month(ts) AS INTEGER) AS MONTH, value AS TOT_LVPOP_CO, 'population' AS DATA_SRC
FROM events"""

LOAD_COUNTS = """
SELECT DATA_SRC, YEAR, count(*) AS n_rows FROM (
  SELECT 'real_estate' AS DATA_SRC, CAST(year(l_shipdate) AS INTEGER) AS YEAR FROM lineitem
  UNION ALL SELECT 'rent', CAST(year(o_orderdate) AS INTEGER) FROM orders
  UNION ALL SELECT 'sales', CAST(year(l_shipdate) AS INTEGER) FROM lineitem
  UNION ALL SELECT 'population', CAST(year(ts) AS INTEGER) FROM events)
GROUP BY DATA_SRC, YEAR"""
