"""DuckDB oracle SQL for the structured-index queries."""

_ORDERS_BY_REGION = """
o AS (
  SELECT o.o_orderkey, n.n_name AS region_code,
         CAST(year(o.o_orderdate) * 10 + quarter(o.o_orderdate) AS INTEGER) AS period,
         o.o_totalprice, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_LINES_BY_ORDER = """
li AS (
  SELECT l_orderkey,
         sum(l_extendedprice / nullif(l_quantity, 0)) AS unit_sum,
         count(l_extendedprice / nullif(l_quantity, 0)) AS unit_n,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS revenue
  FROM lineitem GROUP BY l_orderkey)"""

_IND = """
ind AS (
  SELECT region_code, period,
         sum(unit_sum) / sum(unit_n) AS price,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS rent,
         CAST(sum(revenue) AS DOUBLE) AS sales,
         count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) / count(*) AS youth_share,
         count_if(o_orderpriority = '5-LOW') / count(*) AS senior_share
  FROM o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  GROUP BY region_code, period)"""

WITH_IND = "WITH " + ",".join([_ORDERS_BY_REGION, _LINES_BY_ORDER, _IND])


def _z(c):
    return f"({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0)"


_ZS = ", ".join(f"{_z(c)} AS z_{c}" for c in ["price", "rent", "sales", "youth_share", "senior_share"])
_ZCOLS = ["z_price", "z_rent", "z_sales", "z_youth_share", "z_senior_share"]
_RAW = ("(" + " + ".join(f"coalesce({z}, 0)" for z in _ZCOLS) + ") / nullif("
        + " + ".join(f"CASE WHEN {z} IS NULL THEN 0 ELSE 1 END" for z in _ZCOLS) + ", 0)")

SGI_BODY = f"""z AS (SELECT *, {_ZS} FROM ind),
r AS (SELECT *, {_RAW} AS raw FROM z),
s AS (SELECT *, 100.0 * ((raw - min(raw) OVER ()) / nullif(max(raw) OVER () - min(raw) OVER (), 0)) AS sgi FROM r)"""
SGI_CTES = ",".join([_ORDERS_BY_REGION, _LINES_BY_ORDER, _IND]) + ",\n" + SGI_BODY
SGI_CTE = "WITH " + SGI_CTES

SGI = SGI_CTE + """
SELECT region_code, period, round(price, 4) AS price, rent, sales, youth_share,
       senior_share, round(sgi, 4) AS sgi
FROM s"""

IND_PRICE = WITH_IND + " SELECT region_code, period, round(price, 4) AS price FROM ind"
IND_RENT = WITH_IND + " SELECT region_code, period, rent FROM ind"
IND_SALES = WITH_IND + " SELECT region_code, period, sales FROM ind"
IND_YOUTH = WITH_IND + """
SELECT region_code, period, youth_share,
       CASE WHEN lag(period) OVER (PARTITION BY region_code ORDER BY period) = CASE WHEN period % 10 = 1 THEN period - 7 ELSE period - 1 END
         THEN youth_share - lag(youth_share) OVER (PARTITION BY region_code ORDER BY period) END AS youth_inflow
FROM ind"""
IND_SENIOR = "WITH " + _ORDERS_BY_REGION + """,
s AS (SELECT region_code, period,
        count_if(o_orderpriority = '5-LOW') / count(*) AS senior_share
      FROM o GROUP BY region_code, period)
SELECT region_code, period, senior_share,
       CASE WHEN lag(period) OVER (PARTITION BY region_code ORDER BY period) = CASE WHEN period % 10 = 1 THEN period - 7 ELSE period - 1 END
         THEN -1.0::DOUBLE * (senior_share - lag(senior_share) OVER (PARTITION BY region_code ORDER BY period)) + 0.0::DOUBLE END AS senior_outflow
FROM s"""
