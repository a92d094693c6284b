"""The city indicators (A3-A5, J2) by ``operators.indicators`` on the processed
stand-ins, and month ends (X6).

Region = 'R' || district code modulo 7 (the stand-ins' district is the supplier
of a deal or sale, and the customer of a rent contract).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.periods import month_end_yyyymmdd
from ..operators.filters import valid_period
from ..operators.indicators import align, price, rent, sales, with_period
from . import processed as PR
from . import standins as SI
from .tables import load

REGIONS = 7
RATE = 0.05


def _region(df: DataFrame, code: str) -> DataFrame:
    return df.withColumn("region_code", F.concat(F.lit("R"), F.pmod(F.col(code).try_cast("bigint"), F.lit(REGIONS))))


def city_indicators(spark, d) -> DataFrame:
    """Price, rent (deposits converted at RATE a year) and sales per region and
    quarter, aligned in one long table; a period that one set lacks has no row
    for that indicator."""
    deals = with_period(valid_period(PR.processed_real_estate(SI.deals_raw(spark, d))))
    rents = with_period(valid_period(PR.processed_rent(SI.rent_raw(spark, d))))
    sold = with_period(valid_period(PR.processed_sales(SI.sales_raw(spark, d)), month=None, quarter="QUARTER"), quarter="QUARTER")
    long = align({"price": price(_region(deals, "CGG_CD")), "rent": rent(_region(rents, "CGG_CD"), rate=RATE),
                  "sales": sales(_region(sold, "TRDAR_CD"))})
    return long.select("region_code", "period", "indicator", F.round("value", 3).alias("value"))


def month_ends(spark, d) -> DataFrame:
    """The last day of every month that orders were placed in, as text."""
    months = load(spark, d, "orders").select(F.year("o_orderdate").alias("YEAR"), F.month("o_orderdate").alias("MONTH")).distinct()
    return months.where(F.col("YEAR").isNotNull()).select(
        "YEAR", "MONTH", month_end_yyyymmdd("YEAR", "MONTH").alias("month_end"))


CITY_INDICATORS_SQL = f"""
WITH deal AS (
  SELECT l_suppkey AS code, l_extendedprice AS amt, l_quantity AS area,
    CASE WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y%-m%-d') ELSE strftime(l_shipdate, '%Y%m%d') END AS d
  FROM lineitem),
dm AS (SELECT *, CAST(substr(d, 1, 4) AS INTEGER) AS y,
         CASE WHEN length(d) >= 6 THEN CAST(substr(d, 5, 2) AS INTEGER) END AS m FROM deal),
p AS (SELECT 'R' || (code % {REGIONS}) AS region_code, y * 10 + CAST(ceil(m / 3) AS INTEGER) AS period,
        'price' AS indicator, avg(amt / nullif(area, 0)) AS value
      FROM dm WHERE m BETWEEN 1 AND 12 GROUP BY 1, 2),
r AS (SELECT 'R' || (o_custkey % {REGIONS}) AS region_code, year(o_orderdate) * 10 + quarter(o_orderdate) AS period,
        'rent' AS indicator,
        avg((CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 50 END + o_totalprice * {RATE} / 12.0)
            / CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey % 97 + 20 END) AS value
      FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
s AS (SELECT 'R' || (l_suppkey % {REGIONS}) AS region_code, year(l_shipdate) * 10 + quarter(l_shipdate) AS period,
        'sales' AS indicator, sum(l_extendedprice) AS value
      FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2)
SELECT region_code, CAST(period AS INTEGER) AS period, indicator, round(value, 3) AS value
FROM (SELECT * FROM p UNION ALL SELECT * FROM r UNION ALL SELECT * FROM s) WHERE value IS NOT NULL"""

MONTH_ENDS_SQL = """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS YEAR, CAST(month(o_orderdate) AS INTEGER) AS MONTH,
  strftime(last_day(o_orderdate), '%Y%m%d') AS month_end FROM orders WHERE o_orderdate IS NOT NULL"""
