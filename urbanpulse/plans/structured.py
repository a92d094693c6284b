"""Structured index (SGI) on the driver tables.

Stand-in mapping (region = nation name, period = YEAR*10+QUARTER of the order
date):

=============  ==============================================
price          avg(l_extendedprice / l_quantity)
rent           avg(o_totalprice)
sales          sum(l_extendedprice * (1 - l_discount))
youth share    share of orders with priority 1-URGENT / 2-HIGH
senior share   share of orders with priority 5-LOW
=============  ==============================================

Plan shape: lineitem is aggregated per order (its exchange on l_orderkey is
reused by the join to orders), orders get their region through customer
and the nation table (Spark broadcasts either by its size).  One grouped
aggregate then yields all five indicators; everything after it works on
(#regions x #periods) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.periods import period_key
from ..operators.index import composite_index
from ..operators.indicators import to_long
from ..operators.normalize import period_change
from ..session import materialize
from .tables import load

YOUTH_PRIORITIES = ("1-URGENT", "2-HIGH")
SENIOR_PRIORITY = "5-LOW"
SGI_INDICATORS = ["price", "rent", "sales", "youth_share", "senior_share"]


def orders_by_region(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        period_key(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("period"))
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("region_code"))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "region_code", "period", "o_totalprice", "o_orderpriority"))


def lines_by_order(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem")
    unit = F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(unit).alias("unit_sum"), F.count(unit).alias("unit_n"),
        F.sum(money("l_extendedprice") * (F.lit(1) - money("l_discount"))).alias("revenue"))


def money(c) -> "F.Column":
    """Two-decimal money amount as an exact decimal (sums do not depend on
    summation order, so results are reproducible across engines and retries)."""
    return F.col(c).cast("decimal(18,2)")


def indicators_wide(spark: SparkSession, d: str) -> DataFrame:
    """(region_code, period, price, rent, sales, youth_share, senior_share)."""
    o = orders_by_region(spark, d)
    li = lines_by_order(spark, d)
    pr = F.col("o_orderpriority")
    n_orders = F.count(F.lit(1))
    return (o.join(li, "o_orderkey", "left")
            .groupBy("region_code", "period")
            .agg((F.sum("unit_sum") / F.sum("unit_n")).alias("price"),
                 (F.sum(money("o_totalprice")).cast("double") / F.count("o_totalprice")).alias("rent"),
                 F.sum("revenue").cast("double").alias("sales"),
                 (F.count_if(pr.isin(*YOUTH_PRIORITIES)) / n_orders).alias("youth_share"),
                 (F.count_if(pr == SENIOR_PRIORITY) / n_orders).alias("senior_share")))


def sgi_frame(spark: SparkSession, d: str, scope: str = "all") -> DataFrame:
    """Unrounded SGI with its five indicators per (region_code, period)."""
    # (#regions x #periods) rows: computed once, then read by every statistic.
    wide = materialize(indicators_wide(spark, d))
    return composite_index(to_long(wide, SGI_INDICATORS), SGI_INDICATORS, "sgi", scope=scope)


def sgi(spark: SparkSession, d: str, scope: str = "all") -> DataFrame:
    idx = sgi_frame(spark, d, scope)
    return idx.select("region_code", "period", F.round("price", 4).alias("price"),
                      "rent", "sales", "youth_share", "senior_share",
                      F.round("sgi", 4).alias("sgi"))


# ---- single indicators (A3-A7) -------------------------------------------

def ind_price(spark, d):
    return indicators_wide(spark, d).select("region_code", "period", F.round("price", 4).alias("price"))


def ind_rent(spark, d):
    return indicators_wide(spark, d).select("region_code", "period", "rent")


def ind_sales(spark, d):
    return indicators_wide(spark, d).select("region_code", "period", "sales")


def ind_youth_inflow(spark, d):
    w = indicators_wide(spark, d).select("region_code", "period", "youth_share")
    out = period_change(w, "youth_share", ["region_code"], "period", out="youth_inflow")
    return out.select("region_code", "period", "youth_share", "youth_inflow")


def ind_senior_outflow(spark, d):
    pr = F.col("o_orderpriority")
    share = (orders_by_region(spark, d).groupBy("region_code", "period")
             .agg((F.count_if(pr == SENIOR_PRIORITY) / F.count(F.lit(1))).alias("senior_share")))
    out = period_change(share, "senior_share", ["region_code"], "period", out="senior_outflow", sign=-1.0)
    return out.select("region_code", "period", "senior_share",
                      (F.col("senior_outflow") + F.lit(0.0)).alias("senior_outflow"))
