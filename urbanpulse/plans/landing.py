"""Driver-table queries for sources and sinks (S1-S14, U1, U2, A1, L1,
P1/P2/P11, and the four processed jobs).

Landing steps write a table-derived file set to a fresh folder under the
shared checkpoint dir (never a machine-local temp dir), then the query reads
it back through the source under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.numeric import parse_lenient
from ..functions.strings import BOM
from ..operators.sets import union_all
from ..schemas import LAYOUTS, POPULATION_RENAME
from ..session import scratch_path, scratch_table
from ..sources import csv as CSV
from ..sources import json_pages as JP
from ..sources import parquet as PQ
from ..sources import sinks as SK
from ..sources.tables import create_external_table
from . import processed as PR
from . import standins as SI
from .tables import load

ORDERS_LANDED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority", "o_note"]


def _orders_landed(spark, d) -> DataFrame:
    o = load(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                    F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
                    F.col("o_totalprice").cast("string").alias("o_totalprice"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
                    F.concat_ws(", ", "o_orderpriority", "o_orderstatus").alias("o_note"))


def _orders_typed(raw: DataFrame, *keep) -> DataFrame:
    return raw.select(*keep, F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                      F.col("o_custkey").try_cast("bigint").alias("o_custkey"), "o_orderstatus",
                      parse_lenient("o_totalprice").alias("o_totalprice"), "o_orderdate",
                      "o_orderpriority", "o_note")


# ---- S1, S2, S11, F1 -------------------------------------------------------

def csv_landing_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orders_csv")
    SK.write_csv(_orders_landed(spark, d), path)
    raw = CSV.read_layout(spark, path, layout=ORDERS_LANDED, flag_corrupt=True)
    return _orders_typed(raw.withColumn("is_corrupt", F.col(CSV.CORRUPT).isNotNull()), "is_corrupt")


# ---- S3, P12, P13 ----------------------------------------------------------

def csv_subset_by_name(spark, d):
    raw = SI.sales_raw(spark, d)
    shuffled = list(reversed(raw.columns))  # file column order differs from the layout
    path = scratch_path(spark, "sales_csv")
    SK.write_csv(raw.select(*shuffled), path)
    bound = CSV.read_layout(spark, path, layout=LAYOUTS["sales"], flag_corrupt=False)
    return PR.processed_sales(bound)


# ---- S4, S5, U2 ------------------------------------------------------------

def csv_multi_year(spark, d):
    root = scratch_path(spark, "orders_by_year")
    landed = _orders_landed(spark, d).withColumn("orders_year", F.substring("o_orderdate", 1, 4))
    SK.write_csv(landed, root, partition_by=["orders_year"])
    template = root + "/orders_year={year}"
    df, _skipped = CSV.read_years(spark, template, columns=ORDERS_LANDED, year_regex=r"orders_year=(\d{4})")
    return _orders_typed(df, "YEAR")


# ---- S6, X10 ---------------------------------------------------------------

EVENT_ROW = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()), T.StructField("ts_text", T.StringType()),
])
PAGE_SIZE = 1000


def json_pages_inline(spark, d):
    ev = load(spark, d, "events")
    path = scratch_path(spark, "event_pages")
    rows = ev.select("event_id", "user_id", "event_type", "value", "props",
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))
    JP.write_pages(rows, path, "svc", PAGE_SIZE)
    # an exhausted page and an error page, as the API returns them: no rows
    (spark.createDataFrame([('{"svc":{"list_total_count":0,"row":[]}}',),
                            ('{"RESULT":{"CODE":"INFO-200","MESSAGE":"no data"}}',)], "value string")
     .write.mode("append").text(path))
    return JP.read_pages(spark, path, "svc", EVENT_ROW)


# ---- S7, S8, U1 ------------------------------------------------------------

def parquet_multi_union(spark, d):
    s = load(spark, d, "supplier")
    root = scratch_path(spark, "supplier_sets")
    SK.write_parquet(s.where(F.col("s_nationkey") < 12), f"{root}/set_a")
    SK.write_parquet(s.where(~(F.col("s_nationkey") < 12) | F.col("s_nationkey").isNull()), f"{root}/set_b")
    spark.createDataFrame([("not a parquet file",)], "value string").write.mode("overwrite").text(f"{root}/set_c_bad")
    df, _failed = PQ.read_parquet_folders(spark, root=root)
    return df


# ---- S9, S13 ---------------------------------------------------------------

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def external_text_table(spark, d):
    raw_path = scratch_path(spark, "customer_raw")
    SK.write_csv(load(spark, d, "customer").select(*[F.col(c).cast("string") for c in CUSTOMER_COLUMNS]),
                 raw_path, header=False)
    raw = create_external_table(spark, scratch_table(spark, "customer_raw"), raw_path, "csv", CUSTOMER_COLUMNS)
    typed = raw.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                       F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                       parse_lenient("c_acctbal").alias("c_acctbal"), "c_mktsegment")
    out = scratch_path(spark, "customer_processed")
    SK.write_parquet(typed, out)
    return create_external_table(spark, scratch_table(spark, "customer_processed"), out, "parquet")


# ---- S10 -------------------------------------------------------------------

def parquet_sink_roundtrip(spark, d):
    typed = _orders_typed(_orders_landed(spark, d)).withColumn(
        "YEAR", F.substring("o_orderdate", 1, 4).cast("int"))
    path = scratch_path(spark, "orders_processed")
    SK.write_parquet(typed, path, partition_by=["YEAR"])
    # daily reload of one year: replaces that partition only
    SK.write_parquet(typed.where(F.col("YEAR") == 1998), path, partition_by=["YEAR"])
    return spark.read.parquet(path)


# ---- S12 -------------------------------------------------------------------

def region_partitioned_sink(spark, d):
    from .structured import sgi
    idx = sgi(spark, d)
    path = scratch_path(spark, "sgi_by_region")
    SK.write_by_region(idx, path)
    return spark.read.schema(idx.schema).option("header", True).csv(path).select(*idx.columns)


# ---- S14, A1, L1 -----------------------------------------------------------

def profile_table(spark, d):
    return SK.profile(load(spark, d, "customer"))


def sample_rows(spark, d):
    return SK.sample_rows(load(spark, d, "customer"), 10, ["c_custkey"])


# ---- P1, P2, P11 -----------------------------------------------------------

def _dirty_nation_csv(spark, d) -> str:
    n = load(spark, d, "nation")
    dirty = n.select(F.col("n_nationkey").cast("string").alias(BOM + "기준일ID"),
                     F.col("n_name").alias(' "시간대구분" '),
                     F.col("n_name").alias(""),
                     F.col("n_regionkey").cast("string").alias("행정동코드 "),
                     F.concat(F.lit("x"), F.col("n_nationkey").cast("string")).alias("기타"))
    path = scratch_path(spark, "nation_dirty")
    SK.write_csv(dirty, path)
    return path


def header_normalise(spark, d):
    return CSV.read_layout(spark, _dirty_nation_csv(spark, d), flag_corrupt=False)


def rename_map(spark, d):
    return CSV.read_layout(spark, _dirty_nation_csv(spark, d), rename=POPULATION_RENAME, flag_corrupt=False)


# ---- processed jobs (P12-P14, X1-X5) ---------------------------------------

def processed_deals(spark, d):
    return PR.processed_real_estate(SI.deals_raw(spark, d))


def processed_rent(spark, d):
    return PR.processed_rent(SI.rent_raw(spark, d))


def processed_sales(spark, d):
    return PR.processed_sales(SI.sales_raw(spark, d))


def processed_population(spark, d):
    return PR.processed_population(SI.population_raw(spark, d))


def load_counts(spark, d):
    parts = [PR.processed_real_estate(SI.deals_raw(spark, d)), PR.processed_rent(SI.rent_raw(spark, d)),
             PR.processed_sales(SI.sales_raw(spark, d)), PR.processed_population(SI.population_raw(spark, d))]
    return SK.load_counts(union_all([p.select("DATA_SRC", "YEAR") for p in parts]), ["DATA_SRC", "YEAR"])
