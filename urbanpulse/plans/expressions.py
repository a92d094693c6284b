"""Driver-table queries for casts, periods, filters, renames and bands
(SURVEY §7.3 rows P1-P15, F2-F7, X1-X9, A2).  Each reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numeric import parse_lenient, parse_strict
from ..functions.periods import code_quarter, code_year, extract_month, extract_year
from ..functions.strings import BOM, clean_str, join_list
from ..operators import filters as FL
from ..operators import rename as RN
from ..operators.sets import dedup_rows as _dedup
from ..schemas import SALES_RENAME
from .tables import load


def _date_text(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def _as_text(df: DataFrame) -> DataFrame:
    """A table 'as landed text': every column cast to string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# ---- P5, X9 ----------------------------------------------------------------

def string_clean(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part")
    dirty = F.when(F.col("p_size") > 45, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(BOM + "  "), F.col("p_name"), F.lit(" \t")))
    return p.select("p_partkey",
                    clean_str(dirty).alias("name_clean"),
                    join_list(F.array(F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string"))).alias("attrs"))


# ---- P6, P7 ----------------------------------------------------------------

def _price_texts(spark, d) -> DataFrame:
    o = load(spark, d, "orders")
    v = F.pmod(F.col("o_orderkey"), F.lit(8))
    txt = (F.when(v == 0, F.format_number("o_totalprice", 2))
           .when(v == 1, F.concat(F.lit("  "), F.col("o_totalprice").cast("string"), F.lit(" ")))
           .when(v == 2, F.lit("-"))
           .when(v == 3, F.lit("N/A"))
           .when(v == 4, F.concat(F.col("o_totalprice").cast("string"), F.lit("d")))
           .when(v == 5, F.concat(F.lit("+"), F.col("o_totalprice").cast("string")))
           .when(v == 6, F.lit("nan"))
           .otherwise(F.lit("")))
    return o.select("o_orderkey", v.cast("int").alias("variant"), txt.alias("price_text"))


def number_lenient(spark, d):
    return _price_texts(spark, d).select("o_orderkey", "variant", parse_lenient("price_text").alias("price"))


def number_strict(spark, d):
    return _price_texts(spark, d).select("o_orderkey", "variant", parse_strict("price_text").alias("price"))


# ---- P8, P9, P15 -----------------------------------------------------------

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def numeric_by_list(spark, d):
    return RN.numeric_by_list(_as_text(load(spark, d, "lineitem")), LINEITEM_NUMERIC)


# lineitem columns under sales-style Korean headers (two headers are not in
# the rename map: one text, one numeric by its name).
SALES_STYLE_HEADERS = {
    "l_orderkey": "상권_코드",
    "l_suppkey": "서비스_업종_코드",
    "l_returnflag": "상권_구분_코드",
    "l_extendedprice": "당월_매출_금액",
    "l_quantity": "당월_매출_건수",
    "l_discount": "주말_매출_금액",
    "l_tax": "시간대_21~24_매출_금액",
    "l_linestatus": "비고",
    "l_linenumber": "기타_매출",
}


def numeric_by_name(spark, d):
    li = _as_text(load(spark, d, "lineitem"))
    raw = li.select(*[F.col(k).alias(v) for k, v in SALES_STYLE_HEADERS.items()])
    typed = RN.type_columns(raw, RN.is_sales_numeric, strict=True)
    return RN.rename_by_map(typed, SALES_RENAME)


def mini_projection(spark, d):
    return RN.mini_projection(_as_text(load(spark, d, "lineitem")), "real_estate")


# ---- F2-F7 -----------------------------------------------------------------

def filter_any_column(spark, d):
    return FL.any_column_contains(load(spark, d, "part"), "ring")


def _orders_out(o: DataFrame) -> DataFrame:
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    _date_text("o_orderdate").alias("o_orderdate"), "o_orderpriority")


def filter_code_set(spark, d):
    codes = load(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return _orders_out(FL.code_in_set(load(spark, d, "orders"), "o_custkey", codes))


def filter_optional_column(spark, d):
    ev = load(spark, d, "events")
    pop = ev.select(F.date_format("ts", "yyyyMMdd").alias("STDR_DE_ID"),
                    F.lpad(F.hour("ts").cast("string"), 2, "0").alias("TMZON_PD_SE"),
                    F.col("user_id").cast("string").alias("ADSTRD_CODE_SE"),
                    F.col("value").alias("TOT_LVPOP_CO"), "event_id")
    codes = ev.where((F.col("event_type") == "purchase") & (F.col("value") > 250.0)).select("user_id")
    return FL.optional_code_filter(pop, "ADSTRD_CODE_SE", codes)


def _sales_periods(spark, d) -> DataFrame:
    li = load(spark, d, "lineitem")
    code = F.concat(F.year("l_shipdate").cast("string"), F.quarter("l_shipdate").cast("string"))
    return li.select("l_orderkey", "l_linenumber", code.alias("STDR_YYQU_CD")).select(
        "l_orderkey", "l_linenumber", "STDR_YYQU_CD",
        code_year("STDR_YYQU_CD").alias("YEAR"), code_quarter("STDR_YYQU_CD").alias("QUARTER"))


def filter_period(spark, d):
    s = _sales_periods(spark, d).withColumn("period", (F.col("YEAR") * 10 + F.col("QUARTER")).cast("int"))
    return FL.period_between(s, "period", 19962, 19983)


def filter_month_end(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd").alias("STDR_DE_ID"))
    return FL.month_end_snapshot(li, "STDR_DE_ID", years=(1995, 2001))


def _deal_dates(spark, d) -> DataFrame:
    li = load(spark, d, "lineitem")
    n = F.col("l_linenumber")
    txt = (F.when(n == 2, F.date_format("l_shipdate", "yyyy-MM-dd"))
           .when(n == 3, F.date_format("l_shipdate", "yyyy.M.d"))
           .otherwise(F.date_format("l_shipdate", "yyyyMMdd")))
    return li.select("l_orderkey", "l_linenumber", txt.alias("CTRT_DAY")).select(
        "l_orderkey", "l_linenumber", "CTRT_DAY",
        extract_year("CTRT_DAY").alias("YEAR"), extract_month("CTRT_DAY").alias("MONTH"))


def valid_period(spark, d):
    return FL.valid_period(_deal_dates(spark, d), month="MONTH")


# ---- A2 --------------------------------------------------------------------

def dedup_rows(spark, d):
    o = _orders_out(load(spark, d, "orders"))
    return _dedup(o.unionAll(o))


# ---- P3, P4, P10 -----------------------------------------------------------

# Stand-in for living-population band columns: order status gives the
# gender, priority gives the age band (header text in the source's style).
PRIORITY_BANDS = {
    "1-URGENT": "20세부터24세생활인구수",
    "2-HIGH": "25세부터29세생활인구수",
    "3-MEDIUM": "30세부터34세생활인구수",
    "4-NOT SPECIFIED": "65세부터69세생활인구수",
    "5-LOW": "70세이상생활인구수",
}


def _band_headers() -> list[tuple[str, str, str]]:
    out = []
    for gender_kr, status_is_f in (("남자", True), ("여자", False)):
        for pr, band in PRIORITY_BANDS.items():
            out.append((gender_kr + band, pr, "F" if status_is_f else "notF"))
    return out


def population_bands_raw(spark, d) -> DataFrame:
    """Wide, text-typed band table per (code, month-end snapshot)."""
    o = load(spark, d, "orders")
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    is_f = F.col("o_orderstatus") == "F"
    aggs = [F.count(F.lit(1)).cast("double").cast("string").alias("총생활인구수")]
    for header, pr, g in _band_headers():
        cond = (F.col("o_orderpriority") == pr) & (is_f if g == "F" else ~is_f)
        aggs.append(F.count_if(cond).cast("double").cast("string").alias(header))
    return (j.groupBy(F.col("c_nationkey").cast("string").alias("행정동코드"),
                      F.date_format(F.last_day("o_orderdate"), "yyyyMMdd").alias("기준일ID"))
            .agg(*aggs))


def band_rename(spark, d):
    from ..schemas import POPULATION_RENAME
    raw = population_bands_raw(spark, d)
    renamed = RN.rename_bands(RN.rename_by_map(raw, POPULATION_RENAME))
    return RN.type_columns(renamed, RN.is_band_column, strict=True)


def band_unpivot(spark, d):
    return RN.bands_long(band_rename(spark, d), ["ADSTRD_CODE_SE", "STDR_DE_ID"])
