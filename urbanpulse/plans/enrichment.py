"""Driver-table queries of the enriched layers: weighted crosswalk (P16, J1),
calendar spine (W3, J2), induced lexicon (T2), phrases (T3, W4), drift (T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import text as TX
from ..operators.joins import apportion
from ..operators.normalize import calendar_spine
from .tables import load
from .textual import LEXICON, MONTH_KEYS, _doc_keys, _sales_by_region

# ---- P16, J1 -------------------------------------------------------------------

CODES, REGIONS = 50, 7


def region_apportion(spark, d) -> DataFrame:
    """Sales in cents per quarter, from 50 trade areas to 7 regions that they
    overlap; a third of all sales are in area 0, and one area in 13 is in no
    region."""
    li = load(spark, d, "lineitem")
    area = F.when(F.col("l_suppkey") % 3 == 0, 0).otherwise(F.col("l_suppkey") % CODES).cast("long")
    sold = li.select(area.alias("area"), (F.year("l_shipdate") * 10 + F.quarter("l_shipdate")).alias("period"),
                     (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("long").alias("cents"))
    code = F.col("s_suppkey") % CODES
    shares = load(spark, d, "supplier").filter(code % 13 != 5).select(
        code.alias("code"), F.concat(F.lit("R"), F.col("s_nationkey") % REGIONS).alias("region_code"),
        (F.col("s_suppkey") % 9 + 1).alias("weight"))
    return apportion(sold, shares, "area", ["period"], "cents")


# ---- W3, J2 --------------------------------------------------------------------

def calendar_spine_query(spark, d) -> DataFrame:
    """Sales per region and quarter with one quarter in five taken away: all
    quarters, the missing ones marked and carried forward."""
    sales = _sales_by_region(spark, d)
    q = F.floor(F.col("period") / 10) * 4 + F.col("period") % 10 + F.length("region_code")
    left = sales.filter(q % 5 != 0).withColumn("carried", F.col("sales"))
    spine = calendar_spine(left, ["region_code"], "period", ["sales"])
    carried = calendar_spine(left, ["region_code"], "period", ["carried"], carry=True).drop("is_missing")
    return spine.join(carried, ["region_code", "period"])


# ---- T2 ------------------------------------------------------------------------

SEEDS = {"the": 1.0, "der": 0.5, "el": 0.25, "of": -1.0, "die": -0.5, "de": -0.25}
NEGATORS = ("and", "und", "y")
ROUNDS, MIN_LINKS, LEAST = 2, 20, 0.05


def _lexicon(spark, d) -> DataFrame:
    docs = load(spark, d, "documents").select("text")
    return TX.induced_lexicon(docs, "text", TX.lexicon_table(spark, SEEDS), ROUNDS, MIN_LINKS, LEAST)


def lexicon_induced(spark, d) -> DataFrame:
    """The lexicon that the seeds induce over all documents."""
    return _lexicon(spark, d)


def sentiment_induced(spark, d) -> DataFrame:
    """Monthly sentiment by the induced lexicon, with negators."""
    docs = _doc_keys(load(spark, d, "documents").select("doc_id", "source", "text"))
    scores = TX.lexicon_scores(docs, "text", _lexicon(spark, d).select("tok", "weight"), MONTH_KEYS, NEGATORS, 2)
    return TX.sentiment_rates(scores).withColumns({c: F.round(c, 9) for c in ("sentiment", "hit_rate")})


# ---- T3, W4 --------------------------------------------------------------------

PHRASES = 3


def phrases_region_month(spark, d) -> DataFrame:
    """Top phrases per region and month."""
    docs = _doc_keys(load(spark, d, "documents").select("doc_id", "source", "text"))
    top = TX.phrase_top_k(docs, MONTH_KEYS, "text", k=PHRASES)
    return top.select(*MONTH_KEYS, "rank", "phrase", "tf", F.round("llr", 4).alias("llr"), F.round("score", 4).alias("score"))


# ---- T5 ------------------------------------------------------------------------

def embedding_drift(spark, d) -> DataFrame:
    """Drift of each region's centroid from month to month."""
    keys = _doc_keys(load(spark, d, "documents").select("doc_id", "source")).select("doc_id", *MONTH_KEYS)
    vectors = load(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    out = TX.centroid_drift(vectors.join(keys, "doc_id"), "region_code", "embedding")
    return out.withColumn("drift", F.round("drift", 6))
