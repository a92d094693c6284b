"""Unstructured layer on the driver tables (T1-T6, A8, W4) and the final
indices: UGI, GPI = SGI + UGI (J3, G2); plus the crosswalk (J1/P16) and the
stand-alone normalisation windows (W1-W3).

Documents carry no date or district, so (SURVEY §7.4): region =
'NATION_' || substring(source, 4), year = 1995 + (doc_id div 12) % 6,
month = doc_id % 12 + 1; a document's vector is the embedding with
vec_id = doc_id (left join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.periods import period_key, quarter_of_month
from ..functions.text import strip_tags
from ..operators import text as TX
from ..operators.index import composite_index, gpi
from ..operators.indicators import to_long
from ..operators.joins import crosswalk
from ..operators.normalize import minmax_100, period_change, zscore
from ..session import materialize, stage_table
from .structured import indicators_wide, sgi_frame
from .tables import load

# Sentiment lexicon (ours; weights are multiples of 1/4, so sums are exact).
LEXICON = {
    "the": 0.25, "and": 0.5, "is": 0.75, "of": -0.25, "to": -0.5, "that": -0.75,
    "le": 0.25, "la": -0.25, "der": 0.5, "die": -0.5, "el": 0.25, "de": -0.25,
}
MIN_CHARS = 20
MONTH_KEYS = ["region_code", "YEAR", "MONTH"]
UGI_FEATURES = ["sentiment", "hit_rate", "n_docs", "cosine"]


def _doc_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "region_code": F.concat(F.lit("NATION_"), F.substring("source", 4, 1 << 20)),
        "YEAR": (F.lit(1995) + F.pmod(F.floor(F.col("doc_id") / 12), F.lit(6))).cast("int"),
        "MONTH": (F.pmod(F.col("doc_id"), F.lit(12)) + 1).cast("int"),
    })


# ---- T1, F8 ----------------------------------------------------------------

def text_clean_filter(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select(F.lit("doc").alias("src"), F.col("doc_id").alias("id"), "text")
    pages = load(spark, d, "pages").select(F.lit("page").alias("src"), F.col("page_id").alias("id"),
                                           strip_tags("html").alias("text"))
    u = docs.unionByName(pages).withColumn(
        "uid", F.col("id") * 2 + F.when(F.col("src") == "page", 1).otherwise(0))
    # Silver is a stored layer: the regex cleaning runs once into a Parquet
    # table in the shared folder; the length filter and the duplicate groups
    # read the stored column (the dedup branch reads only uid and clean).
    silver = stage_table(TX.with_clean(u, "text").select("src", "id", "uid", "clean"), "silver_texts")
    kept = TX.drop_exact_duplicates(TX.keep_long(silver, MIN_CHARS), "clean", "uid")
    return kept.select("src", "id", F.length("clean").cast("bigint").alias("n_chars"), F.md5("clean").alias("text_md5"))


# ---- T2, A8 ----------------------------------------------------------------

def sentiment_monthly(spark, d):
    docs = _doc_keys(load(spark, d, "documents").select("doc_id", "source", "text"))
    return TX.sentiment_rates(TX.lexicon_scores(docs, "text", TX.lexicon_table(spark, LEXICON), MONTH_KEYS))


# ---- T3, W4 ----------------------------------------------------------------

def keywords_tfidf(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    top = TX.tfidf_top_k(docs, "doc_id", "text", k=3)
    return top.select("doc_id", "rank", "tok", "tf", F.round("score", 4).alias("score"))


def keywords_region_month(spark, d):
    """Top keywords per region and month."""
    docs = _doc_keys(load(spark, d, "documents").select("doc_id", "source", "text"))
    top = TX.tfidf_top_k(docs, MONTH_KEYS, "text", k=3)
    return top.select(*MONTH_KEYS, "rank", "tok", "tf", F.round("score", 4).alias("score"))


# ---- T4 --------------------------------------------------------------------

TOPICS, TOPIC_PASSES = 5, 3
SHARE_PASSES = 3


def topics(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return TX.topics(docs, "doc_id", "text", k=TOPICS, passes=TOPIC_PASSES)


def topic_shares(spark, d):
    """T4, mixed membership: shares of topics per document."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    return TX.topic_shares(docs, "doc_id", "text", k=TOPICS, passes=SHARE_PASSES, seed_passes=TOPIC_PASSES)


# ---- T5 --------------------------------------------------------------------

def embedding_centroid_cosine(spark, d):
    e = load(spark, d, "embeddings")
    return TX.centroid_cosine(e, "label", "embedding").select(
        "vec_id", "label", F.round("cosine", 6).alias("cosine"))


# ---- T6 (UGI), J3 + G2 (GPI) -----------------------------------------------

def ugi_features(spark, d) -> DataFrame:
    """Monthly text features per (region_code, YEAR, MONTH)."""
    docs = _doc_keys(load(spark, d, "documents").select("doc_id", "source", "text"))
    scores = TX.sentiment_rates(TX.lexicon_scores(docs, "text", TX.lexicon_table(spark, LEXICON), MONTH_KEYS))
    cos = TX.centroid_cosine(load(spark, d, "embeddings"), "label", "embedding").select(
        F.col("vec_id").alias("doc_id"), "cosine")
    near = docs.drop("text").join(cos, "doc_id").groupBy(*MONTH_KEYS).agg(F.avg("cosine").alias("cosine"))
    return (scores.join(near, MONTH_KEYS, "left")
            .select(*MONTH_KEYS, "sentiment", "hit_rate", F.col("n_docs").cast("double").alias("n_docs"), "cosine"))


def ugi_frame(spark, d) -> DataFrame:
    """UGI (0..100) per region and month."""
    wide = materialize(ugi_features(spark, d))
    return composite_index(to_long(wide, UGI_FEATURES, keys=MONTH_KEYS), UGI_FEATURES, "ugi", keys=MONTH_KEYS)


def ugi_index(spark, d):
    return ugi_frame(spark, d).select(*MONTH_KEYS, "sentiment", "hit_rate", "n_docs",
                                      F.round("cosine", 6).alias("cosine"), F.round("ugi", 4).alias("ugi"))


def ugi_quarterly(ugi_monthly: DataFrame) -> DataFrame:
    """Monthly UGI averaged up to (region_code, period) for the GPI."""
    return (ugi_monthly.withColumn("period", period_key(F.col("YEAR"), quarter_of_month("MONTH")))
            .groupBy("region_code", "period").agg(F.avg("ugi").alias("ugi")))


def gpi_index(spark, d):
    g = gpi(sgi_frame(spark, d), ugi_quarterly(ugi_frame(spark, d)))
    return g.select("region_code", "period", F.round("sgi", 4).alias("sgi"),
                    F.round("ugi", 4).alias("ugi"), F.round("gpi", 4).alias("gpi"))


# ---- P16, J1 ---------------------------------------------------------------

def region_map(spark, d) -> DataFrame:
    """(source, code, region_code) crosswalk: nation code -> region name."""
    n = load(spark, d, "nation")
    r = load(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lit("customer").alias("source"), F.col("n_nationkey").cast("string").alias("code"),
        F.col("r_name").alias("region_code"))


def region_standardise(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    return crosswalk(c, region_map(spark, d), "customer", "c_nationkey").select(
        "c_custkey", "c_nationkey", "region_code")


# ---- W1, W2, W3 ------------------------------------------------------------

def _sales_by_region(spark, d) -> DataFrame:
    return materialize(indicators_wide(spark, d).select("region_code", "period", "sales"))


def zscore_query(spark, d):
    z = zscore(_sales_by_region(spark, d), "sales", out="z")
    return z.select("region_code", "period", "sales", F.round("z", 6).alias("z"))


def minmax_query(spark, d):
    m = minmax_100(_sales_by_region(spark, d), "sales", out="score", by=["period"])
    return m.select("region_code", "period", "sales", F.round("score", 6).alias("score"))


def period_change_query(spark, d):
    c = period_change(_sales_by_region(spark, d), "sales", ["region_code"], "period", out="change")
    return c.select("region_code", "period", "sales", "change")
