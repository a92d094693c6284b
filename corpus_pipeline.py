"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes
every stage's result as Parquet into the shared checkpoint folder and reads it
again, so that a lost executor never repeats an earlier stage.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanpulse.llm.common import settled_id, table
from urbanpulse.llm.decontaminate import decontaminate
from urbanpulse.llm.jaccard import jaccard_components
from urbanpulse.llm.langid import drop_rejected, fit_languages, training_rows
from urbanpulse.llm.packing import pack_documents
from urbanpulse.llm.suffixdedup import remove_repeats
from urbanpulse.session import stage_table


#: Bytes of a batch of rows on its way to a Python worker (Spark's own default is
#: 64 MB; a batch stands in the JVM, in the worker and once more as its result).
TEXT_BATCH = 8 << 20


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that nearest-centroid language ID doesn't reject.  Null texts
    and texts without a letter go."""
    _small_batches(spark)
    return drop_rejected(docs, fit_languages(training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest
    doc_id; of equal rows one.  Rows with a null doc_id stay.  Rows that share a
    doc_id are judged by their own text, and of those in one component one stays."""
    _small_batches(spark)
    # rows of one id and one text share their fate: a number of both stands for them
    keyed = docs.filter(F.col("doc_id").isNotNull())
    keyed = keyed.withColumn("__row", settled_id(keyed, "doc_id", "text"))
    found = jaccard_components(keyed.select(F.col("__row").alias("doc_id"), "text")).distinct()
    first = F.min(F.struct("doc_id", "__row"))["__row"].alias("__row")
    kept = (keyed.select("__row", "doc_id").distinct()
            .join(found.select(F.col("doc_id").alias("__row"), "component_id"), "__row").groupBy("component_id").agg(first))
    named = keyed.join(kept, "__row", "left_semi").dropDuplicates(["__row"])
    return named.select(docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that an earlier document has;
    n_chars is counted anew.  Documents that consisted of such strings go."""
    _small_batches(spark)
    found = remove_repeats(docs).filter("n_bytes = 0 or n_removed < n_bytes")
    own = {"text": F.col("kept").alias("text"), "n_chars": F.char_length("kept").cast("long").alias("n_chars")}
    return found.select(*[own.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark.  Each row is judged
    by its own text, whatever other rows have its doc_id or if it has none."""
    # the judgement depends on the text alone: its digest stands for the row
    keyed = docs.withColumn("__text", F.sha2("text", 256))
    found = decontaminate(keyed.select(F.col("__text").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias("__text")).distinct()
    return keyed.join(bad, "__text", "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 1024 tokens."""
    _small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language models, tokenizers and hashes are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
