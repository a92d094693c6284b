"""The registered queries on the smallest driver tables."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from urbanpulse.llm.catalog import ORACLE_SQL, QUERIES

SF = os.environ.get("UP_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF), con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*cols).collect())) == Counter(want.fetchall())


def test_suffix_dedup_query(spark, texts):
    got = Counter(map(tuple, QUERIES["op1_suffix_dedup"](spark, SF).collect()))
    assert got == Counter(brute.suffix_dedup(texts))


def test_jaccard_query(spark, texts):
    got = Counter(map(tuple, QUERIES["op2_jaccard_join"](spark, SF).collect()))
    assert got == Counter(brute.jaccard(texts))


@pytest.mark.parametrize("name, column", [("op7_toxicity", "toxic"), ("op8_language_id", "lang")])
def test_held_out_accuracy(spark, name, column):
    truth = spark.read.parquet(f"{SF}/{'labels' if column == 'toxic' else 'documents'}.parquet").select("doc_id", column)
    got = QUERIES[name](spark, SF).join(truth, "doc_id").filter("held_out").collect()
    assert got
    guess = "predicted" if column == "toxic" else "lang_pred"
    assert sum(r[guess] == r[column] for r in got) >= 0.96 * len(got)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, seen = docs.count(), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage_table(stage(spark, docs, SF), name)
        assert docs.columns == DOCUMENT_COLUMNS
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[0] >= 0.95 * n and seen[-1] > 0.5 * n
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == seen[-1]
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()


def test_pipeline_on_hostile_documents(spark, hostile, empty):
    for first in (hostile, empty):
        docs = first
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, corpus_pipeline.stage_table(stage(spark, docs, SF), name)
            if name != "packing":
                assert docs.columns == DOCUMENT_COLUMNS and docs.count() <= before.count()
        # every row that reaches packing is there, from its first id to its end mark
        assert docs.filter("piece = 0").count() == before.count()
        assert (docs.count() > 0) == (first is hostile)
    texts = {r["text"] for r in before.select("text").collect()}
    assert None not in texts


def test_rows_whose_hashes_meet_stay_apart(spark, hostile, monkeypatch):
    from urbanpulse.llm import common

    real = common.hash_id
    monkeypatch.setattr(common, "hash_id", lambda *c, salt=0: real(*c, salt=salt) if salt else F.pmod(real(*c), F.lit(2)))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20)), None, None, None) for i in range(9)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows + rows[:2], hostile.schema), SF)
    assert Counter(map(tuple, kept.collect())) == Counter(rows)


def test_stages_judge_rows_of_null_and_repeated_ids(spark, hostile):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    bad = next(t for t in items if t and len(t.split()) >= 20)
    rows = [(None, bad), (1, bad), (1, "clean text under a used id"), (2, None), (2, bad), (None, None), (3, "clean")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], hostile.schema)
    kept = corpus_pipeline.decontamination(spark, docs, SF).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter(x for x in rows if x[1] != bad)

    near = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(4, near), (5, near + " end"), (5, other), (6, other + " end"), (7, near + " a"), (7, near + " b"), (8, ""), (8, ""),
            (8, None), (None, near), (None, near), (9, "x y z"), (9, "x y z"), (9, "p q r")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], hostile.schema)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == DOCUMENT_COLUMNS
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(4, near), (5, other), (8, ""), (8, None), (None, near), (None, near), (9, "x y z"), (9, "p q r")])
