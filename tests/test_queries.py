"""Every registered query against its DuckDB oracle, on the
smallest driver scale; ``UP_TEST_SF`` selects another scale."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from urbanpulse.plans.catalog import ORACLE_SQL, QUERIES
from urbanpulse.plans.tables import TABLES

SF = os.environ.get("UP_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region_code", "period", "price", "rent", "sales", "youth_share", "senior_share", "sgi"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    s = Counter(tuple(_norm(r[c]) for c in order) for r in sdf.collect())
    d = Counter(tuple(_norm(r[dcols.index(c)]) for c in order) for r in res.fetchall())
    assert s == d
