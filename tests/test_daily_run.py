"""G3 integration: all steps from hand-made raw folders (FIXTURES part A)
into a fresh folder; check every output's schema and row counts."""

import csv
import io
import os

from pyspark.sql import functions as F

from conftest import rows
from urbanpulse.plans.daily_run import run_all
from urbanpulse.schemas import (POPULATION_RENAME, REAL_ESTATE_API_COLUMNS, REAL_ESTATE_COLUMNS,
                                REAL_ESTATE_RENAME, RENT_COLUMNS, RENT_RENAME, SALES_RENAME)


def _write(path, lines, bom=False, quote_all=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.StringIO()
    csv.writer(buf, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL, lineterminator="\n").writerows(lines)
    with open(path, "w", encoding="utf-8") as f:
        f.write(("﻿" if bom else "") + buf.getvalue())


def _raw(root):
    inv_re = {v: k for k, v in REAL_ESTATE_RENAME.items()}
    deals = []
    for i, (dong, day, amt, area) in enumerate([("D1", "20240115", "100,000", "50"), ("D1", "20240420", "120000", "60"),
                                                 ("D2", "2024-02-03", "80000", "40"), ("D2", "20240505", "90000", "0"),
                                                 ("D9", "20240101", "1", "1")]):
        v = dict.fromkeys(REAL_ESTATE_COLUMNS, "")
        v.update(STDG_CD=dong, CGG_CD="G", MNO=str(i), CTRT_DAY=day, THING_AMT=amt, ARCH_AREA=area)
        deals.append([v[c] for c in REAL_ESTATE_COLUMNS])
    _write(f"{root}/real_estate/real_estate_2024.csv", [[inv_re[c] for c in REAL_ESTATE_COLUMNS]] + deals, bom=True)
    api = dict.fromkeys(REAL_ESTATE_API_COLUMNS, "")
    api.update(STDG_CD="D1", CTRT_DAY="20240610", THING_AMT="110000", ARCH_AREA="55", BLDG_USG="아파트")
    _write(f"{root}/api/real_estate/real_estate_2024.csv", [[api[c] for c in REAL_ESTATE_API_COLUMNS]], quote_all=True)

    inv_rent = {v: k for k, v in RENT_RENAME.items()}
    rents = []
    for dong, day, dep, mon, area in [("D1", "2024.01.10", "10000", "50", "30"), ("D2", "20240410", "20000", "0", "40"),
                                      ("D2", "20240111", "5000", "100", "")]:
        v = dict.fromkeys(RENT_COLUMNS, "")
        v.update(STDG_CD=dong, CTRT_DAY=day, GRFE=dep, RTFE=mon, RENT_AREA=area)
        rents.append([v[c] for c in RENT_COLUMNS])
    _write(f"{root}/rent/rent_2024.csv", [[inv_rent[c] for c in RENT_COLUMNS]] + rents)

    inv_s = {v: k for k, v in SALES_RENAME.items()}
    sh = [inv_s[c] for c in ["STDR_YYQU_CD", "TRDAR_CD", "TRDAR_CD_NM", "SVC_INDUTY_CD", "SVC_INDUTY_CD_NM",
                             "THSMON_SELNG_AMT", "WKEND_SELNG_AMT"]]
    _write(f"{root}/sales/sales_2024.csv", [sh, ["20241", "T1", "a", "CS1", "x", "1,000", "10"],
                                            ["20242", "T1", "a", "CS1", "x", "2000", "N/A"],
                                            ["20241", "T2", "b", "CS1", "x", "500", "5"]])
    inv_p = {v: k for k, v in POPULATION_RENAME.items()}
    ph = [inv_p[c] for c in ["STDR_DE_ID", "TMZON_PD_SE", "ADSTRD_CODE_SE", "TOT_LVPOP_CO"]] + [
        "남자20세부터24세생활인구수", "여자65세부터69세생활인구수", "남자70세이상생활인구수"]
    _write(f"{root}/population/population_2024.csv",
           [ph, ["20240131", "00", "A1", "100", "20", "10", "5"], ["20240430", "00", "A1", "100", "30", "8", "4"],
            ["20240131", "00", "A2", "50", "5", "10", "10"], ["20240430", "00", "A2", "50", "6", "9", "9"]], bom=True)


def test_run_all(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _raw(raw)
    region_map = spark.createDataFrame(
        [("real_estate", "G-D1", "R1"), ("real_estate", "-D1", "R1"), ("real_estate", "G-D2", "R2"),
         ("rent", "-D1", "R1"), ("rent", "-D2", "R2"),
         ("sales", "T1", "R1"), ("sales", "T2", "R2"), ("population", "A1", "R1"), ("population", "A2", "R2")],
        "source string, code string, region_code string")
    texts = spark.createDataFrame(
        [(1, "R1", 2024, 1, "the good news and the town", [1.0, 0.0], 0),
         (2, "R1", 2024, 4, "the good news and the town", [0.0, 1.0], 0),   # exact copy: dropped
         (3, "R2", 2024, 2, "a bad day for the old market", [1.0, 1.0], 1),
         (4, "R2", 2024, 5, "tiny", [1.0, 1.0], 1)],                       # too short: dropped
        "doc_id long, region_code string, YEAR int, MONTH int, text string, embedding array<float>, label int")
    outs = run_all(spark, raw, out, region_map, texts, {"good": 1.0, "bad": -1.0}, register_tables=True)

    deals = spark.read.parquet(outs["processed/real_estate"])
    assert deals.count() == 6 and set(deals.columns) >= {"CGG_CD", "STDG_CD", "YEAR", "MONTH", "THING_AMT", "DATA_SRC"}
    assert spark.table("processed_rent").count() == 3
    raw_tbl = spark.table("real_estate_raw")                      # S9 over the API layout folder
    assert raw_tbl.columns == REAL_ESTATE_API_COLUMNS and raw_tbl.count() == 1
    ages = {(r[0], r[1]): (r[2], r[3]) for r in rows(spark.read.parquet(outs["processed/population_ages"]), "ADSTRD_CODE_SE", "STDR_DE_ID", "young", "old")}
    assert ages == {("A1", "20240131"): (20.0, 15.0), ("A1", "20240430"): (30.0, 12.0), ("A2", "20240131"): (5.0, 20.0), ("A2", "20240430"): (6.0, 18.0)}
    counts = {(r[0], r[1]): r[2] for r in spark.read.option("header", True).option("inferSchema", True)
              .csv(outs["load_counts"]).collect()}
    assert counts[("real_estate", 2024)] == 6 and counts[("sales", 2024)] == 3

    sgi = spark.read.option("header", True).option("inferSchema", True).csv(outs["sgi"])
    assert {r["region_code"] for r in sgi.collect()} == {"R1", "R2"}
    assert set(sgi.columns) >= {"period", "price", "rent", "sales", "youth_inflow", "senior_outflow", "sgi"}
    vals = [r["sgi"] for r in sgi.collect() if r["sgi"] is not None]
    assert min(vals) == 0.0 and max(vals) == 100.0
    assert sorted(os.listdir(outs["sgi"].replace("file:", ""))) [-2:] == ["region_code=R1", "region_code=R2"]

    silver = spark.read.parquet(outs["silver"])
    assert sorted(r[0] for r in silver.select("doc_id").collect()) == [1, 3]
    assert spark.read.parquet(outs["keywords"]).select("region_code").distinct().count() == 2
    assert spark.read.parquet(outs["topics"]).count() == 2
    gpi = spark.read.option("header", True).option("inferSchema", True).csv(outs["gpi"])
    assert gpi.where(F.col("gpi").isNotNull()).count() >= 1


def test_run_all_stops_on_empty_set(spark, tmp_path):
    import pytest
    from urbanpulse.plans.daily_run import LoadCheckError
    raw, out = str(tmp_path / "raw_empty"), str(tmp_path / "out")
    inv_re = {v: k for k, v in REAL_ESTATE_RENAME.items()}
    _write(f"{raw}/real_estate/real_estate_2024.csv", [[inv_re[c] for c in REAL_ESTATE_COLUMNS]])  # header only
    empty_map = spark.createDataFrame([], "source string, code string, region_code string")
    with pytest.raises(LoadCheckError):
        run_all(spark, raw, out, empty_map)


def test_capped_periods(spark):
    from urbanpulse.sources.sinks import capped_periods
    c = spark.createDataFrame([("sales", 2023, 20000), ("sales", 2024, 1234)], "DATA_SRC string, YEAR int, n_rows long")
    assert [tuple(r) for r in capped_periods(c, 20000).collect()] == [("sales", 2023, 20000)]


def test_a_sale_in_both_layouts_counts_once(spark, tmp_path):
    from urbanpulse.plans.daily_run import read_collected, read_raw
    from urbanpulse.schemas import SALES_API_COLUMNS
    raw = str(tmp_path / "raw")
    _raw(raw)
    landed = [dict.fromkeys(SALES_API_COLUMNS, "") | {"STDR_YYQU_CD": q, "TRDAR_CD": "T1", "THSMON_SELNG_AMT": a}
              for q, a in (("20241", "1000"), ("20243", "7"), ("20243", "7"))]
    _write(f"{raw}/api/sales/sales.csv", [[r[c] for c in SALES_API_COLUMNS] for r in landed], quote_all=True)
    got = sorted((r["STDR_YYQU_CD"], float(r["THSMON_SELNG_AMT"])) for r in read_raw(spark, raw, "sales").collect())
    assert got == [("20241", 500.0), ("20241", 1000.0), ("20242", 2000.0), ("20243", 7.0)]
    assert read_collected(spark, raw, "sales").count() == 2


def test_cli_entry_point(spark, tmp_path):
    from urbanpulse.plans.daily_run import main
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _raw(raw)
    with open(tmp_path / "map.csv", "w") as f:
        f.write("source,code,region_code\nreal_estate,G-D1,R1\nrent,-D2,R2\nsales,T1,R1\npopulation,A1,R1\n")
    outs = main(["--raw", raw, "--out", out, "--region-map", str(tmp_path / "map.csv"), "--profile", "local"])
    assert {"processed/real_estate", "sgi", "load_counts"} <= set(outs)
    sgi = spark.read.option("header", True).csv(outs["sgi"])
    assert sgi.count() >= 1


def test_run_all_on_driver_standins(spark, tmp_path):
    """Raw CSV folders landed from the driver tables (sf0.001) through the
    whole daily run: processed counts equal the sources, SGI spans 0..100."""
    import pytest
    from pyspark.sql import functions as F
    from urbanpulse.plans import standins as SI
    from urbanpulse.plans.tables import load
    from urbanpulse.sources import sinks as SK
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name, df, rename in [("real_estate", SI.deals_raw(spark, sf), REAL_ESTATE_RENAME),
                             ("rent", SI.rent_raw(spark, sf), RENT_RENAME)]:
        inv = {v: k for k, v in rename.items()}
        SK.write_csv(df.select(*[F.col(c).alias(inv.get(c, c)) for c in df.columns]), f"{raw}/{name}")
    # crosswalk: deals by supplier and part key, rent by customer and order key
    region_map = (load(spark, sf, "lineitem").select(
                      F.lit("real_estate").alias("source"), F.concat_ws("-", "l_suppkey", "l_partkey").alias("code"),
                      F.concat(F.lit("R"), (F.col("l_partkey") % 5).cast("string")).alias("region_code")).distinct()
                  .unionByName(load(spark, sf, "orders").select(
                      F.lit("rent").alias("source"), F.concat_ws("-", "o_custkey", "o_orderkey").alias("code"),
                      F.concat(F.lit("R"), (F.col("o_orderkey") % 5).cast("string")).alias("region_code"))))
    outs = run_all(spark, raw, out, region_map)
    assert spark.read.parquet(outs["processed/real_estate"]).count() == load(spark, sf, "lineitem").count()
    assert spark.read.parquet(outs["processed/rent"]).count() == load(spark, sf, "orders").count()
    sgi = spark.read.option("header", True).option("inferSchema", True).csv(outs["sgi"])
    vals = [r["sgi"] for r in sgi.collect() if r["sgi"] is not None]
    assert sgi.select("region_code").distinct().count() == 5
    assert min(vals) == 0.0 and max(vals) == 100.0


def test_files_and_pages_are_read_once(spark, tmp_path, monkeypatch):
    """One scan for a set's file heads and one parse of its pages, whatever reads
    them: the rows, the accounting and the rejects."""
    import json
    from urbanpulse.plans import daily_run as DR
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _raw(raw)
    os.makedirs(f"{raw}/pages/real_estate/period=2025")
    row = dict.fromkeys(REAL_ESTATE_API_COLUMNS, "") | {"STDG_CD": "D1", "CGG_CD": "G", "RCPT_YR": "2025", "CTRT_DAY": "20250610",
                                                        "THING_AMT": "7", "ARCH_AREA": "1"}
    page = json.dumps({DR.SERVICES["real_estate"]: {"list_total_count": 2, "row": [row, row]}})
    with open(f"{raw}/pages/real_estate/period=2025/1_1000.json", "w") as f:
        f.write(page + "\n" + page[:40] + "\n")
    read, calls = (DR.CSV.file_heads, DR.PG.read_page_log), []
    monkeypatch.setattr(DR.CSV, "file_heads", lambda s, paths: calls.append(paths[0].rsplit("/", 1)[-1]) or read[0](s, paths))
    monkeypatch.setattr(DR.PG, "read_page_log", lambda *a, **k: calls.append("pages") or read[1](*a, **k))
    codes = spark.createDataFrame([("real_estate", "G-D1", "R1")], "source string, code string, region_code string")
    outs = run_all(spark, raw, out, codes)
    assert sorted(calls) == ["pages", "population", "real_estate", "rent", "sales"]
    deals = spark.read.parquet(outs["processed/real_estate"])
    assert deals.where("YEAR = 2025").count() == 1  # the same row twice counts once
    pages = rows(spark.read.option("header", True).csv(outs["load_pages"]), "period", "announced", "n_pages", "n_malformed")
    assert pages == [("2025", "2", "2", "1")]
    assert rows(spark.read.parquet(outs["load_rejects"]).where("reason = 'malformed_page'"), "first_field", "raw") == [("2025", page[:40])]


def test_number_text_keeps_both_rules(spark):
    """Numbers that need no trimming take the short way, with the result of the
    long one; the text of a strict number reads as the same number."""
    from urbanpulse.functions import numeric as N
    from urbanpulse.functions.strings import clean_str, strip_ws
    from urbanpulse.plans.daily_run import _number_text
    texts = ["1", "1,234.50", "-1,2", "+5", " 7 ", "7\n", "﻿8", "1,,2,", ",1", "1.", ".5", "1.5,0", "-", "", None, "N/A", "1e3", "1d", "0x1p3",
             "NaN", "Infinity", "9" * 300, "9" * 310, "-" + "9" * 400, "1 2", "１２", "　 3,0", "- 1", "--1", "1.2.3", "0012.50", "-0"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    s = F.replace(clean_str("t"), F.lit(","), F.lit(""))
    strict = F.when(s.rlike(N.STRICT_NUMBER), s.try_cast("double"))
    z = strip_ws(F.replace("t", F.lit(","), F.lit("")))
    lenient = lambda z: F.when(z.rlike(N.LENIENT_NUMBER), z.try_cast("double"))
    out = df.select("t", N.parse_strict("t").alias("a"), strict.alias("b"), N.parse_lenient("t").alias("c"), lenient(z).alias("d"),
                    _number_text(F.col("t")).alias("x"), strict.cast("string").alias("y"))
    out = out.withColumns({"e": N.parse_lenient("x"), "f": N.parse_lenient("y")})
    got = rows(out, "t", "a", "b", "c", "d", "e", "f")
    assert [r for r in got if not (str(r[1]) == str(r[2]) and str(r[3]) == str(r[4]) and str(r[5]) == str(r[6]))] == []
