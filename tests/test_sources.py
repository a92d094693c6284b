"""Sources and sinks on hand-made fixtures (FIXTURES part A)."""

import csv
import io
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from urbanpulse.operators import rename as RN
from urbanpulse.operators.filters import month_end_snapshot
from urbanpulse.plans.processed import processed_real_estate, processed_sales
from urbanpulse.schemas import (POPULATION_RENAME, REAL_ESTATE_API_COLUMNS, REAL_ESTATE_COLUMNS,
                                REAL_ESTATE_RENAME, SALES_RENAME)
from urbanpulse.sources import csv as CSV
from urbanpulse.sources import json_pages as JP
from urbanpulse.sources import parquet as PQ
from urbanpulse.sources import sinks as SK
from urbanpulse.sources.tables import create_external_table


def _write(path, lines, bom=False, quote_all=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.StringIO()
    w = csv.writer(buf, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL, lineterminator="\n")
    for line in lines:
        w.writerow(line)
    with open(path, "w", encoding="utf-8") as f:
        f.write(("﻿" if bom else "") + buf.getvalue())


def _deal(mno, ctrt_day="20240315", amt="125000", area="84.9", land="33.1", bldg="APT", rtrcn=""):
    vals = dict.fromkeys(REAL_ESTATE_COLUMNS, "")
    vals.update(RCPT_YR="2024", CGG_CD="11200", STDG_CD="11200118", MNO=mno, BLDG_NM=bldg,
                CTRT_DAY=ctrt_day, THING_AMT=amt, ARCH_AREA=area, LAND_AREA=land, FLR="3",
                RGHT_SE="", RTRCN_DAY=rtrcn)
    return [vals[c] for c in REAL_ESTATE_COLUMNS]


@pytest.fixture(scope="module")
def deals_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("deals"))
    header = list(REAL_ESTATE_RENAME.keys())
    data = [
        _deal("1"), _deal("2", ctrt_day="2024-03-15", amt="125,000"), _deal("3", ctrt_day="2024.3.5"),
        _deal("4", ctrt_day="2024"), _deal("5", ctrt_day="24"), _deal("6", ctrt_day=""),
        _deal("7", bldg="A, B"), ["2024", "11200"], _deal("9") + ["x", "y"],
        _deal("10", amt="-"), _deal("11", amt="1d"), _deal("12", amt="0x1p3"), _deal("13", amt="nan"),
        _deal("14", area="0"), _deal("15", rtrcn="20240401"),
    ]
    _write(f"{d}/real_estate_2024.csv", [header] + data, bom=True)
    return d


def test_deals_bind_by_name_and_parse(spark, deals_dir):
    raw = CSV.read_layout(spark, deals_dir, layout=REAL_ESTATE_COLUMNS, rename=REAL_ESTATE_RENAME).cache()
    all_rows = raw.collect()
    by = {r["MNO"]: r for r in all_rows if r["MNO"] is not None}
    assert by["7"]["BLDG_NM"] == "A, B" and by["7"]["CTRT_DAY"] == "20240315"   # quoted comma, not shifted
    short = [r for r in all_rows if r["MNO"] is None][0]
    assert short["CGG_CD"] == "11200" and short[CSV.CORRUPT] is not None       # padded + flagged
    assert by["9"][CSV.CORRUPT] is not None                                    # surplus dropped + flagged
    assert by["9"]["OPBIZ_RESTAGNT_SGG_NM"] is None and by["9"]["CTRT_DAY"] == "20240315"
    assert by["1"][CSV.CORRUPT] is None

    deals = raw.where(F.col("MNO").isNotNull())
    proc = processed_real_estate(deals.withColumn("CGG_CD", F.col("MNO")))   # carry the row id
    out = {r[0]: r[1:] for r in rows(proc, "CGG_CD", "YEAR", "MONTH", "THING_AMT", "ARCH_AREA")}
    assert out["1"] == (2024, 3, 125000.0, 84.9)
    assert out["2"] == (2024, 3, 125000.0, 84.9)
    assert out["3"][:2] == (2024, 35)
    assert out["4"][:2] == (2024, None) and out["5"][:2] == (None, None) and out["6"][:2] == (None, None)
    for m in ("10", "11", "12", "13"):
        assert out[m][2] is None, m
    assert out["14"][3] == 0.0
    assert processed_real_estate(deals, drop_cancelled=True).count() == deals.count() - 1


def test_price_indicator_zero_area_is_null(spark):
    from urbanpulse.operators.indicators import price
    df = spark.createDataFrame([("R", 20241, 100.0, 0.0), ("R", 20241, 100.0, 50.0)],
                               "region_code string, period int, THING_AMT double, ARCH_AREA double")
    assert rows(price(df), "price") == [(2.0,)]


def test_api_layout_union_by_name(spark, tmp_path, deals_dir):
    api = [[c.lower() if c != "BLDG_USG" else "아파트" for c in REAL_ESTATE_API_COLUMNS]]
    api[0][REAL_ESTATE_API_COLUMNS.index("MNO")] = "99"
    _write(f"{tmp_path}/api/real_estate_2025.csv", api, quote_all=True)
    a = CSV.bind_by_name(CSV.read_text_csv(spark, f"{tmp_path}/api", REAL_ESTATE_API_COLUMNS,
                                           header=False, flag_corrupt=False), REAL_ESTATE_COLUMNS)
    f = CSV.read_layout(spark, deals_dir, layout=REAL_ESTATE_COLUMNS, rename=REAL_ESTATE_RENAME,
                        flag_corrupt=False)
    u = f.unionByName(a, allowMissingColumns=True)
    r = u.where(F.col("MNO") == "99").collect()[0]
    assert r["BLDG_USG"] == "아파트" and r["RGHT_SE"] is None and r["FLR"] == "flr"
    assert u.count() == f.count() + 1


def test_sales_shuffled_header_strict_numbers(spark, tmp_path):
    inv = {v: k for k, v in SALES_RENAME.items()}
    header = [inv["THSMON_SELNG_AMT"], "비고", inv["TRDAR_CD"], inv["STDR_YYQU_CD"], "기타_매출",
              inv["TRDAR_CD_NM"], inv["SVC_INDUTY_CD"], inv["SVC_INDUTY_CD_NM"], inv["WKEND_SELNG_AMT"]]
    data = [["1,234", "memo", "T1", "20231", "5", "n", "CS1", "s", "N/A"],
            ["NA", "", "T2", "2023", "", "n", "CS1", "s", "-"],
            ["1e3", "", "T3", "202", "x", "n", "CS1", "s", "+5"],
            ["7", "", "T4", "2023Q1", "1", "n", "CS1", "s", ""]]
    _write(f"{tmp_path}/sales/s.csv", [header] + data)
    korean = CSV.read_layout(spark, f"{tmp_path}/sales", flag_corrupt=False)
    typed = RN.rename_by_map(RN.type_columns(korean, RN.is_sales_numeric, strict=True), SALES_RENAME)
    got = {r["TRDAR_CD"]: r for r in typed.collect()}
    assert got["T1"]["THSMON_SELNG_AMT"] == 1234.0 and got["T1"]["WKEND_SELNG_AMT"] is None
    assert got["T1"]["비고"] == "memo" and got["T1"]["기타_매출"] == 5.0
    assert got["T2"]["THSMON_SELNG_AMT"] is None and got["T3"]["THSMON_SELNG_AMT"] is None
    assert got["T3"]["WKEND_SELNG_AMT"] is None and got["T3"]["기타_매출"] is None
    for c in ("TMZON_21_24_SELNG_AMT", "TMZON_00_06_SELNG_AMT", "AGRDE_20_SELNG_AMT",
              "AGRDE_30_SELNG_AMT", "THSMON_SELNG_CO", "TRDAR_SE_CD"):
        typed = typed.withColumn(c, F.lit(None).cast("double" if "SELNG" in c else "string"))
    p = {r["TRDAR_CD"]: (r["YEAR"], r["QUARTER"]) for r in processed_sales(typed).collect()}
    assert p == {"T1": (2023, 1), "T2": (2023, None), "T3": (None, None), "T4": (2023, None)}


def test_population_bom_bands_and_month_end(spark, tmp_path):
    header = ['"기준일ID"', "시간대구분", "행정동코드", "총생활인구수", "남자20세부터24세생활인구수",
              "여자65세부터69세생활인구수", "남자70세이상생활인구수", "기타", ""]
    data = [["20240229", "00", "1111053", "100", "10", "20", "5", "a", ""],
            ["20240228", "00", "1111053", "100", "11", "21", "6", "b", ""],
            ["20231231", "01", "1111054", "90", "9", "19", "4", "c", ""],
            ["bad", "01", "1111054", "90", "9", "19", "4", "d", ""]]
    _write(f"{tmp_path}/pop/population_2024.csv", [header] + data, bom=True)
    df = RN.rename_bands(CSV.read_layout(spark, f"{tmp_path}/pop", rename=POPULATION_RENAME, flag_corrupt=False))
    assert df.columns == ["STDR_DE_ID", "TMZON_PD_SE", "ADSTRD_CODE_SE", "TOT_LVPOP_CO", "MALE_F20_24",
                          "FEMALE_F65_69", "MALE_F70_ABOVE", "기타"]
    assert [r[0] for r in rows(df.orderBy("STDR_DE_ID"), "기타")] == ["c", "b", "a", "d"]
    typed = RN.type_columns(df, RN.is_band_column, strict=True)
    kept = sorted(r[0] for r in rows(month_end_snapshot(typed, "STDR_DE_ID"), "STDR_DE_ID"))
    assert kept == ["20231231", "20240229"]
    long = RN.bands_long(typed, ["STDR_DE_ID", "ADSTRD_CODE_SE"])
    assert long.count() == 12
    r = long.where((F.col("STDR_DE_ID") == "20240229") & (F.col("band") == "MALE_F70_ABOVE")).collect()[0]
    assert (r["gender"], r["age_lo"], r["age_hi"], r["n"], r["TOT_LVPOP_CO"]) == ("MALE", 70, None, 5.0, 100.0)
    # unpivot preserves the band sum
    bands = ["MALE_F20_24", "FEMALE_F65_69", "MALE_F70_ABOVE"]
    wide_sum = sum(typed.agg(*[F.sum(c) for c in bands]).collect()[0])
    assert long.agg(F.sum("n")).collect()[0][0] == wide_sum


def test_json_pages(spark, tmp_path):
    from pyspark.sql import types as T
    d = tmp_path / "pages"
    d.mkdir()
    (d / "p1.json").write_text('{"svc":{"list_total_count":2,"row":[{"A":"1","B":2.0},{"A":"2","B":null}]}}\n')
    (d / "p2.json").write_text('{"svc":{"row":[]}}\n')
    (d / "p3.json").write_text('{"RESULT":{"CODE":"x"}}\n')
    row = T.StructType([T.StructField("A", T.StringType()), T.StructField("B", T.DoubleType())])
    out = JP.read_pages(spark, str(d), "svc", row)
    assert sorted(rows(out)) == [("1", 2.0), ("2", None)]


def test_json_pages_roundtrip(spark, tmp_path):
    from pyspark.sql import types as T
    # one key holding most rows must still give pages of <= page_size rows
    df = spark.range(2500).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("k"))
    JP.write_pages(df.repartition(3), str(tmp_path / "out"), "svc", page_size=400)
    row = T.StructType([T.StructField("k", T.LongType())])
    back = JP.read_pages(spark, str(tmp_path / "out"), "svc", row)
    assert back.count() == 2500 and back.where(F.col("k") == 7).count() == 2000
    sizes = spark.read.text(str(tmp_path / "out")).select(
        F.get_json_object("value", "$.svc.list_total_count").cast("int").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 400 and sum(r["n"] for r in sizes) == 2500


def test_parquet_folders_safe_union(spark, tmp_path):
    root = str(tmp_path / "sets")
    spark.range(5).write.parquet(f"{root}/a")
    spark.range(5, 8).write.parquet(f"{root}/b")
    os.makedirs(f"{root}/c_bad")
    with open(f"{root}/c_bad/part-0.parquet", "wb") as f:
        f.write(b"junk bytes, not parquet")
    df, failed = PQ.read_parquet_folders(spark, root=root)
    assert sorted(r[0] for r in df.collect()) == list(range(8))
    assert list(failed) == [f"file:{root}/c_bad"] or any(k.endswith("c_bad") for k in failed)
    df2, _ = PQ.read_parquet_folders(spark, root=root, schema=spark.range(1).schema)
    assert df2.count() == 8
    os.makedirs(f"{tmp_path}/only_bad/x")
    with open(f"{tmp_path}/only_bad/x/p.parquet", "wb") as f:
        f.write(b"junk")
    with pytest.raises(ValueError):
        PQ.read_parquet_folders(spark, root=f"{tmp_path}/only_bad")


def test_multi_year_scan_skips_absent_years(spark, tmp_path):
    for y in (2021, 2023):
        _write(f"{tmp_path}/years/orders_{y}.csv", [["k", "v"], [f"{y}-1", "1"], [f"{y}-2", "2"]])
    df, skipped = CSV.read_years(spark, f"{tmp_path}/years/orders_{{year}}.csv", range(2021, 2026),
                                 year_regex=r"orders_(\d{4})\.csv")
    assert skipped == [2022, 2024, 2025]
    assert sorted(rows(df, "k", "YEAR")) == [("2021-1", 2021), ("2021-2", 2021), ("2023-1", 2023), ("2023-2", 2023)]


def test_external_table_and_dynamic_overwrite(spark, tmp_path):
    _write(f"{tmp_path}/raw/t.csv", [["1", "a"], ["2", "b"]])
    t = create_external_table(spark, "ext_raw_test", f"{tmp_path}/raw", "csv", ["k", "v"])
    assert sorted(rows(t)) == [("1", "a"), ("2", "b")]
    assert spark.catalog.getTable("ext_raw_test").tableType == "EXTERNAL"
    df = spark.createDataFrame([(1, 2023), (2, 2024), (3, 2024)], "k int, YEAR int")
    p = str(tmp_path / "proc")
    SK.write_parquet(df, p, partition_by=["YEAR"])
    SK.write_parquet(spark.createDataFrame([(9, 2024)], "k int, YEAR int"), p, partition_by=["YEAR"])
    assert sorted(rows(spark.read.parquet(p), "k", "YEAR")) == [(1, 2023), (9, 2024)]


def test_region_sink_profile_sample(spark, tmp_path):
    df = spark.createDataFrame([("R1", 1, 1.5), ("R1", 2, None), ("R2", 1, 3.0)], "region_code string, period int, x double")
    SK.write_by_region(df, str(tmp_path / "by_region"))
    folders = sorted(f for f in os.listdir(tmp_path / "by_region") if f.startswith("region_code="))
    assert folders == ["region_code=R1", "region_code=R2"]
    for f in folders:  # one data file per region
        assert len([x for x in os.listdir(tmp_path / "by_region" / f) if x.endswith(".csv")]) == 1
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "by_region"))
    assert sorted(rows(back.select(*df.columns)), key=str) == sorted(rows(df), key=str)
    prof = {r[0]: r[1:] for r in rows(SK.profile(df))}
    assert prof == {"region_code": ("string", 0, 3), "period": ("int", 0, 3), "x": ("double", 1, 3)}
    assert rows(SK.sample_rows(df, 2, ["region_code", "period"]), "period") == [(1,), (2,)]


def test_json_pages_multiline_files_and_empty_pages(spark, tmp_path):
    from pyspark.sql import types as T
    d = tmp_path / "saved"
    d.mkdir()
    (d / "a.json").write_text('{\n  "svc": {\n    "list_total_count": 1,\n    "row": [\n      {"A": "x", "B": 1.0}\n    ]\n  }\n}\n')
    (d / "b.json").write_text('{\n  "svc": {"row": []}\n}\n')
    (d / "c.json").write_text('{\n  "RESULT": {"CODE": "INFO-200"}\n}\n')
    row = T.StructType([T.StructField("A", T.StringType()), T.StructField("B", T.DoubleType())])
    assert rows(JP.read_pages(spark, str(d), "svc", row, multi_line=True)) == [("x", 1.0)]
    kept = JP.read_pages(spark, str(d), "svc", row, multi_line=True, keep_empty_pages=True)
    assert kept.count() == 3 and kept.where(F.col("A").isNull()).count() == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_prunes_partitions_and_pushes_filters(spark, tmp_path):
    from urbanpulse.operators.filters import code_in_set, period_between
    df = spark.createDataFrame([(i, 2020 + i % 5, str(i % 7)) for i in range(100)], "k int, YEAR int, code string")
    p = str(tmp_path / "by_year")
    SK.write_parquet(df, p, partition_by=["YEAR"])
    sel = period_between(spark.read.parquet(p), "YEAR", 2022, 2023)
    plan = _plan(sel)
    assert "PartitionFilters: [isnotnull(YEAR" in plan and "(YEAR#" in plan
    assert sel.count() == 40
    coded = code_in_set(spark.read.parquet(p).select("k", "code"), "code", ["1", "2"])
    cplan = _plan(coded)
    assert "PushedFilters: [In(code" in cplan and "ReadSchema: struct<k:int,code:string>" in cplan


def test_duplicate_header_names_keep_positions(spark, tmp_path):
    _write(f"{tmp_path}/dup/x.csv", [["a", "b", "a", ""], ["1", "2", "3", "4"]])
    df = CSV.read_layout(spark, f"{tmp_path}/dup", flag_corrupt=False)
    assert df.columns == ["a", "b", "a_2"] and rows(df) == [("1", "2", "3")]


def test_rent_file_and_api_layouts(spark, tmp_path):
    from urbanpulse.plans.processed import processed_rent
    from urbanpulse.schemas import RENT_API_COLUMNS, RENT_COLUMNS, RENT_RENAME
    inv = {v: k for k, v in RENT_RENAME.items()}

    def rent_row(stdg, day, area, grfe, rtfe, bfr_g="", bfr_r=""):
        v = dict.fromkeys(RENT_COLUMNS, "")
        v.update(STDG_CD=stdg, CTRT_DAY=day, RENT_AREA=area, GRFE=grfe, RTFE=rtfe, BFR_GRFE=bfr_g, BFR_RTFE=bfr_r,
                 LOTNO_SE="1", LOTNO_SE_NM="대지", MNO="12")
        return [v[c] for c in RENT_COLUMNS]
    _write(f"{tmp_path}/rent/rent_2024.csv", [[inv[c] for c in RENT_COLUMNS],
                                              rent_row("D1", "20240110", "84.5", "50,000", "0"),         # deposit only
                                              rent_row("D2", "2024-02-03", "59", "1000", "80"),          # monthly
                                              rent_row("D3", "20240305", "", "30000", "10", "25000", "5")])  # renewal
    api = dict.fromkeys(RENT_API_COLUMNS, "")
    api.update(STDG_CD="D4", LOTNO_SE="1", MNO="7", CTRT_DAY="20240406", GRFE="2000", RTFE="60", BLDG_USG="연립")
    _write(f"{tmp_path}/rent_api/r.csv", [[api[c] for c in RENT_API_COLUMNS]], quote_all=True)
    f = CSV.read_layout(spark, f"{tmp_path}/rent", layout=RENT_COLUMNS, rename=RENT_RENAME, flag_corrupt=False)
    a = CSV.bind_by_name(CSV.read_text_csv(spark, f"{tmp_path}/rent_api", RENT_API_COLUMNS, header=False,
                                           flag_corrupt=False), RENT_COLUMNS)
    p = {r["STDG_CD"]: r for r in processed_rent(f.unionByName(a)).collect()}
    assert (p["D1"]["GRFE"], p["D1"]["RTFE"], p["D1"]["MONTH"]) == (50000.0, 0.0, 1)
    assert (p["D2"]["RENT_AREA"], p["D2"]["RTFE"], p["D2"]["MONTH"]) == (59.0, 80.0, 2)
    assert (p["D3"]["RENT_AREA"], p["D3"]["BFR_GRFE"], p["D3"]["BFR_RTFE"]) == (None, 25000.0, 5.0)
    assert (p["D4"]["GRFE"], p["D4"]["RTFE"], p["D4"]["YEAR"], p["D4"]["MONTH"]) == (2000.0, 60.0, 2024, 4)
    raw_api = a.collect()[0]
    assert raw_api["LOTNO_SE_NM"] is None and raw_api["MNO"] == "7" and raw_api["BLDG_USG"] == "연립"  # no shift


def test_processed_schemas_match_survey(spark):
    from urbanpulse.plans import processed as PR
    from urbanpulse.schemas import (LAYOUTS, PROCESSED_POPULATION, PROCESSED_REAL_ESTATE, PROCESSED_RENT,
                                    PROCESSED_SALES, all_string_schema)
    empty = {k: spark.createDataFrame([], all_string_schema(v)) for k, v in LAYOUTS.items()}
    assert PR.processed_real_estate(empty["real_estate"]).columns == PROCESSED_REAL_ESTATE
    assert PR.processed_rent(empty["rent"]).columns == PROCESSED_RENT
    assert PR.processed_sales(empty["sales"]).columns == PROCESSED_SALES
    assert PR.processed_population(empty["population"]).columns == PROCESSED_POPULATION
    types = dict(PR.processed_sales(empty["sales"]).dtypes)
    assert types["YEAR"] == "int" and types["QUARTER"] == "int" and types["THSMON_SELNG_AMT"] == "double"


def test_inspect_cli(spark, tmp_path, capsys):
    from urbanpulse.sources.inspect import main
    root = str(tmp_path / "proc")
    spark.range(3).write.parquet(f"{root}/a")
    spark.range(3, 5).write.parquet(f"{root}/b")
    os.makedirs(f"{root}/bad")
    with open(f"{root}/bad/x.parquet", "wb") as f:
        f.write(b"nope")
    assert main([root, "--rows", "2"]) == 0
    out = capsys.readouterr().out
    assert "FAILED:" in out and "id\tbigint\tnulls=0\trows=5" in out
    assert main([str(tmp_path / "missing")]) == 1


def _lines(path, rows_, **kw):
    import csv as C
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        C.writer(f, lineterminator="\n", **kw).writerows(rows_)


def test_csv_keeps_quotes_and_backslashes(spark, tmp_path):
    """Fields as Python's csv writes them come back whole; so do ours."""
    from urbanpulse.sources import sinks as SK
    want = [("1", 'T "X", 101', "20240101"), ("2", "ends in \\", "20240102"), ("3", 'a ""quoted"" b', "c,d")]
    _lines(f"{tmp_path}/in/a.csv", [("A", "B", "C"), *want])
    df = CSV.read_layout(spark, f"{tmp_path}/in").cache()
    assert sorted(rows(df, "A", "B", "C")) == want and df.where(F.col(CSV.CORRUPT).isNotNull()).count() == 0
    SK.write_csv(df.select("A", "B", "C"), f"{tmp_path}/out")
    assert sorted(rows(CSV.read_layout(spark, f"{tmp_path}/out"), "A", "B", "C")) == want


def test_every_file_binds_to_its_own_header(spark, tmp_path):
    _lines(f"{tmp_path}/y/2021.csv", [("A", "B"), ("a1", "b1")])
    _lines(f"{tmp_path}/y/2022.csv", [("B", "A", "N"), ("b2", "a2", "n2")])
    got = sorted(rows(CSV.read_layout(spark, f"{tmp_path}/y", flag_corrupt=False), "A", "B", "N"))
    assert got == [("a1", "b1", None), ("a2", "b2", "n2")]
    df, skipped = CSV.read_years(spark, f"{tmp_path}/y/{{year}}.csv", year_regex=r"/(\d{4})\.csv")
    assert sorted(rows(df, "A", "B", "YEAR")) == [("a1", "b1", 2021), ("a2", "b2", 2022)] and skipped == []


def test_a_folder_with_an_unreadable_file_is_reported(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/p/good")
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/p/bad")
    with open(f"{tmp_path}/p/bad/part-9.parquet", "w") as f:
        f.write("no parquet")
    for schema in (None, spark.range(1).schema):
        df, failed = PQ.read_parquet_folders(spark, root=f"{tmp_path}/p", schema=schema)
        assert df.count() == 100 and [os.path.basename(k) for k in failed] == ["bad"]
