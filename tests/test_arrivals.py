"""What arrives in the raw layer: page accounting, rejected records, headers of
many files, and the checks of the daily run over them."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from urbanpulse.operators.indicators import age_shares, band_sums, folded_shares
from urbanpulse.plans import daily_run as DR
from urbanpulse.schemas import SALES_API_COLUMNS, SERVICES
from urbanpulse.session import clear_scratch, scratch_root, scratch_table
from urbanpulse.sources import csv as CSV
from urbanpulse.sources import json_pages as JP
from urbanpulse.sources import pages as PG

ROW = T.StructType([T.StructField("A", T.StringType())])


def page(n, total):
    return json.dumps({"svc": {"list_total_count": total, "row": [{"A": str(i), "Z": 1} for i in range(n)]}})


def land(root, period, first, last, *texts):
    os.makedirs(f"{root}/period={period}", exist_ok=True)
    with open(f"{root}/period={period}/x_{first}_{last}.json", "a") as f:
        f.writelines(t + "\n" for t in texts)


def test_page_accounting(spark, tmp_path):
    root = str(tmp_path / "pages")
    for first, n in ((1, 10), (11, 10), (21, 5)):
        land(root, "whole", first, first + 9, page(n, 25))
    land(root, "missing", 1, 10, page(10, 25)), land(root, "missing", 21, 30, page(5, 25))
    land(root, "cut", 1, 10, page(7, 25)), land(root, "cut", 11, 20, page(10, 25)[:40]), land(root, "cut", 21, 30, page(5, 25), page(5, 25))
    for first in (1, 11, 21):
        land(root, "capped", first, first + 9, page(10, 40)), land(root, "changed", first, first + 9, page(10, 30 if first < 21 else 31))
    land(root, "error", 1, 10, '{"RESULT":{"CODE":"INFO-200"}}'), land(root, "none", 1, 10, page(0, 0)), land(root, "blank", 1, 10, "")
    log = PG.read_page_log(spark, root, "svc", ROW)
    status = {(r["period"], r["first"], r["status"]) for r in log.collect()}
    assert {("cut", 11, "malformed"), ("error", 1, "error"), ("none", 1, "empty"), ("blank", 1, "malformed"), ("whole", 1, "ok")} <= status
    got = {r[0]: tuple(r)[1:] for r in PG.reconcile_pages(log, page_rows=10, period_rows=30).collect()}
    #               announced, pages, malformed, cut, repeated, expected, received, missing, ranges
    assert got == {
        "whole": (25, 3, 0, 0, 0, 25, 25, 0, "", "complete"), "missing": (25, 2, 0, 0, 0, 25, 15, 10, "11-20", "incomplete"),
        "cut": (25, 4, 1, 1, 1, 25, 12, 13, "11-20", "incomplete"), "capped": (40, 3, 0, 0, 0, 30, 30, 0, "", "capped"),
        "changed": (31, 3, 0, 0, 0, 30, 30, 0, "", "changed"), "error": (None, 1, 0, 0, 0, None, 0, None, "", "unknown"),
        "none": (0, 1, 0, 0, 0, 0, 0, 0, "", "complete"), "blank": (None, 1, 1, 0, 0, None, 0, None, "", "unknown")}
    assert PG.page_rows(log).count() == 25 + 15 + 17 + 30 + 30
    bad = PG.rejected_pages(log).collect()
    assert {(r["period"], r["raw"]) for r in bad} == {("cut", page(10, 25)[:40]), ("blank", "")}


def test_pages_without_ranges_and_saved_responses(spark, tmp_path):
    df = spark.range(95).select(F.col("id").cast("string").alias("A"), (F.col("id") % 2).alias("p"))
    JP.write_period_pages(df.repartition(3), str(tmp_path / "p"), "svc", "p", page_size=7)
    log = PG.read_page_log(spark, str(tmp_path / "p"), "svc", ROW)
    assert log.agg(F.max("received")).first()[0] <= 7
    got = {r["period"]: r for r in PG.reconcile_pages(log).collect()}
    assert {(p, r["announced"], r["received"], r["missing_rows"], r["missing"], r["status"]) for p, r in got.items()} == {
        ("0", 48, 48, 0, "", "complete"), ("1", 47, 47, 0, "", "complete")}
    os.makedirs(tmp_path / "w/period=1")
    (tmp_path / "w/period=1/1_10.json").write_text(json.dumps(json.loads(page(3, 3)), indent=2))
    assert PG.page_rows(PG.read_page_log(spark, str(tmp_path / "w"), "svc", ROW, whole_files=True)).count() == 3


def test_reject_table(spark, tmp_path):
    odd = tmp_path / "a b%41[x]"
    odd.mkdir()
    (odd / "f é.csv").write_text('A,B\n1,"x\ny"\n2,z\n3\n4,"a,c",b\n5,"un""q"\n6,"ends \\"\n', encoding="utf-8")
    (tmp_path / "p.csv").write_text("B,A\n1,2\nlonely\n")
    (tmp_path / "open.csv").write_text('A,B\n1,2\n7,"never closed\n8,z\n')
    (tmp_path / "_SUCCESS").write_text("")
    records = CSV.read_by_header(spark, [str(tmp_path)], with_file=True)
    good = sorted(rows(CSV.good_records(records), "A", "B"))
    assert ("1", "x\ny") in good and ("5", 'un"q') in good and ("6", "ends \\") in good and ("2", "1") in good and ("1", "2") in good
    rejects = CSV.reject_table(records)
    assert rejects.columns == CSV.REJECT_COLUMNS
    assert sorted(rows(rejects, "reason", "n_expected", "n_fields", "first_field", "raw")) == [
        ("long", 2, 3, "4", '4,"a,c",b'), ("short", 2, 1, "3", "3"), ("short", 2, 1, "lonely", "lonely")]
    assert rejects.groupBy("reason").count().count() == 2  # counted without reading other columns
    assert [r["file"].rsplit("/", 1)[-1] for r in CSV.unbalanced_files(spark, [str(tmp_path)]).collect()] == ["open.csv"]


def test_headers_of_many_small_files(spark, tmp_path):
    """One job finds the headers of all files; the driver sees distinct ones."""
    for i in range(300):
        names = ["A", "B", "N"][: 2 + i % 2]
        order = names if i % 3 else names[::-1]
        values = {"A": f"a{i}", "B": f"b{i}", "N": f"n{i}"}
        (tmp_path / f"f{i:03}.csv").write_text(",".join(order) + "\n" + ",".join(values[c] for c in order) + "\n")
    groups = CSV.files_by_header(spark, [str(tmp_path)])
    assert len(groups) == 4 and sum(map(len, groups.values())) == 300
    got = {r["A"]: (r["B"], r["N"]) for r in CSV.read_layout(spark, str(tmp_path), flag_corrupt=False).collect()}
    assert got == {f"a{i}": (f"b{i}", f"n{i}" if i % 2 else None) for i in range(300)}


def _sales(q, code, amount):
    return dict.fromkeys(SALES_API_COLUMNS, "") | {"STDR_YYQU_CD": q, "TRDAR_CD": code, "THSMON_SELNG_AMT": amount}


def test_daily_run_reads_pages_and_reports_what_is_missing(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    answer = lambda rs, total: json.dumps({SERVICES["sales"]: {"list_total_count": total, "row": rs}})
    land(f"{raw}/pages/sales", "20241", 1, 1000, answer([_sales("20241", "T1", "10"), _sales("20241", "T2", 20)], 2))
    land(f"{raw}/pages/sales", "20242", 1, 1000, answer([_sales("20242", "T1", "30")] * 2, 2001))
    land(f"{raw}/pages/sales", "20242", 1001, 2000, answer([_sales("20242", "T2", "5")], 2001)[:70])
    os.makedirs(f"{raw}/api/sales")
    with open(f"{raw}/api/sales/sales_20243.csv", "w") as f:
        f.write('"20243","T1","n","7","",""\n"20243","T2"\n')
    region_map = spark.createDataFrame([("sales", "T1", "R1"), ("sales", "T2", "R2")], "source string, code string, region_code string")
    outs = DR.run_all(spark, raw, out, region_map)
    sold = {(r["TRDAR_CD"], r["YEAR"], r["QUARTER"]): r["THSMON_SELNG_AMT"] for r in spark.read.parquet(outs["processed/sales"]).collect()}
    # a repeated row counts once; the short record is padded; the cut page gives nothing
    assert sold == {("T1", 2024, 1): 10.0, ("T2", 2024, 1): 20.0, ("T1", 2024, 2): 30.0, ("T1", 2024, 3): 7.0, ("T2", 2024, 3): None}
    pages = {r["period"]: r for r in spark.read.option("header", True).csv(outs["load_pages"]).collect()}
    assert pages["20241"]["status"] == "complete" and pages["20242"]["status"] == "incomplete"
    assert (pages["20242"]["n_malformed"], pages["20242"]["missing_rows"], pages["20242"]["missing"]) == ("1", "1999", "1001-2000,2001-2001")
    rejects = sorted(rows(spark.read.parquet(outs["load_rejects"]), "DATA_SRC", "reason", "n_fields", "first_field"), key=str)
    assert rejects == [("sales", "malformed_page", None, "20242"), ("sales", "short", 2, "20243")]


def test_truncation_counts_rows_before_repeats_are_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DR, "PERIOD_ROW_CAP", 40)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    os.makedirs(f"{raw}/api/sales")
    for name, q, n in (("a", "20241", 40), ("b", "20242", 39), ("c", "20241", 3)):
        with open(f"{raw}/api/sales/{name}.csv", "w") as f:
            f.writelines(f'"{q}","T{i // 2}","n","7","",""\n' for i in range(n))  # every row twice
    region_map = spark.createDataFrame([("sales", "T1", "R1")], "source string, code string, region_code string")
    outs = DR.run_all(spark, raw, out, region_map)
    capped = spark.read.option("header", True).csv(outs["load_capped"]).collect()
    assert [(r["DATA_SRC"], r["period"], r["file"].rsplit("/", 1)[-1], r["n_rows"]) for r in capped] == [("sales", "20241", "a.csv", "40")]


def test_folded_bands_equal_unpivoted_ones(spark):
    from urbanpulse.operators import rename as RN
    data = [("C1", "20240101", 100.0, 10.0, 5.0, None, 7.0, 2.0), ("C1", "20240102", 80.0, None, 6.0, 4.0, None, 2.0),
            ("C2", "20240101", 50.0, 1.0, 2.0, 3.0, 4.0, 5.0)]
    wide = spark.createDataFrame(data, "region_code string, STDR_DE_ID string, TOT_LVPOP_CO double, MALE_F10_14 double, MALE_F20_24 double, "
                                 "FEMALE_F30_34 double, MALE_F65_69 double, FEMALE_F70_ABOVE double").withColumn("period", F.lit(20241))
    young, old, some = band_sums(wide.columns)
    folded = folded_shares(wide.filter(some).select("region_code", "period", "TOT_LVPOP_CO", young.alias("young"), old.alias("old")))
    long = RN.bands_long(wide, ["region_code", "period", "STDR_DE_ID"]).withColumn("snapshot", F.col("STDR_DE_ID"))
    cols = ("region_code", "period", "youth_share", "senior_share")
    assert sorted(rows(folded, *cols)) == sorted(rows(age_shares(long), *cols))


def test_clear_scratch_drops_its_own_tables_only(spark, tmp_path):
    root = scratch_root(spark)
    own = scratch_table(spark, "customer_raw")
    for name in ("customer_of_user", own):
        spark.range(3).write.parquet(str(tmp_path / name))
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{tmp_path / name}'")
    # scratch data of other tests of this session stays: only the tables are looked at
    import urbanpulse.session as S
    fs, p = S.hadoop_fs(spark, root)
    kept = S.scratch_root
    S.scratch_root = lambda s: str(tmp_path / "nothing")
    try:
        clear_scratch(spark)
    finally:
        S.scratch_root = kept
    names = {t.name for t in spark.catalog.listTables()}
    assert "customer_of_user" in names and own not in names
    spark.sql("DROP TABLE customer_of_user")


def test_incremental_states_equal_a_full_run(spark, tmp_path):
    """Only the changed year is read and written, and the indicators are those of a full run."""
    import time

    from urbanpulse.operators.states import merged, partial_states, refresh_states
    from urbanpulse.sources.sinks import write_parquet
    schema = "region_code string, period int, YEAR int, THING_AMT double, ARCH_AREA double"
    first = [("R1", 20231, 2023, 10.0, 3.0), ("R1", 20231, 2023, 0.1, 7.0), ("R2", 20234, 2023, 5.0, 0.0), ("R1", 20241, 2024, 8.0, 2.0),
             (None, 20241, 2024, 1.0, 1.0), ("R2", 20242, 2024, None, 1.0)]
    deals, states = str(tmp_path / "deals"), str(tmp_path / "states")
    write_parquet(spark.createDataFrame(first, schema), deals, partition_by=["YEAR"])
    ages = spark.createDataFrame([("R1", 20241, 2024, 30.0, 10.0, 100.0), ("R1", 20241, 2024, 20.0, 20.0, 50.0)],
                                 "region_code string, period int, YEAR int, young double, old double, TOT_LVPOP_CO double")
    refresh_states(spark, states, {"real_estate": spark.read.parquet(deals), "population_ages": ages})
    files = {f: os.path.getmtime(f) for d, _, names in os.walk(states) for f in (f"{d}/{n}" for n in names) if "YEAR=2023" in f}
    time.sleep(0.05)
    write_parquet(spark.createDataFrame([("R1", 20241, 2024, 9.0, 3.0), ("R3", 20243, 2024, 4.0, 4.0)], schema), deals, partition_by=["YEAR"])
    changed = spark.read.parquet(deals)
    plan = partial_states(changed.filter(F.col("YEAR").isin([2024])), "real_estate")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024" in plan.split("PartitionFilters: [")[1].split("]")[0]
    refresh_states(spark, states, {"real_estate": changed}, years=[2024])
    assert files and files == {f: os.path.getmtime(f) for f in files}  # 2023 was left alone
    full = str(tmp_path / "full")
    refresh_states(spark, full, {"real_estate": changed, "population_ages": ages})
    cols = ("region_code", "period", "price", "rent", "sales", "youth_share", "senior_share")
    got = sorted(rows(merged(spark.read.parquet(states)), *cols), key=str)
    # a group whose rows are all gone keeps no state: its partition was written anew
    assert got == sorted(rows(merged(spark.read.parquet(full)), *cols), key=str)
    by = {r[:2]: r[2:] for r in got}
    assert by["R1", 20241] == (3.0, None, None, 25.0 / 75.0, 15.0 / 75.0) and by["R2", 20234][0] is None
    assert ("R2", 20242) not in by and by["R3", 20243][0] == 1.0
