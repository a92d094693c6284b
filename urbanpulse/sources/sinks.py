"""Sinks and inspection."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..session import drop_path, hadoop_fs, release

# RFC 4180: a quoted field holds a quote as two quotes, a backslash is itself.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  dynamic: bool = True) -> None:
    """Overwrite; with partition columns, only the partitions present in
    ``df`` are replaced (daily reload of one year keeps the others).

    A partitioned write is rebalanced on its partition columns first (AQE
    REBALANCE): each year's rows gather into few, reasonably sized files
    instead of one file per task and year, and a year holding a large share
    of the rows is split over several tasks rather than one."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_parquet_parts(parts: Iterable[DataFrame], path: str, partition_by: list[str], **options) -> None:
    """``write_parquet`` of the parts' union with dynamic overwrite, a part at a
    time: only one part's shuffle is on disk at once.  The parts gather in a hidden
    folder below ``path``; at the end every partition found there takes the place
    of the one at ``path``.  ``options`` are the writer's own."""
    gathered = f"{path}/.parts-{uuid.uuid4().hex[:12]}"
    for df in parts:
        spark = df.sparkSession
        df.hint("rebalance", *partition_by).write.mode("append").options(**options).partitionBy(*partition_by).parquet(gathered)
        release(spark)
    fs, found = hadoop_fs(spark, gathered)
    _replace_partitions(fs, found, hadoop_fs(spark, path)[1], len(partition_by))
    drop_path(spark, gathered)


def _replace_partitions(fs, found, target, depth: int) -> None:
    """Move the partition folders, ``depth`` levels below the folder ``found``, to
    their places below ``target``, and the marker of a finished write."""
    for st in fs.listStatus(found):
        own = st.getPath()
        place = target.suffix("/" + own.getName())
        if st.isDirectory() and "=" in own.getName():
            if depth > 1:
                _replace_partitions(fs, own, place, depth - 1)
                continue
        elif own.getName() != "_SUCCESS":
            continue
        fs.delete(place, True)
        fs.mkdirs(target)
        if not fs.rename(own, place):
            raise OSError(f"{own.toString()} couldn't be moved to {place.toString()}")


def write_csv(df: DataFrame, path: str, header: bool = True, partition_by: list[str] | None = None, **options) -> None:
    """RFC 4180 CSV with header (a quote inside a field is doubled); null
    numbers are written as empty fields.  ``options`` are the writer's own."""
    w = df.write.mode("overwrite").options(**CSV_QUOTING).option("header", header).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_by_region(df: DataFrame, path: str, region: str = "region_code") -> None:
    """One folder per region.  Rows are rebalanced on the region first
    (AQE REBALANCE), so a small region is written as one file and a large
    region is split over several tasks instead of one."""
    write_csv(df.hint("rebalance", region), path, header=True, partition_by=[region])


def profile(df: DataFrame) -> DataFrame:
    """S14 + A1: one row per column -- name, type, null count, row count --
    from a single aggregate pass."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [(F.count(F.lit(1)) - F.count(F.col(f"`{f.name}`"))).alias(f"_n{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"_n{i}").alias("null_count"), F.col("_rows").alias("row_count"))
            for i, f in enumerate(fields)]
    return one.select(F.inline(F.array(*rows)))


def load_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """A1: rows per source / period, the load check after each run."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def capped_periods(counts: DataFrame, cap: int, n_col: str = "n_rows") -> DataFrame:
    """Load-check rows whose count reaches the collector's limit: what was
    collected for that period was probably cut off.  ``counts`` are per
    collected unit (set, layout, and the period the collector asks for)."""
    return counts.where(F.col(n_col) >= F.lit(cap))


def sample_rows(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """L1: first ``n`` rows; ordered when a deterministic sample is needed."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
