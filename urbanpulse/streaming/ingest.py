"""availableNow ingestion of landed CSV files and JSON pages into processed
Parquet (S1/S6 + P12 + S10, run incrementally)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import all_string_schema
from ..session import checkpoint_root
from ..sources.sinks import CSV_QUOTING


def _run(df: DataFrame, out_path: str, checkpoint: str | None, partition_by: list[str] | None,
         name: str) -> int:
    cp = checkpoint or f"{checkpoint_root(df.sparkSession)}/urbanpulse-streams/{name}"
    w = (df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", cp)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    progress = q.recentProgress
    return int(sum(p.get("numInputRows", 0) for p in progress)) if progress else 0


def ingest_landed_csv(spark: SparkSession, landing_dir: str, columns: list[str], out_path: str,
                      process: Callable[[DataFrame], DataFrame], checkpoint: str | None = None,
                      partition_by: list[str] | None = ("YEAR",), name: str = "csv",
                      max_files_per_trigger: int | None = None) -> int:
    """Process the CSV files landed in ``landing_dir`` since the last run
    (RFC 4180, all fields text); returns the number of input rows handled by
    this run.  A stream has one column order: a file whose header isn't
    ``columns`` stops the run instead of shifting its fields (read such folders
    with ``sources.csv.read_layout``)."""
    r = (spark.readStream.schema(all_string_schema(columns)).options(**CSV_QUOTING).option("header", True)
         .option("enforceSchema", False).option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _run(process(r.csv(landing_dir)), out_path, checkpoint, list(partition_by or []), name)


def ingest_landed_pages(spark: SparkSession, landing_dir: str, service: str, row: T.StructType,
                        out_path: str, process: Callable[[DataFrame], DataFrame],
                        checkpoint: str | None = None, partition_by: list[str] | None = ("YEAR",),
                        name: str = "pages") -> int:
    """Same for landed JSON API pages: one record per ``<service>.row``
    element; pages without rows add nothing."""
    from ..sources.json_pages import page_schema
    pages = spark.readStream.schema(page_schema(service, row)).json(landing_dir)
    rows = pages.select(F.inline(F.coalesce(F.col(f"{service}.row"), F.array().cast(T.ArrayType(row)))))
    return _run(process(rows), out_path, checkpoint, list(partition_by or []), name)
