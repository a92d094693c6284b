"""Parquet scans over one or many dataset folders."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.sets import union_all
from ..session import list_subfolders

log = logging.getLogger("urbanpulse.sources")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def footer_error(spark: SparkSession, path: str) -> str | None:
    """Why a folder's Parquet footers can't be read (all files are looked at,
    in a Spark job over the footers only), or None if they can."""
    try:
        spark.read.option("mergeSchema", "true").parquet(path)
    except Exception as e:  # noqa: BLE001 - the reason is what is returned
        return f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
    return None


def read_parquet_folders(spark: SparkSession, root: str | None = None,
                         paths: list[str] | None = None,
                         schema: T.StructType | None = None):
    """Read every sub-folder of ``root`` (or the given ``paths``).

    The footers of every folder are checked first; a folder with an unreadable
    file is reported and left out whole, never in part.  With a ``schema`` the
    others are one multi-path scan; without, they are bag-unioned by position
    (U1).  Returns (frame, {folder: error}); raises when no folder is readable.
    """
    folders = paths if paths is not None else (list_subfolders(spark, root) or [root])
    failed = {f: err for f in folders if (err := footer_error(spark, f))}
    for f, err in failed.items():
        log.warning("unreadable parquet folder left out: %s (%s)", f, err)
    good = [f for f in folders if f not in failed]
    if not good:
        raise ValueError(f"no readable parquet data under {root or paths}: {failed}")
    if schema is not None:
        return spark.read.schema(schema).parquet(*good), failed
    return union_all([spark.read.parquet(f) for f in good]), failed
