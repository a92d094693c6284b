"""Helpers shared by the operators: reading the driver tables, slicing Arrow
batches by text volume, and the train / held-out split."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanpulse.session import stage_table

#: Text handled at once inside a task; a longer single text is a slice of its own.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``stage_table``, after which the shuffle files that its plan left are
    given back: Spark removes those of a shuffle once the driver has collected
    its objects, by itself at long intervals only."""
    out = stage_table(df, name)
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to."""
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def hash_id(*columns: str, salt: int = 0) -> Column:
    """64-bit hash of the columns; each salt gives another one."""
    return F.xxhash64(F.lit(salt), *columns) if salt else F.xxhash64(*columns)


def settled_id(rows: DataFrame, *columns: str, rounds: int = 8) -> Column:
    """A 64-bit number of the values in ``columns`` that different values of
    ``rows`` don't share.

    One aggregate holds every hash against a second one.  Values whose first
    hash two of them share (some dozens among 5e10; only these hashes reach the
    driver) take a salted hash, which is held against the others again.  Values
    meet only if both hashes, 128 bits, agree."""
    number = hash_id(*columns)
    for salt in range(1, rounds + 1):
        met = (rows.select(number.alias("id"), F.xxhash64(F.lit(-1), *columns).alias("other"))
               .groupBy("id").agg(F.min("other").alias("low"), F.max("other").alias("high"))
               .filter("low <> high").select("id").collect())
        if not met:
            return number
        number = F.when(number.isin(*[r["id"] for r in met]), hash_id(*columns, salt=salt)).otherwise(number)
    raise RuntimeError(f"hashes still meet after {rounds} rounds")


def slices(batch: pa.RecordBatch, text: str = "text", max_bytes: int = SLICE_BYTES,
           max_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with a bounded number of rows and bytes."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = int(upto[start - 1]) if start else 0
        stop = int(np.searchsorted(upto, done + max_bytes, side="right"))
        stop = min(max(stop, start + 1), start + max_rows, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
    # workers live on for later tasks: give back what this batch took
    pa.default_memory_pool().release_unused()


def encoded(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return pc.fill_null(batch.column(text).cast(pa.large_binary()), b"").to_pylist()


class PieceCache(dict):
    """Memo of a function over text pieces, emptied when it holds ``most``
    entries, so that a Python worker's memory stays bounded."""

    def __init__(self, work, most: int = 300_000):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, piece):
        if len(self) >= self.most:
            self.clear()
        self[piece] = value = self.work(piece)
        return value
