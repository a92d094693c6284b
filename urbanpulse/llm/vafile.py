"""Exact top-k search by inner product with vector-approximation files.

Every distinct vector is stored as one small cell number per dimension.  The
search scans the cells only: they bound the score of each vector from below and
above, and a vector whose upper bound is under the k-th lower bound is out.
Exact vectors are then read in bound order: first the most promising ones of
each query, whose k-th exact score decides which of the others must be read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse.llm.common import table
from urbanpulse.session import stage_table

CELLS = 64
#: Inner products of vectors up to this (see ``quantised``) stay below 2^62.
MOST = 2**31 - 1
#: Queries that are broadcast at once.
BLOCK_QUERIES = 2048


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, vec: floor(scale * component) of every vector without null or
    non-finite components; null vectors and null ids are left out.  So are
    vectors with a component that is, times scale and the root of the length, over
    MOST: their inner products need not fit in 64 bits."""
    x = F.col("embedding")
    most = F.lit(float(MOST)) / (scale * F.sqrt(F.greatest(F.size(x), F.lit(1))))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) > most))
    return (embeddings.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(odd, F.lit(False)))
            .select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vec")))


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.diff(column.offsets.to_numpy()))
    return np.split(flat, ends[:-1]) if len(ends) else []


def distinct_vectors(vectors: DataFrame, most: int) -> DataFrame:
    """Stored distinct vectors: vid (smallest id), ids (the ``most`` smallest
    ids), vec.  Each batch gathers its own ids first, so that a vector that a
    third of all rows share is a few numbers per batch."""

    def gather(batches):
        for batch in batches:
            groups: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column("vec_id").to_pylist(), _lists(batch.column("vec"))):
                groups.setdefault(v.astype("<i8").tobytes(), []).append(i)
            yield pa.RecordBatch.from_pydict({
                "vec": pa.array([np.frombuffer(k, "<i8") for k in groups], pa.list_(pa.int64())),
                "ids": pa.array([sorted(set(v))[:most] for v in groups.values()], pa.list_(pa.int64()))})

    part = vectors.mapInArrow(gather, "vec array<long>, ids array<long>")
    return stage_table(
        part.groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most).alias("ids"))
        .select(F.col("ids")[0].alias("vid"), "ids", "vec"), "vectors")


def _ranges(batches):
    for batch in batches:
        low, high = {}, {}
        for v in _lists(batch.column("vec")):
            n = len(v)
            low[n] = np.minimum(low[n], v) if n in low else v
            high[n] = np.maximum(high[n], v) if n in high else v
        at = [(n, j) for n in low for j in range(n)]
        yield pa.RecordBatch.from_pydict({
            "size": pa.array([n for n, _ in at], pa.int32()), "dim": pa.array([j for _, j in at], pa.int32()),
            "low": pa.array([int(low[n][j]) for n, j in at], pa.int64()),
            "high": pa.array([int(high[n][j]) for n, j in at], pa.int64())})


def cell_grid(vectors: DataFrame, cells: int = CELLS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each vector length: least value and cell width of each dimension,
    over all vectors."""
    rows = (vectors.select("vec").mapInArrow(_ranges, "size int, dim int, low long, high long")
            .groupBy("size", "dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    grid: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in rows:
        low, width = grid.setdefault(r["size"], (np.zeros(r["size"], np.int64), np.ones(r["size"], np.int64)))
        low[r["dim"]], width[r["dim"]] = r["low"], -(-(r["high"] - r["low"] + 1) // cells)
    return grid


def approximation_file(vectors: DataFrame, grid) -> DataFrame:
    """Stored vid, size, cells: one byte per dimension."""

    def code(batches):
        for batch in batches:
            vecs = _lists(batch.column("vec"))
            yield pa.RecordBatch.from_pydict({
                "vid": batch.column("vid"), "size": pa.array([len(v) for v in vecs], pa.int32()),
                "cells": pa.array([((v - grid[len(v)][0]) // grid[len(v)][1]).astype(np.uint8).tobytes() if len(v) else b""
                                   for v in vecs], pa.binary())})

    return stage_table(vectors.select("vid", "vec").mapInArrow(code, "vid long, size int, cells binary"), "cells")


def _scan(queries: list[tuple[int, np.ndarray]], grid, keep: int, rows: int = 2048):
    """A task that keeps, of the cells it scans, what may be among each query's
    ``keep`` best: upper bound at least the keep-th best lower bound so far."""
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    for qid, v in queries:
        by_size.setdefault(len(v), []).append((qid, v))

    def run(batches):
        held = {}
        for n, own in by_size.items():
            q = np.array([v for _, v in own], dtype=np.float64).reshape(len(own), n)
            held[n] = [np.array([i for i, _ in own]), np.maximum(q, 0).T, np.minimum(q, 0).T,
                       np.full((len(own), 0), -np.inf), [np.empty((3, 0))] * len(own)]
        for batch in batches:
            sizes, vids = batch.column("size").to_numpy(), batch.column("vid").to_numpy()
            for n in set(sizes.tolist()) & held.keys():
                at = np.flatnonzero(sizes == n)
                cells = batch.column("cells").take(pa.array(at))
                for s in range(0, len(at), rows):
                    here = at[s:s + rows]
                    data = b"".join(cells.slice(s, rows).to_pylist())
                    low, width = grid.get(n, (np.zeros(0, np.int64), np.ones(0, np.int64)))
                    lo = np.frombuffer(data, np.uint8).reshape(len(here), n) * width + low
                    hi = (lo + (width - 1)).astype(np.float64)
                    lo = lo.astype(np.float64)
                    _, up, down, best, kept = held[n]
                    lower, upper = (lo @ up + hi @ down).T, (hi @ up + lo @ down).T
                    # of large vectors the bounds are rounded: widen them by what that can be
                    off = np.maximum(abs(lo).max(initial=0), abs(hi).max(initial=0)) * (up - down).sum(axis=0) * 2.0**-44
                    off = np.where(off < 0.5, 0.0, off)[:, None]
                    lower, upper = lower - off, upper + off
                    best = np.concatenate([best, lower], axis=1)
                    if best.shape[1] > keep:
                        best = -np.partition(-best, keep - 1, axis=1)[:, :keep]
                    held[n][3] = best
                    least = best.min(axis=1) if best.shape[1] >= keep else np.full(len(best), -np.inf)
                    for j, i in _rows_of(upper >= least[:, None]):
                        kept[j] = np.concatenate([kept[j][:, kept[j][2] >= least[j]],
                                                  np.array([vids[here[i]], lower[j, i], upper[j, i]])], axis=1)
        out = [(int(qids[j]), kept[j][:, kept[j][2] >= (best[j].min() if best.shape[1] >= keep else -np.inf)])
               for qids, _, _, best, kept in held.values() for j in range(len(qids))]
        yield pa.RecordBatch.from_pydict({
            "query_id": pa.array(np.repeat([q for q, _ in out], [k.shape[1] for _, k in out]).astype(np.int64)),
            **{name: pa.array(np.concatenate([k[c] for _, k in out]).astype(np.int64) if out else [], pa.int64())
               for c, name in enumerate(("vid", "lower", "upper"))}})

    return run


def _rows_of(mask: np.ndarray):
    rows, columns = np.nonzero(mask)
    if len(rows):
        cut = np.flatnonzero(np.diff(rows)) + 1
        for r, c in zip(rows[np.append(0, cut)], np.split(columns, cut)):
            yield int(r), c


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``queries`` (vec_id, vec)
    the ``k`` best of ``vectors`` (vec_id, vec) by integer inner product but the
    query's own id, ties to the smaller id; all, if fewer.

    Vectors are compared with those of the same length only.  Rows with the same
    vector stand for their k + 1 smallest ids (no other can be a result); rows
    with the same id and vector count once.  The queries are taken in blocks,
    each against all vectors.  Scores are exact for vectors that ``quantised`` gives.
    """
    spark = vectors.sparkSession
    vectors = distinct_vectors(vectors, k + 1)
    grid = cell_grid(vectors)
    cells = approximation_file(vectors, grid)
    queries = stage_table(queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query")).distinct(), "queries")
    blocks = -(-queries.count() // BLOCK_QUERIES) or 1
    found = None
    for b in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect()  # about BLOCK_QUERIES rows
        scan = _scan([(r["query_id"], np.array(r["query"], dtype=np.int64)) for r in own], grid, k + 1)
        # stored before the next block is collected: the driver holds one at a time
        part = stage_table(cells.mapInArrow(scan, "query_id long, vid long, lower long, upper long"), "scanned")
        del own, scan
        found = part if found is None else found.unionByName(part)
    by_query = Window.partitionBy("query_id")
    lower_rank = F.row_number().over(by_query.orderBy(F.desc("lower"), "vid"))
    least = F.min(F.when(F.col("lower_rank") == k + 1, F.col("lower"))).over(by_query)
    candidates = stage_table(
        found.withColumn("lower_rank", lower_rank).withColumn("least", least)
        .filter(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
        .withColumn("order", F.row_number().over(by_query.orderBy(F.desc("upper"), "vid")))
        .select("query_id", "vid", "upper", "order"), "candidates")

    def read(rows: DataFrame) -> DataFrame:
        score = F.aggregate(F.zip_with("query", "vec", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return (rows.join(vectors, "vid").join(queries, "query_id").withColumn("score", score)
                .select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id"))

    first = stage_table(read(candidates.filter(F.col("order") <= k + 1)), "first")
    rank = F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))
    certain = first.withColumn("rank", rank).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    rest = (candidates.filter(F.col("order") > k + 1).join(certain, "query_id", "left")
            .filter(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))))
    return (first.unionByName(read(rest)).withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return exact_top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda t: t[1] * t[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
