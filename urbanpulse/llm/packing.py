"""Best-fit packing of token pieces, by hierarchical residual packing.

The pieces are dealt out evenly, wherever they are stored.  Every partition packs
its own pieces best fit, largest first, and gives out the bins that are nearly
full.  The underfull bins become the items of the next round: they meet in
fewer groups, which pack them best fit again, until one group is left or a round
joins hardly any bins.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import slices, table
from urbanpulse.session import stage_table

LENGTH = 1024
END = 2
SPECIAL = "<|endoftext|>"


class Ids:
    """Token ids of whole texts as packed little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.code = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})

    def encode(self, text: str) -> bytes:
        return self.code.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() if text else b""


@lru_cache(maxsize=1)
def _ids(path: str | None) -> Ids:
    import public_tokenizers as public

    return Ids(path or public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def cut(total: int, length: int) -> list[tuple[int, int]]:
    """start, length of the pieces: whole ones of ``length``, the first shorter."""
    first = (total - 1) % length + 1
    return [(0, first)] + [(s, length) for s in range(first, total, length)]


def token_pieces(docs: DataFrame, *, length: int = LENGTH, ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every row's pieces.  ``ranks``
    is a tiktoken rank file that every executor has (default: the installed
    byte_bpe_50k).  A null or empty text is one piece with the end id only."""
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches):
        ids = _ids(ranks)
        for batch in batches:
            for part in slices(batch):
                owner, out = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    data = ids.encode(text) + end
                    for k, (start, size) in enumerate(cut(len(data) // 4, length)):
                        owner.append(i)
                        out.append((k, start, size, zlib.crc32(data[4 * start:4 * (start + size)])))
                piece, start, size, crc = zip(*out)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(pa.array(owner, pa.int64())),
                    "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """bin and offset of each item: largest first (ties by place), each into the
    bin with the least room that still holds it.  Bits of ``open_rooms`` mark
    the rooms that some bin has."""
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            room, own, n = capacity, n, n + 1
        bins[i], offsets[i] = own, capacity - room
        left = room - size
        if left:
            if not rooms[left]:
                open_rooms |= 1 << left
            rooms[left].append(own)
    return bins, offsets


def _pack_partition(size: str, capacity: int, block: int, level: int):
    """A task that adds ``bin`` and ``offset`` to its rows.  It holds at most
    about ``block`` rows at a time; bin numbers hold the round (``level``), the
    partition and a count, so that no two bins share one."""

    def run(batches):
        base, used = level << 57 | TaskContext.get().partitionId() << 33, 0

        def flush(held):
            nonlocal used
            t = pa.Table.from_batches(held)
            bins, offsets = best_fit(t.column(size).to_numpy(), capacity)
            t = t.append_column("bin", pa.array(base + used + bins)).append_column("offset", pa.array(offsets))
            used += int(bins.max()) + 1
            return t.to_batches()

        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= block:
                yield from flush(held)
                held, rows = [], 0
        if held:
            yield from flush(held)

    return run


def pack(pieces: DataFrame, *, length: int = LENGTH, nearly_full: float = 0.985, block: int = 500_000,
         merge_items: int = 100_000, least_gain: float = 0.01) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; their ``length`` is 1 to
    ``length``.

    The first round deals the stored pieces round robin to groups of about
    ``merge_items``, so that each group gets its share of every file: pieces
    of one size that lie together don't end as bins of one size.  Bins filled to
    ``nearly_full`` are given out after it.  Later rounds deal the rest to groups
    of about ``merge_items`` bins (by a hash); they end after the round with one
    group, or when a round saves under ``least_gain`` of its bins.  Every piece is
    placed once; an empty table gives an empty one.
    """
    names = pieces.columns
    pieces = stage_table(pieces, "pieces")
    leaf = stage_table(pieces.repartition(max(1, -(-pieces.count() // merge_items))).mapInArrow(
        _pack_partition("length", length, block, 0),
        ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", bin long, offset long"), "packed")
    fill = leaf.groupBy("bin").agg(F.sum("length").alias("fill"))
    open_bins = stage_table(fill.filter(F.col("fill") < nearly_full * length), "underfull")
    moved = None  # bin of the first round -> its bin now, shift there
    n, level = open_bins.count(), 0
    while n > 1:
        level += 1
        groups = max(1, -(-n // merge_items))
        step = stage_table(
            open_bins.repartition(groups, "bin").withColumnRenamed("bin", "was")
            .mapInArrow(_pack_partition("fill", length, block, level),
                        "was long, fill long, bin long, offset long"), "merged")
        if moved is None:
            moved = step.select(F.col("was").alias("first"), "bin", "offset")
        else:
            moved = (moved.withColumnRenamed("bin", "was").withColumnRenamed("offset", "shift")
                     .join(step.select("was", "bin", "offset"), "was", "left")
                     .select("first", F.coalesce("bin", "was").alias("bin"),
                             (F.col("shift") + F.coalesce("offset", F.lit(0))).alias("offset")))
        merged = step.groupBy("bin").agg(F.sum("fill").alias("fill"))
        if groups == 1 or n - merged.count() < least_gain * n:
            break
        open_bins = stage_table(merged.filter(F.col("fill") < nearly_full * length), "underfull")
        n = open_bins.count()
    if moved is None:
        return leaf.select(*names, F.col("bin").alias("sequence_id"), "offset")
    moved = moved.select("first", F.col("bin").alias("now"), F.col("offset").alias("shift"))
    return (leaf.join(moved, leaf["bin"] == moved["first"], "left")
            .select(*names, F.coalesce("now", "bin").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Token pieces of all rows, packed.  Null texts are empty; repeated rows
    are packed one by one; other columns are not read."""
    return pack(token_pieces(docs), **options)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
