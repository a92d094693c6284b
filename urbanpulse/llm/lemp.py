"""Hard-negative mining by inner product with LEMP-style coordinate pruning.

Vectors are packed into buckets of similar length; a bucket holds its unit
vectors' coordinates as sorted lists.  For an anchor and a bucket, the least
score that still matters, divided by both lengths, is a least cosine.  Each focus
coordinate of the anchor (its largest ones) then bounds the same coordinate of
any vector with that cosine: a range of its sorted list.  Vectors in the ranges
of all focus coordinates are candidates, and are verified by exact integer
inner products.

Anchors travel in packs, and each pack meets each bucket that can matter to it
once, in whichever task holds the bucket: no task or driver holds all anchors.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse.llm.common import table
from urbanpulse.session import stage_table

#: Rows and bytes of vectors in a bucket, and anchors in a pack.
BUCKET_ROWS = 2048
BUCKET_BYTES = 2 << 20
PACK_ROWS = 256
#: Coordinates of an anchor whose sorted lists are intersected.
FOCUS = 4
#: Components below this give exact 64-bit scores (up to 2,048 dimensions);
#: vectors with larger ones are compared by Python's integers, without pruning.
WIDE = float(1 << 26)
#: Relative slack of floating-point bounds.
SLACK = 1e-9
#: Scores are decimal(38, 0); what has over 36 digits counts as the greatest or least.
MOST = 10 ** 36 - 1
_POSITIVES = pa.list_(pa.list_(pa.decimal128(38, 0)))


def scaled(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, vec: floor(scale * component), whole numbers kept as
    doubles, of the rows that take part: none of vec_id, label, vector and its
    components is null, and all components are finite (after scaling too).
    Rows that share a vec_id count once: the one with the least label, then vector."""

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            flat = np.floor(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)
            ends = np.cumsum(np.diff(column.offsets.to_numpy()))
            odd = np.flatnonzero(~np.isfinite(flat))
            ok = np.ones(batch.num_rows, bool)
            ok[np.searchsorted(ends, odd, side="right")] = False
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat, pa.float64()))],
                names=["vec_id", "label", "vec"]).filter(pa.array(ok))

    whole = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
                              & ~F.exists("embedding", lambda v: v.isNull()))
    return (whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
            .mapInArrow(run, "vec_id long, label long, vec array<double>")
            .groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row")).select("vec_id", "row.label", "row.vec"))


def _matrix(data: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(rows, dims)


def packed(rows: DataFrame, order: list[str], apart: list[str], most: int, lists: bool, extra: str | None = None) -> DataFrame:
    """Stored packs of ``rows`` (vec_id, label, vec, [extra]): rows
    are sorted by size of the vector, ``apart``, ``order``, vec_id over all
    tasks, and cut into packs of at most ``most`` rows of one size, one width
    class and equal ``apart`` columns: pack (an id), dims, wide, label (of the
    first row), high (greatest length), rows, ids, labels, lengths, vecs, and with
    ``lists`` for each dimension the rows in ascending order of the unit vectors'
    coordinate."""
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    wide = F.exists("vec", lambda x: F.abs(x) >= WIDE)
    keys = ["dims", "wide", *apart, *order, "vec_id", "vec"]
    rows = (rows.withColumns({"dims": F.size("vec"), "wide": wide, "length": length})
            .repartitionByRange(*keys).sortWithinPartitions(*keys))

    def run(batches):
        part, made, key, held = TaskContext.get().partitionId() << 33, 0, None, []

        def cut():
            nonlocal made, held
            all_rows = pa.Table.from_batches(held).combine_chunks()
            column = lambda c: all_rows.column(c).to_numpy()
            n, dims, wide = all_rows.num_rows, key[0], key[1]
            vecs = all_rows.column("vec").combine_chunks().flatten().to_numpy().astype("<f8").reshape(n, dims)
            lengths = column("length").astype("<f8")
            unit = vecs / np.where(lengths > 0, lengths, 1.0)[:, None]
            orders = np.argsort(unit, axis=0, kind="stable").T.astype("<i2") if lists and not wide else np.zeros(0, "<i2")
            made, held = made + 1, []
            return pa.RecordBatch.from_arrays(
                [pa.array([part + made], pa.int64()), pa.array([dims], pa.int32()), pa.array([wide]),
                 pa.array([int(column("label")[0])], pa.int64()), pa.array([float(lengths.max())]), pa.array([n], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in (column("vec_id").astype("<i8").tobytes(), column("label").astype("<i8").tobytes(),
                                                        lengths.tobytes(), vecs.tobytes(), orders.tobytes())],
                 *[pa.array([all_rows.column(extra).to_pylist()], _POSITIVES) for _ in range(extra is not None)]],
                names=["pack", "dims", "wide", "label", "high", "rows", "ids", "labels", "lengths", "vecs", "orders",
                       *([extra] if extra else [])])

        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("dims", "wide", *apart)]))
            start = 0
            while start < len(keys):
                if held and (keys[start] != key or sum(h.num_rows for h in held) >= room):
                    yield cut()
                if not held:
                    key = keys[start]
                    room = max(1, min(most, BUCKET_BYTES // (8 * max(1, key[0]))))
                stop, free = start, room - sum(h.num_rows for h in held)
                while stop < len(keys) and keys[stop] == key and stop - start < free:
                    stop += 1
                held.append(batch.slice(start, stop - start))
                start = stop
        if held:
            yield cut()

    kind = ("pack long, dims int, wide boolean, label long, high double, rows int, ids binary, labels binary, "
            "lengths binary, vecs binary, orders binary" + (f", {extra} array<array<decimal(38,0)>>" if extra else ""))
    return stage_table(rows.mapInArrow(run, kind), "packs")


def _score(a: np.ndarray, b: np.ndarray, exact: bool) -> list[int] | np.ndarray:
    """Inner products of the rows of ``a`` with ``b``, exactly."""
    if exact:
        return a.astype(np.int64) @ b.astype(np.int64)
    other = [int(x) for x in b]
    return [max(-MOST, min(MOST, sum(int(x) * y for x, y in zip(row, other)))) for row in a]


def feasible(bucket: dict, unit: np.ndarray, least: float, length: float) -> np.ndarray:
    """Row numbers of the bucket whose coordinates allow a score of ``least``
    with an anchor of this unit vector and length."""
    rows, dims = bucket["unit"].shape
    if least <= 0 or not dims or length <= 0:
        return np.arange(rows) if least <= 0 else np.zeros(0, np.int64)
    cosine = least / (length * bucket["high"]) * (1 - SLACK) - SLACK if bucket["high"] > 0 else 2.0
    if cosine > 1:
        return np.zeros(0, np.int64)
    keep = bucket["lengths"] * (length * (1 + SLACK)) >= least
    if cosine <= 0:
        return np.flatnonzero(keep)
    angle = math.acos(min(1.0, cosine))
    for f in np.argpartition(-np.abs(unit), min(FOCUS, dims) - 1)[:FOCUS].tolist():
        own = math.acos(max(-1.0, min(1.0, float(unit[f]))))
        low = math.cos(min(math.pi, own + angle)) - SLACK
        high = math.cos(max(0.0, own - angle)) + SLACK
        order, values = bucket["orders"][f], bucket["sorted"][f]
        inside = np.zeros(rows, bool)
        inside[order[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]] = True
        keep &= inside
    return np.flatnonzero(keep)


def _bucket(row: dict) -> dict:
    n, dims = row["rows"], row["dims"]
    vecs, lengths = _matrix(row["vecs"], n, dims), np.frombuffer(row["lengths"], "<f8")
    out = {"vecs": vecs, "lengths": lengths, "high": row["high"], "ids": np.frombuffer(row["ids"], "<i8"),
           "labels": np.frombuffer(row["labels"], "<i8"), "wide": row["wide"],
           "positives": [[int(p) for p in ps] for ps in row.get("positives", ())]}
    if not row["wide"]:
        out["unit"] = vecs / np.where(lengths > 0, lengths, 1.0)[:, None]
        if row["orders"]:
            out["orders"] = np.frombuffer(row["orders"], "<i2").reshape(dims, n)
            out["sorted"] = np.take_along_axis(out["unit"].T, out["orders"].astype(np.int64), axis=1)
    return out


class Positives:
    """The k best of the anchor's own label."""

    def __init__(self, k: int):
        self.k = k

    def least(self, pack: dict) -> list[float]:
        """For each anchor a score that the k-th best can't be below: that of
        its k-th best in its own pack, whose rows are candidates too."""
        return [self._kth(pack, i) for i in range(len(pack["ids"]))]

    def _kth(self, pack: dict, i: int) -> float:
        if pack["wide"]:
            return -math.inf
        scores = _score(pack["vecs"], pack["vecs"][i], True)[pack["ids"] != pack["ids"][i]]
        return float(np.partition(scores, len(scores) - self.k)[len(scores) - self.k]) if len(scores) >= self.k else -math.inf

    def allowed(self, pack: dict, i: int, bucket: dict) -> np.ndarray:
        return (bucket["labels"] == pack["labels"][i]) & (bucket["ids"] != pack["ids"][i])

    def chosen(self, pack: dict, i: int, scores: list[int]) -> list[int]:
        return list(range(min(self.k, len(scores))))


class Bands:
    """For each of the anchor's positive scores, the k best of other labels with
    low * positive <= 100 * score <= high * positive."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high

    def _within(self, scores, positive: int) -> list[int]:
        return [j for j, s in enumerate(scores) if self.low * positive <= 100 * int(s) <= self.high * positive]

    def least(self, pack: dict) -> list[float]:
        """For each anchor the least of its bands' lower ends; a band whose k-th
        best in the anchor's own pack is known can't need less than that."""
        out = []
        for i, positives in enumerate(pack["positives"]):
            ends = []
            scores = None if pack["wide"] else np.sort(_score(pack["vecs"], pack["vecs"][i], True)[self.allowed(pack, i, pack)])[::-1]
            for p in positives:
                if self.low * p > self.high * p:
                    continue  # no score fits
                own = self._within(scores, p)[:self.k] if scores is not None else []
                ends.append(float(scores[own[-1]]) if len(own) == self.k else float(-(-self.low * p // 100)))
            out.append(min(ends, default=math.inf))
        return out

    def allowed(self, pack: dict, i: int, bucket: dict) -> np.ndarray:
        return (bucket["labels"] != pack["labels"][i]) & (bucket["ids"] != pack["ids"][i])

    def chosen(self, pack: dict, i: int, scores: list[int]) -> list[int]:
        return sorted({j for p in pack["positives"][i] for j in self._within(scores, p)[:self.k]})


def _search(pack: dict, least: list[float], bucket: dict, task):
    """(anchor, vec_id, score) of one pack and one bucket."""
    exact = not (pack["wide"] or bucket["wide"])
    for i, anchor in enumerate(pack["ids"].tolist()):
        if least[i] == math.inf:
            continue
        if exact:
            at = feasible(bucket, pack["unit"][i], least[i], float(pack["lengths"][i]))
        else:
            at = np.arange(len(bucket["ids"]))
        at = at[task.allowed(pack, i, bucket)[at]]
        if not len(at):
            continue
        scores, ids = _score(bucket["vecs"][at], pack["vecs"][i], exact), bucket["ids"][at]
        if exact:
            good = scores >= least[i] - 1
            scores, ids = scores[good], ids[good]
            first = np.lexsort((ids, -scores))
        else:
            first = sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))  # noqa: B023
        ordered = [int(scores[j]) for j in first]
        for j in task.chosen(pack, i, ordered):
            yield anchor, int(ids[first[j]]), ordered[j]


PACK = ("pack", "rows", "dims", "wide", "high", "ids", "labels", "lengths", "vecs", "orders")


def _with_least(packs: DataFrame, task) -> DataFrame:
    """``packs`` with least, for each anchor the score that a result can't be
    below (infinite: it has none), and least_of_all."""
    rest = packs.columns

    def run(batches):
        for batch in batches:
            least = []
            for row in batch.to_pylist():
                least.append(task.least(_bucket(row)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.list_(pa.float64())), pa.array([min(x) for x in least], pa.float64())],
                names=[*rest, "least", "least_of_all"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packs.schema)
    return stage_table(packs.mapInArrow(run, f"{kind}, least array<double>, least_of_all double"), "bounded_packs")


def _search_packs(packs: DataFrame, buckets: DataFrame, task, apart: list[str]) -> DataFrame:
    """Stored anchor_id, vec_id, score: what the task chooses for each anchor of
    the packs in each bucket that its bounds leave."""
    packs = _with_least(packs, task)
    own = [*PACK, "least", *[c for c in packs.columns if c == "positives"]]
    a = packs.select(*[F.col(c).alias(f"a_{c}") for c in own])
    b = buckets.select(*[F.col(c).alias(f"b_{c}") for c in PACK])
    # which pack must meet which bucket: from the packs' heads alone
    head = packs.select("dims", *apart, F.col("pack").alias("a_pack"), F.col("wide").alias("a_wide"),
                        F.col("high").alias("a_high"), "least_of_all")
    other = buckets.select("dims", *apart, F.col("pack").alias("b_pack"), F.col("wide").alias("b_wide"), F.col("high").alias("b_high"))
    matter = F.col("a_wide") | F.col("b_wide") | (F.col("least_of_all") <= F.col("a_high") * F.col("b_high") * (1 + SLACK))
    pairs = head.join(other, ["dims", *apart]).filter(matter & (F.col("least_of_all") < float("inf"))).select("a_pack", "b_pack")

    def run(batches):
        bucket = least = pack = None
        last = (None, None)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = (batch.column("a_pack")[i].as_py(), batch.column("b_pack")[i].as_py())
                side = lambda s, names: {c: batch.column(f"{s}_{c}")[i].as_py() for c in names}  # noqa: B023, E731
                if ids[1] != last[1]:
                    bucket = _bucket(side("b", PACK))
                if ids[0] != last[0]:
                    row = side("a", own)
                    pack, least = _bucket(row), row["least"]
                last = ids
                out = list(_search(pack, least, bucket, task))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                     pa.array([Decimal(x[2]) for x in out], pa.decimal128(38, 0))], names=["anchor_id", "vec_id", "score"])

    met = pairs.join(a, "a_pack").join(b, "b_pack").select(*a.columns, *b.columns)
    return stage_table(met.mapInArrow(run, "anchor_id long, vec_id long, score decimal(38,0)"), "met")


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    (decimal(38, 0)): for each row of ``anchors`` and each of its ``positives``
    best other rows of the same label, the ``negatives`` best rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score.
    ``vectors`` and ``anchors`` have vec_id (unique), label and vec (whole
    numbers as doubles); anchors are rows of the vectors.

    Ties go to the smaller vec_id.  Vectors are compared with those of the same
    size only; empty and zero vectors score 0.  Scores are exact up to 36 digits,
    larger ones count as 10^36 - 1.  An anchor without positives, or a positive
    without a negative in its band, has no row.
    """
    buckets = packed(vectors, ["length"], ["label"], BUCKET_ROWS, lists=True)
    by_label = packed(anchors, ["length"], ["label"], PACK_ROWS, lists=False)
    own = Window.partitionBy("anchor_id")
    best = lambda *also: own.orderBy(F.desc("score"), "vec_id") if not also else Window.partitionBy("anchor_id", *also).orderBy(
        F.desc("score"), "vec_id")
    found = _search_packs(by_label, buckets, Positives(positives), ["label"])
    chosen = stage_table(found.withColumn("rank", F.row_number().over(best())).filter(F.col("rank") <= positives)
                         .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = chosen.groupBy("anchor_id").agg(F.array_sort(F.collect_set("positive_score")).alias("positives"))
    banded = anchors.join(scores, anchors["vec_id"] == scores["anchor_id"]).drop("anchor_id")
    packs = packed(banded, ["length"], [], PACK_ROWS, lists=False, extra="positives")
    other = _search_packs(packs, buckets, Bands(negatives, low, high), [])
    hundred = F.col("score") * 100
    return (other.join(chosen, "anchor_id")
            .filter((F.col("positive_score") * low <= hundred) & (hundred <= F.col("positive_score") * high))
            .withColumn("rank", F.row_number().over(best("positive_id"))).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    shifted = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    vectors = stage_table(scaled(shifted), "vectors")
    found = hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))
    # a score beyond 64 bits is the greatest or least that the column holds
    whole = lambda c: F.greatest(F.least(F.col(c), F.lit(2 ** 63 - 1)), F.lit(-2 ** 63)).cast("long").alias(c)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", whole("positive_score"), whole("negative_score"))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda t: t[1] * t[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
