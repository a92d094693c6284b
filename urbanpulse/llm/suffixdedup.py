"""Suffix-array dedup: every byte covered by a 50-byte string that also starts
in a document with a smaller id.

The suffixes that are sorted are those that start at anchors (see ``anchors``):
any window of 50 bytes holds one, at the same place in all its copies.  First
the anchors whose gram stands in one text only are dropped: tasks send sorted,
delta-coded gram hashes, and learn which of theirs stand in other texts too.
The suffixes at the anchors that are left, each with the bytes before it that a
window may reach, are sorted into runs in the tasks that hold their texts,
front-coded, exchanged by gram, and merged by a loser tree that never compares
known prefixes again.  Neighbours in the merged order with the same bytes
before them have the same windows; the smallest document id of each window
decides.  The spans found go back to their documents.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanpulse.llm.anchors import GRAMS, K, LENGTH, anchors
from urbanpulse.llm.common import encoded, settled_id, slices, table
from urbanpulse.llm.lcpmerge import front_code, front_decode, merge
from urbanpulse.session import stage_table

BEFORE = LENGTH - K
#: Grams that stand in very many texts are known to all tasks instead of being sent.
HOT_MOST, HOT_LOCAL = 200_000, 4
RUN_GRAMS, RUN_TEXTS = 500_000, 60_000
RUN_SUFFIXES = 80_000
BUCKET_GRAMS, BUCKET_SUFFIXES = 1_000_000, 150_000
DENSITY = 2 / (GRAMS + 1)
#: Bits of a gram hash that are compared within a bucket; equal ones by chance
#: only cost a comparison of the suffixes.
BITS = np.uint64(36)


def _pack(*parts) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(parts, protocol=5))


def _unpack(data: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))  # noqa: S301 - written by _pack in this job


def _short(h: np.ndarray) -> np.ndarray:
    return h & ((np.uint64(1) << BITS) - np.uint64(1))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> BITS) % np.uint64(buckets)).astype(np.int64)


def _is_in(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), dtype=bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _text_runs(batches, columns):
    """Runs of texts (bytes) with their other columns, bounded by the expected
    number of anchors and the number of texts."""
    texts, rest, expected = [], [], 0.0
    for batch in batches:
        for part in slices(batch):
            for data, *other in zip(encoded(part), *(part.column(c).to_pylist() for c in columns)):
                if len(data) < LENGTH:
                    continue
                texts.append(data)
                rest.append(other)
                expected += len(data) * DENSITY
                if expected >= RUN_GRAMS or len(texts) >= RUN_TEXTS:
                    yield texts, rest
                    texts, rest, expected = [], [], 0.0
    if texts:
        yield texts, rest


def _text_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Gram hash and text of all anchors, once per text, sorted by hash."""
    owner, _, h = anchors(texts)
    order = np.lexsort((owner, h))
    owner, h = owner[order], h[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))) if len(h) else np.zeros(0, bool)
    return h[new], owner[new]


def hot_grams(docs: DataFrame, most: int = HOT_MOST) -> np.ndarray:
    """The ``most`` most frequent grams among those that HOT_LOCAL texts of some
    run hold, sorted.  Which grams these are has no influence on the result."""

    def count(batches):
        for texts, _ in _text_runs(batches, ()):
            h, _ = _text_grams(texts)
            u, n = np.unique(h, return_counts=True)
            keep = n >= HOT_LOCAL
            yield pa.RecordBatch.from_pydict({"h": pa.array(u[keep].view(np.int64)), "n": pa.array(n[keep])})

    found = (docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "h").limit(most).select("h").collect())
    return np.sort(np.array([r["h"] for r in found], dtype=np.int64).view(np.uint64))


def _gram_blocks(buckets: int, hot):
    """Per run and bucket: sorted short hashes (as differences), the text of
    each, and the texts' ids."""

    def run(batches):
        for texts, ids in _text_runs(batches, ("tid",)):
            tid = np.array([i for i, in ids], dtype=np.int64)
            _, first = np.unique(tid, return_index=True)  # equal texts once
            h, owner = _text_grams([texts[i] for i in first])
            tid = tid[first]
            keep = ~_is_in(h, hot.value)
            h, owner = h[keep], owner[keep]
            bucket, short = _bucket(h, buckets), _short(h)
            order = np.lexsort((short, bucket))
            bucket, short, owner = bucket[order], short[order], owner[order]
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                s = slice(cut[b], cut[b + 1])
                if cut[b] < cut[b + 1]:
                    texts_here, local = np.unique(owner[s], return_inverse=True)
                    step = np.diff(short[s], prepend=np.uint64(0))
                    wide = step.astype(np.uint32) if step.max() < 2**32 else step
                    planes = wide.view(np.uint8).reshape(len(wide), -1).T.copy()
                    out.append((b, _pack(planes, local.astype(np.uint16), tid[texts_here])))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in out], pa.int32()),
                                              "block": pa.array([p for _, p in out], pa.binary())})

    return run


def _repeated_grams(blocks: pa.Table) -> pa.Table:
    """tid, gram: the short hashes of each text that stand in another too."""
    hs, tids = [], []
    for data in blocks.column("block").to_pylist():
        planes, local, tid = _unpack(data)
        step = planes.T.copy().view(np.uint32 if len(planes) == 4 else np.uint64).ravel().astype(np.uint64)
        hs.append(np.cumsum(step, dtype=np.uint64))
        tids.append(tid[local])
    h, tid = np.concatenate(hs), np.concatenate(tids)
    order = np.argsort(h, kind="stable")
    h, tid = h[order], tid[order]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    several = np.minimum.reduceat(tid, start) != np.maximum.reduceat(tid, start)
    keep = np.repeat(several, np.diff(np.append(start, len(h))))
    return pa.table({"tid": pa.array(tid[keep]), "gram": pa.array(h[keep].view(np.int64))})


def _compress(batches):
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in slices(batch):
            column = part.schema.get_field_index("text")
            yield part.set_column(column, "text", pa.array([squeeze.compress(d) for d in encoded(part)], pa.binary()))


def _suffix_runs(buckets: int, hot):
    """Front-coded sorted runs of suffixes, per bucket.

    Equal suffixes with equal bytes before them are one entry that stands for
    its smallest document; the others' windows are all in that one, so their
    spans are known here and travel along."""

    def run(batches):
        import zstandard

        grow = zstandard.ZstdDecompressor()

        def flush(held):
            doc, tid, rows = [], [], []
            right_left, reach, back, owner, at, gram = [], [], [], [], [], []
            for d, t, data, chosen, h in held:
                pad = np.frombuffer(b"\0" * BEFORE + data + b"\0" * LENGTH, dtype=np.uint8)
                rows = np.lib.stride_tricks.sliding_window_view(pad, BEFORE + LENGTH)[chosen]
                right_left.append(np.concatenate([rows[:, BEFORE:], rows[:, :BEFORE]], axis=1))
                reach.append(np.minimum(LENGTH, len(data) - chosen))
                back.append(np.minimum(BEFORE, chosen))
                owner.append(np.full(len(chosen), len(doc)))
                at.append(chosen)
                gram.append(h)
                doc.append(d)
                tid.append(t)
            doc, tid = np.array(doc, dtype=np.int64), np.array(tid, dtype=np.int64)
            both, reach, back, owner, at, gram = map(np.concatenate, (right_left, reach, back, owner, at, gram))
            full = np.ascontiguousarray(np.concatenate(
                [both, reach[:, None].astype(np.uint8), back[:, None].astype(np.uint8)], axis=1))
            _, first, entry = np.unique(full.view(f"V{full.shape[1]}").ravel(), return_index=True, return_inverse=True)
            entry = entry.ravel()
            least = np.full(len(first), np.iinfo(np.int64).max)
            np.minimum.at(least, entry, doc[owner])
            own = doc[owner] == least[entry]
            # windows of the other documents' suffixes: all that fit into the text
            low, high = np.maximum(0, LENGTH - reach), np.minimum(BEFORE, back)
            known = ~own & (low <= high)
            bucket = _bucket(gram, buckets)
            entry_bucket = bucket[first]
            out = []
            place = np.full(len(first), -1)
            for b in np.unique(bucket).tolist():
                mine = np.flatnonzero(entry_bucket == b)  # in the order of the suffixes
                place[mine] = np.arange(len(mine))
                e = first[mine]
                shared, rest = front_code([bytes(full[i, :r]) for i, r in zip(e.tolist(), reach[e].tolist())])
                user = np.flatnonzero(own & (bucket == b))
                done = np.flatnonzero(known & (bucket == b))
                names, local = np.unique(np.concatenate([owner[user], owner[done]]), return_inverse=True)
                out.append((b, _pack(
                    shared, reach[e].astype(np.uint8), rest, full[e, LENGTH:LENGTH + BEFORE], back[e].astype(np.uint8),
                    doc[names], tid[names], place[entry[user]].astype(np.uint32), local[:len(user)].astype(np.uint32),
                    at[user], local[len(user):].astype(np.uint32), at[done] - high[done], at[done] - low[done] + LENGTH)))
            return pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in out], pa.int32()),
                                               "block": pa.array([p for _, p in out], pa.binary())})

        held, n = [], 0
        for batch in batches:
            for part in slices(batch):
                names = ("doc_id", "tid", "text", "grams")
                for d, t, z, grams in zip(*(part.column(c).to_pylist() for c in names)):
                    data = grow.decompress(z)
                    _, at, h = anchors([data])
                    sent = np.unique(np.array(grams or [], dtype=np.uint64))
                    keep = _is_in(_short(h), sent) | _is_in(h, hot.value)
                    if keep.any():
                        held.append((d, t, data, at[keep], h[keep]))
                        n += int(keep.sum())
                    if n >= RUN_SUFFIXES:
                        yield flush(held)
                        held, n = [], 0
        if held:
            yield flush(held)

    return run


def window_spans(order_lcp: np.ndarray, before: np.ndarray, reach: np.ndarray, back: np.ndarray,
                 doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in merged order: the least and the greatest number of bytes
    before the suffix at which a window starts that also stands in a smaller
    document (1, 0 if none does).

    Windows that start o bytes before are equal if the suffixes share
    LENGTH - o bytes and the o bytes before them are equal (by a 64-bit hash,
    within the suffixes that share so much)."""
    n = len(doc)
    low, high = np.full(n, LENGTH), np.full(n, -1)
    new = order_lcp < K
    group = np.cumsum(new)
    several = np.bincount(group, minlength=group[-1] + 1 if n else 1)[group] > 1
    pick = np.flatnonzero(several)
    if not len(pick):
        return np.ones(n, np.int64), np.zeros(n, np.int64)
    past = np.zeros(len(pick), dtype=np.uint64)
    value = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for o in range(BEFORE + 1):
        if o:
            past = past * factor + value[before[pick, BEFORE - o]]
        same = np.cumsum(order_lcp < LENGTH - o)[pick].astype(np.uint64)
        fits = (o <= back[pick]) & (LENGTH - o <= reach[pick])
        if not fits.any():
            continue
        p = pick[fits]
        key = (past[fits] ^ (past[fits] >> np.uint64(31))) * factor + same[fits] * np.uint64(0xC2B2AE3D27D4EB4F)
        sort = np.lexsort((past[fits], key))
        k, h, s = key[sort], past[fits][sort], same[fits][sort]
        start = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | (s[1:] != s[:-1]))))
        least = np.repeat(np.minimum.reduceat(doc[p[sort]], start), np.diff(np.append(start, len(sort))))
        hit = p[sort][least < doc[p[sort]]]
        low[hit] = np.minimum(low[hit], o)
        high[hit] = np.maximum(high[hit], o)
    none = high < 0
    low[none], high[none] = 1, 0
    return low, high


def _merged_spans(blocks: pa.Table) -> pa.Table:
    """doc_id, tid, span (see ``span_code``) of a bucket's runs."""
    runs, shared, before, back, reach, entry_doc, users, out = [], [], [], [], [], [], [], []
    for data in blocks.column("block").to_pylist():
        (lcp, size, rest, left, left_size, doc, tid, entry, who, at, done, start, stop) = _unpack(data)
        runs.append(front_decode(lcp, size, rest))
        shared.append(lcp.tolist())
        before.append(left)
        back.append(left_size.astype(np.int64))
        reach.append(size.astype(np.int64))
        owner = np.zeros(len(size), dtype=np.int64)
        owner[entry] = doc[who]
        entry_doc.append(owner)
        users.append((entry, doc[who], tid[who], at))
        out.append((doc[done], tid[done], start, stop))
    run, at, lcp = merge(runs, shared)
    base = np.cumsum([0] + [len(r) for r in runs])
    order = base[run] + at
    low, high = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    before, back, reach, entry_doc = map(np.concatenate, (before, back, reach, entry_doc))
    low[order], high[order] = window_spans(lcp, before[order], reach[order], back[order], entry_doc[order])
    for r, (entry, doc, tid, pos) in enumerate(users):
        a, b = low[base[r] + entry], high[base[r] + entry]
        hit = a <= b
        out.append((doc[hit], tid[hit], (pos - b)[hit], (pos - a)[hit] + LENGTH))
    doc, tid, start, stop = (np.concatenate(c) for c in zip(*out))
    return pa.table({"doc_id": pa.array(doc), "tid": pa.array(tid), "span": pa.array(span_code(start, stop))})


def span_code(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """One number per span; the windows that hold one anchor cover under 256 bytes."""
    return start.astype(np.int64) << 8 | (stop - start)


def span_ends(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = code >> 8
    return start, start + (code & 255)


def joined(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of touching or overlapping spans."""
    order = np.argsort(start, kind="stable")
    start, upto = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate(([True], start[1:] > upto[:-1])) if len(start) else np.zeros(0, bool)
    return start[new], upto[np.append(np.flatnonzero(new)[1:] - 1, len(upto) - 1)] if len(start) else upto


def _cut(batches):
    """Statistics and remaining bytes of every document."""
    import zstandard

    grow = zstandard.ZstdDecompressor()
    for batch in batches:
        for part in slices(batch):
            size, removed, count, digest, kept = [], [], [], [], []
            for z, copy, spans in zip(*(part.column(c).to_pylist() for c in ("text", "is_copy", "spans"))):
                data = grow.decompress(z)
                if copy and len(data) >= LENGTH:
                    start, stop = np.array([0]), np.array([len(data)])
                elif spans:
                    start, stop = joined(*span_ends(np.array(spans, dtype=np.int64)))
                else:
                    start = stop = np.zeros(0, np.int64)
                edges = [0, *(x for ab in zip(start.tolist(), stop.tolist()) for x in ab), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                size.append(len(data))
                removed.append(len(data) - len(rest))
                count.append(len(start))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(kept, pa.large_string()).cast(pa.string())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but the text), n_bytes,
    n_removed, n_spans, kept_sha256 and kept (the remaining text; a character
    that was cut is dropped) for every row of ``docs`` (doc_id, text, ...).

    Null texts are empty; texts under 50 bytes lose nothing and take nothing.
    Rows with equal texts: those whose doc_id isn't the smallest lose all of
    it.  Rows with the same doc_id don't take from each other.  Rows with a null
    doc_id are left whole and aren't compared.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    others = [c for c in docs.columns if c != "text"]
    docs = docs.select(F.struct(*others).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.octet_length(text).cast("long").alias("size"), text.alias("text"))
    comparable = F.col("doc_id").isNotNull() & (F.col("size") >= LENGTH)
    docs = docs.withColumn("tid", settled_id(docs.filter(comparable), "text"))
    with_id = docs.filter(comparable)
    keys = stage_table(with_id.select("doc_id", "tid", "size"), "keys")
    texts = stage_table(keys.groupBy("tid").agg(F.min("doc_id").alias("first"), F.max("size").alias("size")), "texts")
    volume = (texts.agg(F.sum("size")).first()[0] or 0) * DENSITY
    hot = spark.sparkContext.broadcast(hot_grams(with_id))

    buckets = int(volume // BUCKET_GRAMS) + 1
    repeated = (with_id.select("tid", "text").mapInArrow(_gram_blocks(buckets, hot), "bucket int, block binary")
                .groupBy("bucket").applyInArrow(_repeated_grams, "tid long, gram long")
                .groupBy("tid").agg(F.collect_list("gram").alias("grams")))
    wanted = texts.join(repeated, "tid", "left").select(F.col("first").alias("doc_id"), "tid", "grams")

    buckets = int(volume // (4 * BUCKET_SUFFIXES)) + 1
    spans = (with_id.select("doc_id", "tid", "text").mapInArrow(_compress, "doc_id long, tid long, text binary")
             .join(wanted, ["doc_id", "tid"])
             .mapInArrow(_suffix_runs(buckets, hot), "bucket int, block binary")
             .groupBy("bucket").applyInArrow(_merged_spans, "doc_id long, tid long, span long")
             .groupBy("doc_id", "tid").agg(F.collect_list("span").alias("spans")))
    found = (keys.select("doc_id", "tid").distinct().join(texts.select("tid", "first"), "tid")
             .select("doc_id", "tid", (F.col("doc_id") > F.col("first")).alias("is_copy"))
             .join(stage_table(spans, "spans"), ["doc_id", "tid"], "left"))

    row = T.StructType([docs.schema["row"]])
    whole = (docs.select("row", "doc_id", "tid", "text")
             .mapInArrow(_compress, row.add("doc_id", "long").add("tid", "long").add("text", "binary"))
             .join(found, ["doc_id", "tid"], "left"))
    out = T.StructType([docs.schema["row"]])
    for name in ("n_bytes", "n_removed", "n_spans"):
        out = out.add(name, "long")
    return whole.select("row", "text", "is_copy", "spans").mapInArrow(_cut, out.add("kept_sha256", "string").add("kept", "string"))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
