"""N-gram Jaccard join by grouped prefix join.

A document's shingle hashes are put in one order that all documents share:
shingles that many documents hold come last, else by hash.  Two documents with
a Jaccard similarity of t or more share a shingle among their first
n - ceil(t n) + 1.  Documents with the same number of shingles and the same
prefix are one group; prefixes are joined group by group, pairs of groups are
filtered by size and by the greatest overlap that their shared prefix shingles
leave possible, and the rest is expanded into members.  Pairs of these go on if
their signatures, a bit or two for each shingle, leave the similarity possible, and are
verified on the whole sets.  Key groups of many documents are first tied to one leader each; what is
in one component then needs no further comparison to know the components.

The links themselves are counted after that: both ends of a link are in one
component, so the groups inside each component are joined once more by their
prefixes, in blocks of bounded size, and the members of the pairs of groups that
are left are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse.llm.common import encoded, release, slices, stored, table
from urbanpulse.llm.components import components
from urbanpulse.llm.shingles import mix, shingle_set
from urbanpulse.session import scratch_table

SHINGLE = 5
PERCENT = 75
#: Shingles that are put last in the order; more would do no harm but be broadcast.
HOT_MOST = 200_000
HOT_LOCAL = 4
HOT_SHINGLES = 1_000_000
#: A key that more groups share is tied to a leader before its pairs are listed.
SMALL_KEY = 32
#: Bitmaps of 4 KB that tell which texts are needed, at most: 64 million bits.
NEED_MAPS = 2_048
#: Shingles that one task compares with each other (or with as many others).
LINK_SHINGLES = 400_000
#: Sets that one task compares with each other (or with as many others).
LINK_NODES = 2_048


def _least(n: int, percent: int) -> int:
    """ceil(percent n / 100)."""
    return (percent * n + 99) // 100


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _digest(hashes: np.ndarray, salt: int) -> np.uint64:
    with np.errstate(over="ignore"):
        return mix(np.array([mix(hashes ^ np.uint64(salt)).sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64))[0]


def prefix(hashes: np.ndarray, hot: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first n - ceil(t n) + 1 of a sorted set, hot ones last."""
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)] == hashes
        hashes = np.concatenate([hashes[~is_hot], hashes[is_hot]])
    return hashes[:len(hashes) - _least(len(hashes), percent) + 1]


def signature(hashes: np.ndarray) -> bytes:
    """Parities: bit i is set if an odd number of the hashes end in i.  There
    are as many bits as hashes, up to the next power of two."""
    width = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(width - 1)).view(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def may_link(x: bytes, y: bytes, n: int, m: int, percent: int = PERCENT) -> bool:
    """Whether sets of n and m hashes with these signatures can be similar
    enough: what both hold cancels out, so that every bit in which they differ,
    the longer one folded to the other's width, is a hash that one set has alone."""
    if len(x) < len(y):
        x, y = y, x
    a, bits = int.from_bytes(x, "little"), 8 * len(x)
    while bits > 8 * len(y):
        bits //= 2
        a = (a >> bits) ^ (a & ((1 << bits) - 1))
    most = (n + m - (a ^ int.from_bytes(y, "little")).bit_count()) // 2
    return (100 + percent) * most >= percent * (n + m)


def hot_shingles(docs: DataFrame, size: int = SHINGLE, most: int = HOT_MOST) -> np.ndarray:
    """The ``most`` most frequent of the shingles that are frequent somewhere:
    every task counts all its shingles, in runs of about HOT_SHINGLES, and
    reports those that HOT_LOCAL documents of a run hold.  Any order of the
    shingles gives the same links; this one keeps key groups small."""

    def count(batches):
        def flush(sets):
            u, n = np.unique(np.concatenate(sets), return_counts=True)
            keep = n >= HOT_LOCAL
            return pa.RecordBatch.from_pydict({"h": pa.array(_signed(u[keep])), "n": pa.array(n[keep])})

        held, rows = [], 0
        for batch in batches:
            for part in slices(batch):
                for data in encoded(part):
                    held.append(shingle_set(data, size))
                    rows += len(held[-1])
                    if rows >= HOT_SHINGLES:
                        yield flush(held)
                        held, rows = [], 0
        if held:
            yield flush(held)

    found = (docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "h").limit(most).select("h").collect())
    return np.sort(np.array([r["h"] for r in found], dtype=np.int64).view(np.uint64))


def _digests(docs: DataFrame, hot, size: int, percent: int) -> DataFrame:
    """Stored doc_id, n, node (digest of the set), gid (digest of size and
    prefix), sig (signature) of every row; n 0 has none of the last three."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                n, node, gid, sig = [], [], [], []
                for data in encoded(part):
                    s = shingle_set(data, size)
                    n.append(len(s))
                    node.append(int(_digest(s, 1).view(np.int64)) if len(s) else None)
                    gid.append(int(_digest(np.append(prefix(s, hot.value, percent), np.uint64(len(s))), 2).view(np.int64))
                               if len(s) else None)
                    sig.append(signature(s) if len(s) else None)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n": pa.array(n, pa.int64()),
                                                  "node": pa.array(node, pa.int64()), "gid": pa.array(gid, pa.int64()),
                                                  "sig": pa.array(sig, pa.binary())})

    return stored(docs.mapInArrow(run, "doc_id long, n long, node long, gid long, sig binary"), "digests")


def _entries(docs: DataFrame, hot, size: int, percent: int) -> DataFrame:
    """key, gid: prefix shingles, once for each group that a task meets."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                keys, gids = [], []
                for data in encoded(part):
                    s = shingle_set(data, size)
                    if not len(s):
                        continue
                    p = prefix(s, hot.value, percent)
                    gid = int(_digest(np.append(p, np.uint64(len(s))), 2).view(np.int64))
                    if gid in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(gid)
                    keys.append(p)
                    gids.append(gid)
                if keys:
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(_signed(np.concatenate(keys))),
                        "gid": pa.array(np.repeat(np.array(gids, np.int64), [len(k) for k in keys]))})

    return docs.select("text").mapInArrow(run, "key long, gid long")


def _compatible(percent: int, a: str = "n_a", b: str = "n_b") -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _needed(percent: int) -> str:
    """SQL for the fewest shared prefix shingles that leave the similarity
    possible: all common shingles up to the end of the shorter-reaching prefix
    are among them, and that document has ceil(t n) - 1 others."""
    return f"""greatest(1, ({percent} * (n_a + n_b) + {100 + percent} - 1) div {100 + percent} + 1
                 - greatest(({percent} * n_a + 99) div 100, ({percent} * n_b + 99) div 100))"""


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Stored a, b, doc_id_a, doc_id_b (documents with these sets): the ``pairs``
    of nodes whose signatures leave the similarity possible."""

    def check(batches):
        for batch in batches:
            keep = [may_link(*row, percent) for row in zip(*(batch.column(c).to_pylist() for c in ("sig_a", "sig_b", "n_a", "n_b")))]
            yield batch.select(["a", "b", "doc_id_a", "doc_id_b"]).filter(pa.array(keep, pa.bool_()))

    for x in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(x), F.col("rep").alias(f"doc_id_{x}"), F.col("n").alias(f"n_{x}"),
                                        F.col("sig").alias(f"sig_{x}")), x)
    return stored(pairs.select("a", "b", "doc_id_a", "doc_id_b", "n_a", "n_b", "sig_a", "sig_b")
                       .mapInArrow(check, "a long, b long, doc_id_a long, doc_id_b long"), "possible")


def _among(docs: DataFrame, need: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``need``, and some others: ids are
    looked up by a hash in bitmaps of about 128 bits an id, NEED_MAPS at most, so
    that a join with ``need`` moves few texts that it then drops."""
    bits = 32_768  # of one bitmap
    maps = min(NEED_MAPS, need.count() * 128 // bits + 1)
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(maps * bits)) + 1  # Spark's bitmaps count from 1
    known = (need.groupBy(F.bitmap_bucket_number(bit).alias("__at"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__map")))
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("__map", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.withColumn("__at", F.bitmap_bucket_number(bit)).join(F.broadcast(known), "__at")
    return found.filter(F.getbit(byte, (place % 8).cast("int")) == 1).select(docs.columns)


def _sets(docs: DataFrame, need: DataFrame, size: int) -> str:
    """Name of a table doc_id, node, set (sorted hashes): whole sets of the
    needed nodes (node, doc_id), made again from the texts of these documents.
    It is bucketed by doc_id, as the join that makes it deals it out, so that
    the joins of its reader leave it where it is; its caller drops it.  (A node
    may stand in it twice, if a row is repeated.)"""
    need = stored(need, "need")

    def sets(batches):
        for batch in batches:
            for part in slices(batch):
                node, out = part.column("node").to_pylist(), []
                for i, data in enumerate(encoded(part)):
                    s = shingle_set(data, size)
                    out.append(s.tobytes() if len(s) and int(_digest(s, 1).view(np.int64)) == node[i] else None)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "node": part.column("node"),
                                                  "set": pa.array(out, pa.binary())})

    name, buckets = scratch_table(docs.sparkSession, "sets"), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (_among(docs, need).join(need.hint("merge"), "doc_id").select("doc_id", "node", "text").mapInArrow(sets, "doc_id long, node long, set binary")
     .filter("set is not null").write.bucketBy(buckets, "doc_id").sortBy("doc_id").saveAsTable(name))
    release(docs.sparkSession)
    return name


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Stored links a, b: the ``pairs`` of nodes whose whole sets are similar
    enough.  Sets are made of those only whose signatures leave it possible.
    The joins are by doc_id, the sets' bucket; two nodes may share one (an id
    with two texts), so the node is compared with the set's below."""
    pairs = _possible(pairs, nodes, percent)
    if pairs.isEmpty():
        return pairs.select("a", "b")

    def check(batches):
        for batch in batches:
            for part in slices(batch, "set_a"):
                keep = []
                own = pc.and_(pc.equal(part.column("a"), part.column("node_a")),
                              pc.equal(part.column("b"), part.column("node_b"))).to_pylist()
                for x, y, same in zip(part.column("set_a"), part.column("set_b"), own):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(np.intersect1d(x, y, assume_unique=True)) if same else 0
                    keep.append(same and 100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    need = (pairs.select(F.col("a").alias("node"), F.col("doc_id_a").alias("doc_id"))
            .union(pairs.select("b", "doc_id_b")).distinct())
    name = _sets(docs, need, size)
    sets = pairs.sparkSession.table(name)

    def side(x: str) -> DataFrame:
        return sets.select(*[F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "node", "set")])

    try:
        return stored(pairs.join(side("a"), "doc_id_a").join(side("b"), "doc_id_b")
                           .select("a", "b", "node_a", "node_b", "set_a", "set_b").mapInArrow(check, "a long, b long"), "verified")
    finally:
        pairs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _common(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``sets`` (rows) shares with each of ``others``:
    both sides are multiplied as 0/1 matrices, some columns at a time."""
    n, m = len(sets), len(others)
    found, at, times = np.unique(np.concatenate([*sets, *others]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n + m), [len(x) for x in (*sets, *others)])
    at, row = at[times[at] > 1], row[times[at] > 1]  # a value in one set only is common to none
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    at = np.cumsum(np.diff(at, prepend=at[:1]) > 0)
    both, wide = np.zeros((n, m), dtype=np.int64), 2048
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, wide):
        a, b = np.searchsorted(at, (start, start + wide))
        hold = np.zeros((n + m, wide), dtype=np.float32)
        hold[row[a:b], at[a:b] - start] = 1
        both += (hold[:n] @ hold[n:].T).astype(np.int64)
    return both


def _similar(sets: list[np.ndarray], gids: np.ndarray, others: list[np.ndarray], other_gids: np.ndarray,
             hot: np.ndarray, percent: int) -> np.ndarray:
    """Which of ``sets`` (rows) are similar enough to which of ``others``, as a
    grouped prefix join: sets of one gid are one group; pairs of groups go on
    if their sizes and their shared prefix shingles allow it; those are expanded
    into members, whose whole sets decide."""
    sides = []
    for own, gid in ((sets, gids), (others, other_gids)):
        _, first, of = np.unique(gid, return_index=True, return_inverse=True)
        sides.append((np.array([len(own[i]) for i in first], np.int64), [prefix(own[i], hot, percent) for i in first], of))
    (n, prefixes, of), (m, other_prefixes, other_of) = sides
    n, m = n[:, None], m[None, :]
    least = (percent * (n + m) + 99 + percent) // (100 + percent)
    needed = np.maximum(1, least + 1 - np.maximum((percent * n + 99) // 100, (percent * m + 99) // 100))
    may = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (_common(prefixes, other_prefixes) >= needed)
    may = may[np.ix_(of, other_of)]
    i, j = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    out = np.zeros(may.shape, dtype=bool)
    if 64 * int(may.sum()) < len(i) * len(j):  # few members: one by one
        for x, y in zip(*np.nonzero(may)):
            both = len(np.intersect1d(sets[x], others[y], assume_unique=True))
            out[x, y] = 100 * both >= percent * (len(sets[x]) + len(others[y]) - both)
    elif len(i):
        both = _common([sets[x] for x in i], [others[y] for y in j])
        whole = np.array([len(sets[x]) for x in i])[:, None] + np.array([len(others[y]) for y in j])[None, :] - both
        out[np.ix_(i, j)] = may[np.ix_(i, j)] & (100 * both >= percent * whole)
    return out


def _linked_nodes(owned: DataFrame, sets: DataFrame, hot, percent: int, pairs: bool = False) -> DataFrame:
    """node, n_links: rows of other nodes that each node of ``owned`` (node, gid,
    n, copies, component) links with; with ``pairs``, the links a < b themselves.

    Both ends of a link are in one component: the nodes of each are joined by
    their groups' prefixes (``_similar``).  A component of many shingles or nodes
    is dealt into chunks by a hash of the node, and each two chunks are one task's
    work; small components share tasks.  ``sets`` holds every node that has a
    link."""
    whole = owned.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("total")).filter("k > 1")
    chunks = F.ceil(F.greatest(F.col("total") / LINK_SHINGLES, F.col("k") / LINK_NODES)).cast("int")
    whole = whole.withColumn("chunks", F.least(chunks, F.col("k").cast("int")))
    small = whole.filter("chunks = 1").agg(F.sum(F.greatest("total", F.col("k") * F.col("k")))).first()[0] or 0
    buckets = max(1, -(-small // LINK_SHINGLES))
    own = F.when(F.col("chunks") > 1, F.pmod(F.xxhash64("node"), F.col("chunks"))).otherwise(0).cast("int")
    dealt = (sets.join(owned.select("node", "gid", "copies", "component"), "node").join(whole.drop("k", "total"), "component")
             .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("node", "gid", "copies", "component", "own", "set", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"),
                     F.when(F.col("chunks") > 1, F.col("component"))
                     .otherwise(F.pmod(F.xxhash64("component"), F.lit(buckets))).alias("bucket"),
                     (F.col("chunks") > 1).alias("split")))

    def count(group: pa.Table) -> pa.Table:
        by: dict[int, dict] = {}
        for node, gid, copies, component, own, data, low in zip(*(group.column(c).to_pylist() for c in (
                "node", "gid", "copies", "component", "own", "set", "low"))):
            # a node may come twice (see _sets)
            by.setdefault(component, {})[node] = gid, copies, own == low, np.frombuffer(data, np.uint64)
        across = group.column("low")[0].as_py() != group.column("high")[0].as_py()
        a, b, n = [], [], []
        for members in by.values():
            left = [x for x, (_, _, first, _) in members.items() if first]
            right = [x for x, (_, _, first, _) in members.items() if not first] if across else left
            if not left or not right:
                continue
            gids = [np.array([members[x][0] for x in side], np.int64) for side in (left, right)]
            near = _similar([members[x][3] for x in left], gids[0], [members[x][3] for x in right], gids[1],
                            hot.value, percent)
            if not across:
                np.fill_diagonal(near, False)
            left, right = np.array(left, np.int64), np.array(right, np.int64)
            if pairs:
                i, j = np.nonzero(near if across else np.triu(near))
                a.append(np.minimum(left[i], right[j]))
                b.append(np.maximum(left[i], right[j]))
                continue
            weight = [np.array([members[x][1] for x in side.tolist()], np.int64) for side in (left, right)]
            a.append(left)
            n.append(near @ weight[1])
            if across:
                a.append(right)
                n.append(near.T @ weight[0])
        last = ("b", b) if pairs else ("n", n)
        return pa.table({name: np.concatenate([np.zeros(0, np.int64), *x])
                         for name, x in ((("a" if pairs else "node"), a), last)})

    found = dealt.groupBy("split", "bucket", "low", "high").applyInArrow(count, "a long, b long" if pairs else "node long, n long")
    return found if pairs else found.groupBy("node").agg(F.sum("n").alias("n_links"))


def jaccard_components(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two documents link when percent of the union of their sets of ``size``-word
    shingles is in both; component_id is the smallest doc_id that links reach.
    Null and empty texts, and texts without a word, have no shingles and link
    with nothing; a text of fewer words is one shingle.  Repeated rows and
    equal texts link with each other and are compared with others once.  Rows
    with a null doc_id link with nothing and have a null component.  Sets are
    compared by 64-bit shingle hashes.  Other columns are not read.
    """
    return _joined(docs, size, percent)[0]


def jaccard_join(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``jaccard_components`` and n_links for every row of ``docs``: the other
    rows that it links with itself, not by way of others.  Equal texts and
    repeated rows count one by one; rows that link with nothing have 0."""
    return _joined(docs, size, percent, "count")[0]


def jaccard_links(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Rows doc_id, n_shingles, component_id, node (digest of the set of
    shingles), and all links a < b between different nodes.  Rows of one node
    link with each other besides."""
    return _joined(docs, size, percent, "pairs")


def _joined(docs: DataFrame, size: int, percent: int, want: str = "") -> tuple[DataFrame, DataFrame | None]:
    """The result rows, and with ``want`` "pairs" the links of nodes."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with_id = docs.filter(F.col("doc_id").isNotNull())
    hot = spark.sparkContext.broadcast(hot_shingles(with_id, size))
    digests = _digests(docs, hot, size, percent)
    known = digests.filter("n > 0 and doc_id is not null")
    nodes = stored(known.groupBy("node", "gid", "n", "sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "nodes")
    groups = nodes.groupBy("gid", "n").agg(F.min("rep").alias("rep"), F.min_by("node", "rep").alias("leader"),
                                           F.count("*").alias("members"))

    # groups that share a prefix shingle: counted where the entries meet by key,
    # so that only shared ones go on, once, to their groups
    of_key = Window.partitionBy("key")
    shared = (_entries(with_id, hot, size, percent)
              .withColumns({"low": F.min("gid").over(of_key), "high": F.max("gid").over(of_key)})
              .filter("low < high").select("key", "gid").distinct()
              .withColumn("sharing", F.count("*").over(of_key)))
    shared = stored(shared.join(groups.select("gid", "n", "rep"), "gid")
                         # 1: of the group's keys the one that most groups share
                         .withColumn("rank", F.row_number().over(
                             Window.partitionBy("gid").orderBy(F.desc("sharing"), "key")))
                         .withColumn("large", F.sum((F.col("sharing") > SMALL_KEY).cast("int"))
                                     .over(Window.partitionBy("gid"))), "shared")

    # pairs of groups: all within small keys; with the leader in the others
    def pairs_of(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
        a = left.select(*[F.col(c).alias(f"{c}_a") for c in left.columns])
        b = right.select(*[F.col(c).alias(f"{c}_b") for c in right.columns])
        return a.join(b, on & _compatible(percent))

    small = shared.filter(F.col("sharing") <= SMALL_KEY).select("key", "gid", "n", "rank", "large")
    in_small = stored(
        pairs_of(small, small, F.expr("key_a = key_b and gid_a < gid_b"))
        .groupBy("gid_a", "gid_b", "n_a", "n_b", "large_a", "large_b")
        .agg(F.count("*").alias("c"), F.max(F.least("rank_a", "rank_b")).alias("rank")), "small_pairs")
    # pairs that may share enough only together with large keys (see _different)
    perhaps = (in_small.filter("large_a > 0 and large_b > 0 and c + least(large_a, large_b) >= " + _needed(percent))
               .filter("rank >= " + _needed(percent)).select("gid_a", "gid_b"))
    # the group that shares most, over all its large keys, leads them: of copies
    # made from one text that text rather than one of the copies
    large = shared.filter(F.col("sharing") > SMALL_KEY)
    weight = large.groupBy("gid").agg(F.sum("sharing").alias("weight"))
    large = stored(large.join(weight, "gid").select("key", "gid", "n", "rep", "rank", "weight"), "large")
    # one row per key, pre-aggregated in each task; the stored table meets the
    # keys' rows by a join that Spark can split where one key has many
    first_of = F.min(F.struct((-F.col("weight")).alias("w"), "rep", "gid", "n")).alias("first")
    leaders = stored(large.groupBy("key").agg(first_of), "leaders")
    to_leader = (large.join(leaders, "key").filter("gid <> first.gid")
                 .select(F.least("gid", "first.gid").alias("gid_a"), F.greatest("gid", "first.gid").alias("gid_b"),
                         F.when(F.col("gid") < F.col("first.gid"), F.col("n")).otherwise(F.col("first.n")).alias("n_a"),
                         F.when(F.col("gid") < F.col("first.gid"), F.col("first.n")).otherwise(F.col("n")).alias("n_b"))
                 .filter(_compatible(percent)).groupBy("gid_a", "gid_b", "n_a", "n_b").agg(F.count("*").alias("c")))
    group_pairs = stored(in_small.select("gid_a", "gid_b", "n_a", "n_b", "c").unionByName(to_leader).groupBy("gid_a", "gid_b", "n_a", "n_b")
                              .agg(F.sum("c").alias("c")).filter(f"c >= {_needed(percent)}").select("gid_a", "gid_b"), "pairs")

    # first expansion: every member with the other group's leader and its own
    lead = groups.select("gid", "leader")
    member = nodes.select("gid", "node")
    named = (group_pairs.join(lead.select(F.col("gid").alias("gid_a"), F.col("leader").alias("lead_a")), "gid_a")
             .join(lead.select(F.col("gid").alias("gid_b"), F.col("leader").alias("lead_b")), "gid_b"))
    first = _ordered(
        named.join(member.select(F.col("gid").alias("gid_a"), F.col("node").alias("a")), "gid_a")
        .select("a", F.col("lead_b").alias("b"))
        .unionByName(named.join(member.select(F.col("gid").alias("gid_b"), F.col("node").alias("b")), "gid_b")
                     .select(F.col("lead_a").alias("a"), "b"))
        .unionByName(groups.filter("members > 1").join(member, "gid")
                     .select(F.col("leader").alias("a"), F.col("node").alias("b"))))
    first = stored(first, "first")
    links, tried = _verified(first, with_id, nodes, size, percent), first

    def parts() -> DataFrame:
        return stored(nodes.join(components(links).withColumnRenamed("a", "node"), "node", "left")
                           .select("node", "gid", "n", F.coalesce("component", "node").alias("part")), "parts")

    # what large keys still hold apart is tied to a second leader, outside the
    # key's largest part
    part = parts()
    second = stored(_second_leaders(large.select("key", "gid", "weight").join(part, "gid"), percent)
                         .join(tried, ["a", "b"], "left_anti"), "second")
    if not second.isEmpty():
        links, tried = links.unionByName(_verified(second, with_id, nodes, size, percent)), tried.unionByName(second)
        part = parts()

    # the rest: pairs whose ends are still in different components
    mixed = groups.filter("members > 1").select("gid").join(part, "gid")
    of_gid = _different(mixed.select(F.col("gid").alias("key"), "node", "n", "part", F.col("n").alias("rank")), percent).select("a", "b")
    of_pairs = (group_pairs.unionByName(perhaps).distinct()
                .join(part.select(F.col("gid").alias("gid_a"), F.col("node").alias("a"), F.col("part").alias("part_a")), "gid_a")
                .join(part.select(F.col("gid").alias("gid_b"), F.col("node").alias("b"), F.col("part").alias("part_b")), "gid_b")
                .filter("part_a <> part_b").select("a", "b"))
    of_large = _different(large.select("key", "gid", "rank").join(part, "gid").select("key", "node", "n", "part", "rank"),
                          percent).select("a", "b")
    rest = stored(_ordered(of_gid.unionByName(of_pairs).unionByName(of_large)).join(tried, ["a", "b"], "left_anti"),
                       "rest")
    if not rest.isEmpty():
        links = links.unionByName(_verified(rest, with_id, nodes, size, percent))
    # components of nodes, then of documents
    whole = components(links).withColumnRenamed("a", "node")
    owned = nodes.join(whole, "node", "left").select("node", "gid", "n", "rep", "copies", F.coalesce("component", "node").alias("component"))
    between = None
    if want:
        owned = stored(owned, "owned")
        sets = _sets(with_id, nodes.join(whole, "node").select("node", F.col("rep").alias("doc_id")), size)
        try:
            between = stored(_linked_nodes(owned, spark.table(sets).select("node", "set"), hot, percent, want == "pairs"), "between")
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {sets}")
    smallest = owned.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = owned.join(smallest, "component").select("node", "component_id", "copies")
    if want == "count":
        label = label.join(between, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1)
    linked = F.col("doc_id").isNotNull()
    more = {"": [], "count": [F.coalesce("n_links", F.lit(0)).alias("n_links")], "pairs": ["node"]}[want]
    return (digests.withColumn("node", F.when(linked, F.col("node"))).join(label, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), *more),
            between)


def _main_parts(rows: DataFrame) -> DataFrame:
    """key, main: the part with the most rows of every key that has several."""
    count = rows.groupBy("key", "part").agg(F.count("*").alias("k"))
    main = count.groupBy("key").agg(F.max(F.struct("k", "part"))["part"].alias("main"), F.count("*").alias("parts"))
    return main.filter("parts > 1").select("key", "main")


def _second_leaders(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: every node of a key with several parts, and the heaviest node
    outside the key's main part, if they are in different parts; for each node
    only the leader that it meets under the most keys."""
    rows = rows.join(_main_parts(rows), "key")
    lead = rows.filter("part <> main").groupBy("key").agg(
        F.min(F.struct((-F.col("weight")).alias("w"), "node", "n", "part")).alias("lead"))
    met = (rows.join(lead, "key").filter("part <> lead.part")
           .select("node", F.col("n").alias("n_a"), F.col("lead.node").alias("leader"), F.col("lead.n").alias("n_b"))
           .filter(_compatible(percent)).groupBy("node", "leader").agg(F.count("*").alias("c")))
    best = met.groupBy("node").agg(F.min(F.struct((-F.col("c")).alias("c"), "leader"))["leader"].alias("leader"))
    return _ordered(best.select(F.col("node").alias("a"), F.col("leader").alias("b")))


def _different(rows: DataFrame, percent: int) -> DataFrame:
    """a, b (a < b): pairs of nodes under one key that are in different parts,
    of compatible size, and may be similar.

    Pairs that need c shared prefix shingles share one that in neither prefix
    is among the c - 1 that most groups share (``rank``): frequent keys bring
    only pairs together that have rarer ones in common.  And in each key the
    part with the most nodes is left alone: any such pair has an end outside
    it, so only the other nodes look for partners."""
    rows = rows.join(_main_parts(rows), "key")
    columns = ("node", "n", "part", "rank")
    a = rows.filter("part <> main").select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
    b = rows.select("key", *[F.col(c).alias(f"{c}_b") for c in columns], (F.col("part") == F.col("main")).alias("in_main"))
    # a pair with both ends outside the main part is met from either end: keep one
    met = a.join(b, "key").filter("part_a <> part_b and (in_main or node_a < node_b)")
    met = met.filter(_compatible(percent)).filter(f"least(rank_a, rank_b) >= {_needed(percent)}")
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op2_jaccard_links(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
