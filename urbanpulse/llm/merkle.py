"""Merkle manifest of a dataset, in van Emde Boas layout.

The leaves of one scope (say a source), in their order, are cut into aligned
subtrees ("blocks") of ``3^height`` leaves.  A block is one row: its nodes stand
in an array that is split recursively at half the height, the top half first and
then every bottom subtree, so that a walk from a leaf to the root touches few
stretches of memory whatever their size.  Addresses are computed, no pointers
are stored.  The blocks' roots are the leaves of the next round of blocks, until
one root per scope is left; the scopes' roots are the leaves of a last tree.

Proofs come top down: a block reads the path above its root once, and adds the
siblings inside the block for each of its leaves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse.llm.common import table
from urbanpulse.session import stage_table

ARITY = 3
#: Levels of a block below its root: 729 leaves.
HEIGHT = 6
DIGEST = 32


def digest_of(*columns: Column) -> Column:
    """SHA-256 (binary) of the values' texts, each after its number of UTF-8
    bytes and ":"; a null is "-"."""
    said = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
            for c in columns]
    return F.unhex(F.sha2(F.concat(*said), 256))


# -- one block

def tree_size(levels: int) -> int:
    return (ARITY ** levels - 1) // (ARITY - 1)


@lru_cache(maxsize=None)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each depth, the array index of its nodes from left to right in a tree
    of so many levels."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    start = tree_size(top) + np.arange(ARITY ** top, dtype=np.int64) * tree_size(levels - top)
    return (*addresses(top), *[(start[:, None] + inner[None, :]).ravel() for inner in addresses(levels - top)])


def parent(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def build(leaves: list[str], levels: int) -> list[str]:
    """Nodes (hex) of the tree over ``leaves`` in van Emde Boas order: the bottom
    subtrees first, then the top over their roots.  Absent nodes are zeros."""
    if levels == 1:
        return leaves[:1]
    top = levels // 2
    bottom = levels - top
    width, size, none = ARITY ** (bottom - 1), tree_size(bottom), "0" * (2 * DIGEST)
    if bottom == 1:
        roots, below = leaves, list(leaves)
    else:
        parts = [build(leaves[i:i + width], bottom) for i in range(0, len(leaves), width)]
        roots = [p[0] for p in parts]
        below = [x for p in parts for x in p + [none] * (size - len(p))]
    # the bottom roots' parents are the top's leaves
    over = [parent(roots[i:i + ARITY]) for i in range(0, len(roots), ARITY)]
    above = build(over, top)
    return above + [none] * (tree_size(top) - len(above)) + below


def levels_of(n: int) -> int:
    """Levels of a whole tree over n leaves."""
    levels, width = 1, 1
    while width < n:
        levels, width = levels + 1, width * ARITY
    return levels


def siblings(leaf: int, n: int, levels: int) -> list[tuple[int, list[int]]]:
    """From the leaf up: its place in its run, and the addresses of the run's
    others."""
    out, at = [], addresses(levels)
    for depth in range(levels - 1, 0, -1):
        first = leaf - leaf % ARITY
        out.append((leaf - first, [int(at[depth][i]) for i in range(first, min(first + ARITY, n)) if i != leaf]))
        leaf, n = leaf // ARITY, -(-n // ARITY)
    return out


# -- paths: for every level the place, the number of siblings, and their digests

def encode_path(steps: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(bytes((place, len(others))) + bytes.fromhex("".join(others)) for place, others in steps)


def decode_path(path: bytes) -> list[tuple[int, list[str]]]:
    out, i = [], 0
    while i < len(path):
        place, n = path[i], path[i + 1]
        text = path[i + 2:i + 2 + n * DIGEST].hex()
        out.append((place, [text[64 * k:64 * k + 64] for k in range(n)]))
        i += 2 + n * DIGEST
    return out


def fold(leaf: str, steps: list[tuple[int, list[str]]]) -> str:
    for place, others in steps:
        leaf = parent([*others[:place], leaf, *others[place:]])
    return leaf


# -- rounds of blocks

def positions(rows: DataFrame, scope: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (place in its scope, from 0) and ``total`` (rows of
    the scope).  Rows are sorted over all tasks, so that a large scope is many
    tasks' work; what a task holds of a scope is counted, and the counts before
    it are its offset."""
    mid = F.monotonically_increasing_id()
    ordered = stage_table(rows.repartitionByRange(scope, *order).sortWithinPartitions(scope, *order)
                          .withColumns({"__part": F.shiftright(mid, 33), "__at": mid.bitwiseAND(F.lit((1 << 33) - 1))}), "ordered")
    held = ordered.groupBy("__part", scope).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    own = Window.partitionBy(scope)
    before = F.sum("__n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("__part", scope, "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(own).alias("total"))
    return (ordered.join(starts, ["__part", scope])
            .withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before"))
            .drop("__part", "__at", "__first", "__before"))


def block_round(rows: DataFrame, height: int, keep: list[str]) -> DataFrame:
    """Stored blocks of ``rows`` (scope, pos, total, digest, and ``keep``):
    scope, block, total, leaves (their number), levels, tree, root, and the kept
    columns as arrays in the leaves' order.  A block has at most 3^height leaves."""
    width = ARITY ** height
    items = F.array_sort(F.collect_list(F.struct("pos", "digest", *keep)))
    grouped = (rows.groupBy("scope", F.floor(F.col("pos") / width).cast("long").alias("block"))
               .agg(F.first("total").alias("total"), items.alias("items"))
               .select("scope", "block", "total", F.col("items.digest").alias("digests"),
                       *[F.col("items").getField(c).alias(c) for c in keep]))

    def run(batches):
        for batch in batches:
            sizes, levels, trees, roots = [], [], [], []
            for total, digests in zip(batch.column("total").to_pylist(), batch.column("digests").to_pylist()):
                n = height + 1 if total > width else levels_of(total)
                nodes = build([d.hex() for d in digests], n)
                sizes.append(len(digests))
                levels.append(n)
                trees.append(bytes.fromhex("".join(nodes)))
                roots.append(bytes.fromhex(nodes[0]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("scope", "block", "total", *keep)], pa.array(sizes, pa.int32()),
                 pa.array(levels, pa.int32()), pa.array(trees, pa.binary()), pa.array(roots, pa.binary())],
                names=["scope", "block", "total", *keep, "leaves", "levels", "tree", "root"])

    kept = "".join(f"{c} {grouped.schema[c].dataType.simpleString()}, " for c in keep)
    return stage_table(grouped.mapInArrow(
        run, f"scope string, block long, total long, {kept}leaves int, levels int, tree binary, root binary"), "blocks")


def block_rounds(rows: DataFrame, height: int, keep: list[str]) -> list[DataFrame]:
    """The rounds from the leaves up to one block per scope."""
    width, rounds = ARITY ** height, [block_round(rows, height, keep)]
    most = rounds[0].agg(F.max("total")).first()[0] or 0
    while most > width:
        above = (rounds[-1].filter(F.col("total") > width)
                 .select("scope", F.col("block").alias("pos"), F.ceil(F.col("total") / width).cast("long").alias("total"),
                         F.col("root").alias("digest")))
        rounds.append(block_round(above, height, []))
        most = -(-most // width)
    return rounds


def scope_roots(rounds: list[DataFrame], height: int) -> DataFrame:
    """scope, root of every scope."""
    done = [r.filter(F.col("total") <= ARITY ** height).select("scope", "root") for r in rounds]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


@dataclass
class Manifest:
    """Stored blocks: the scopes' rounds, the rounds over their roots, and the
    root (hex; None for an empty dataset)."""
    rounds: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None
    keep: list[str]
    height: int


def build_manifest(rows: DataFrame, order: list[str], keep: list[str], height: int = HEIGHT) -> Manifest:
    """Manifest of ``rows`` (scope, digest, the columns of ``order`` and ``keep``).

    Leaves of a scope ascend by ``order`` (nulls first), scopes by their UTF-8
    bytes (null first).  Rows that are equal in all of these are interchangeable
    and each is a leaf.  An empty table has no root.
    """
    # a null scope is its own: before all texts
    named = rows.select(F.when(F.col("scope").isNull(), "").otherwise(F.concat(F.lit("+"), "scope")).alias("scope"),
                        *[c for c in rows.columns if c != "scope"]).withColumn("__row", F.monotonically_increasing_id())
    placed = positions(stage_table(named, "leaves"), "scope", [*order, "digest", "__row"])
    rounds = block_rounds(placed, height, keep)
    subroots = stage_table(scope_roots(rounds, height), "subroots")
    tops = positions(subroots.select(F.lit("").alias("scope"), F.col("scope").alias("own"), F.col("root").alias("digest")),
                     "scope", ["own"])
    top = block_rounds(tops, height, ["own"])
    root = scope_roots(top, height).first()
    return Manifest(rounds, top, subroots, root["root"].hex() if root else None, keep, height)


def leaf_paths(blocks: DataFrame, above: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """scope, leaf (its place in the round), digest, path, subroot and the kept
    columns of every leaf of the blocks; ``above`` (scope, block, path, subroot)
    holds the path over each block's root."""

    def run(batches):
        for batch in batches:
            blocks, leaves, levels = (batch.column(c).to_pylist() for c in ("block", "leaves", "levels"))
            for i, (block, n, high) in enumerate(zip(blocks, leaves, levels)):
                tree, over = batch.column("tree")[i].as_py(), batch.column("path")[i].as_py()
                node = lambda a: tree[DIGEST * a:DIGEST * a + DIGEST]  # noqa: B023, E731
                paths = [b"".join(x for place, others in siblings(leaf, n, high)
                                  for x in (bytes((place, len(others))), *map(node, others))) + over for leaf in range(n)]
                own = addresses(high)[-1][:n].tolist()
                again = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("scope").take(again), pa.array(np.arange(n) + block * width, pa.int64()),
                     pa.array([node(a) for a in own], pa.binary()), pa.array(paths, pa.binary()),
                     batch.column("subroot").take(again), *[batch.column(c).slice(i, 1).flatten() for c in keep]],
                    names=["scope", "leaf", "digest", "path", "subroot", *keep])

    kept = "".join(f", {c} {blocks.schema[c].dataType.elementType.simpleString()}" for c in keep)
    return (blocks.join(above, ["scope", "block"])
            .select("scope", "block", "leaves", "levels", "tree", "path", "subroot", *keep)
            .mapInArrow(run, f"scope string, leaf long, digest binary, path binary, subroot binary{kept}"))


def descend(rounds: list[DataFrame], roots: DataFrame, height: int, keep: list[str]) -> DataFrame:
    """Paths of the first round's leaves, from ``roots`` (scope, path, subroot),
    the path over each scope's root."""
    width, above = ARITY ** height, None
    for r in range(len(rounds) - 1, -1, -1):
        first = rounds[r].filter(F.col("total") <= width).select("scope", "block").join(roots, "scope")
        first = first.select("scope", "block", "path", "subroot")
        above = first if above is None else first.unionByName(above)
        leaves = leaf_paths(rounds[r], above, width, [] if r else keep)
        if not r:
            return leaves
        above = stage_table(leaves.select("scope", F.col("leaf").alias("block"), "path", "subroot"), "paths")


def inclusion_proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: the kept columns, digest, subroot, and path: the
    siblings from the leaf up to the root over all scopes (``decode_path``)."""
    none = manifest.top[-1].filter(F.col("total") <= ARITY ** manifest.height).select(
        "scope", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"))
    tops = descend(manifest.top, none, manifest.height, ["own"])
    roots = stage_table(tops.select(F.col("own").alias("scope"), "path", F.col("digest").alias("subroot")), "scope_paths")
    return descend(manifest.rounds, roots, manifest.height, manifest.keep).drop("scope", "leaf")


def folded(proofs: DataFrame, claimed: str) -> DataFrame:
    """``proofs`` with folded_root (the root that the binary digest in column
    ``claimed`` leads to over the path) and proof_sha256 (digest of the path's
    siblings), both hex; column ``path`` is left out."""
    rest = [c for c in proofs.columns if c not in ("path", claimed)]

    def run(batches):
        for batch in batches:
            roots, digests = [], []
            for leaf, path in zip(batch.column(claimed).to_pylist(), batch.column("path").to_pylist()):
                steps = decode_path(path)
                roots.append(fold(leaf.hex(), steps))
                digests.append(parent([x for _, others in steps for x in others]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(roots, pa.string()),
                                              pa.array(digests, pa.string())], names=[*rest, "folded_root", "proof_sha256"])

    kept = ", ".join(f"`{c}` {proofs.schema[c].dataType.simpleString()}" for c in rest)
    return proofs.mapInArrow(run, f"{kept}, folded_root string, proof_sha256 string")


def document_manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[Manifest, DataFrame]:
    """Manifest of ``docs`` by source, and per document the check of a copy from
    which line feeds were lost where crc32 of its id is even: doc_id, leaf,
    subroot, root, proof_sha256, folded_root, verified.

    A null field is hashed as "-"; null texts and null ids stay as they are.  Rows
    with a null id come first in their source; rows that share source and id are
    ordered by their digest.  Other columns aren't part of a leaf.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, digest_of(*fields, F.translate("text", "\n", "")))
    # the original text first, and the changed one only where it differs
    rows = docs.select(F.col("source").alias("scope"), "doc_id", digest_of(*fields, F.col("text")).alias("digest"),
                       F.when(F.contains("text", F.lit("\n")), changed).alias("changed"))
    manifest = build_manifest(rows, ["doc_id"], ["doc_id", "changed"], height)
    proofs = inclusion_proofs(manifest).withColumn("claimed", F.coalesce("changed", "digest")).drop("changed")
    shown = lambda c: F.lower(F.hex(c))
    return manifest, folded(proofs, "claimed").select(
        "doc_id", shown("digest").alias("leaf"), shown("subroot").alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(manifest.root)).alias("verified"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return document_manifest(table(spark, sf_dir, "documents"))[1]


OP12_SQL = """
WITH RECURSIVE f AS (
  SELECT doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    -- crc32 of the id's decimal text, bit by bit
    xor(list_reduce(list_concat([4294967295], list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1)))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 2 = 0 AS even
  FROM documents),
h AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN even AND text IS NOT NULL
      THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed FROM f),
l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM h),
-- the sources' trees, level by level
t AS (
  SELECT 0 AS lvl, source, pos, n, leaf AS h FROM l
  UNION ALL
  SELECT lvl + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lvl, source, pos // 3, n),
s AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS pos, count(*) OVER () AS n
  FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM s
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 3, n),
runs AS (SELECT lvl, source, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
over AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
-- every leaf climbs its source's tree, and then the tree of the sources
c AS (
  SELECT 0 AS lvl, doc_id, source, leaf, claimed, pos, pos AS spot, n, claimed AS x, '' AS proof FROM l
  UNION ALL
  SELECT c.lvl + 1, doc_id, c.source, leaf, claimed, pos, spot // 3, (n + 2) // 3,
    sha256(array_to_string(list_concat(hs[:spot % 3], [x], hs[spot % 3 + 2:]), '')),
    proof || array_to_string(list_concat(hs[:spot % 3], hs[spot % 3 + 2:]), '')
  FROM c JOIN runs r ON r.lvl = c.lvl AND r.source IS NOT DISTINCT FROM c.source AND r.run = spot // 3 WHERE n > 1),
d AS (
  SELECT 0 AS lvl, doc_id, c.source, leaf, c.pos, subroot, s.pos AS spot, s.n, x, proof
  FROM c JOIN s ON c.source IS NOT DISTINCT FROM s.source WHERE c.n = 1
  UNION ALL
  SELECT d.lvl + 1, doc_id, source, leaf, pos, subroot, spot // 3, (n + 2) // 3,
    sha256(array_to_string(list_concat(hs[:spot % 3], [x], hs[spot % 3 + 2:]), '')),
    proof || array_to_string(list_concat(hs[:spot % 3], hs[spot % 3 + 2:]), '')
  FROM d JOIN over r ON r.lvl = d.lvl AND r.run = spot // 3 WHERE n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified
FROM d CROSS JOIN (SELECT h AS root FROM u WHERE n = 1) WHERE n = 1
"""
