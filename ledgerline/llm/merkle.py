"""Merkle dataset manifest with blocks in van Emde Boas order (operator 11).

Every row is a leaf: the SHA-256 of its fields. The leaves of a group (a
source), in key order, are hashed in runs of ``arity`` until one node is left,
the group's subroot; the subroots in group order give the root the same way.
A run that is not full is hashed as it is, also one of a single node.

**Blocks.** A tree is cut into aligned subtrees of ``depth`` levels of edges
(16 ** 3 = 4,096 leaves by default). One row of the manifest is one block: its
nodes are a byte string in van Emde Boas order (``addresses``: the upper half
of the levels first, then each lower subtree, both laid out the same way).
Construction and retrieval use only that address arithmetic. The roots of the
blocks are the leaves of the next tier, until every tree has one block, so no
task ever sees more than a block and no tree is built in one task.

**Ranks.** A row's place in its group comes from one range sort by (group,
key, leaf): the place inside its partition plus the group's rows in earlier
partitions. Rows equal in all of them are told apart by their place in the
stored table, so a hot group, or one key with many rows, spreads over many
tasks.

**Proofs.** From the top tier down, each block hands the siblings above it to
the blocks below. A proof is the siblings of a leaf, level by level; folding
a leaf through it gives the root again exactly when the leaf is the original.

Defined cases: a null field is written ``-``, and so is a column that the
table does not have; a null key sorts first, a null group is a group of its
own and sorts first; rows of one key are ordered by their leaf; repeated rows
are leaves of their own; a lone leaf is its subroot and a lone subroot the
root (no siblings: the digest of nothing); an empty table gives an empty
manifest and result; extra columns are ignored, whatever their names. A row
of a null key is never offered in a changed form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import quoted, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
DEPTH = 3
PATH = "array<struct<before:string,after:string>>"


def field_text(column):
    """A field as it is hashed: ``-`` for null, else byte count, colon, value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns):
    """SHA-256 of the fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field_text, columns)), 256))


def subtree_size(levels: int, arity: int) -> int:
    return (arity ** levels - 1) // (arity - 1)


def addresses(levels: int, level: int, index: np.ndarray, arity: int = ARITY) -> np.ndarray:
    """Van Emde Boas addresses of the nodes ``index`` of ``level`` (0: the
    root) in a complete subtree of that many levels of nodes."""
    if levels == 1:
        return np.zeros_like(index)
    upper = (levels + 1) // 2
    if level < upper:
        return addresses(upper, level, index, arity)
    width = arity ** (level - upper)  # nodes of this level in one lower subtree
    lower = levels - upper
    return (subtree_size(upper, arity) + index // width * subtree_size(lower, arity)
            + addresses(lower, level - upper, index % width, arity))


def level_sizes(leaves: int, height: int, arity: int) -> list[int]:
    """Nodes of each level, the root's first, of a block with ``leaves``."""
    sizes = [leaves]
    for _ in range(height):
        sizes.append(-(-sizes[-1] // arity))
    return sizes[::-1]


def build_block(digests: list[bytes], height: int, arity: int = ARITY) -> bytes:
    """The nodes of one block in van Emde Boas order, 32 bytes each; what lies
    beyond the last node is left off."""
    sizes = level_sizes(len(digests), height, arity)
    place = [addresses(height + 1, d, np.arange(n), arity) for d, n in enumerate(sizes)]
    nodes = np.zeros((max(int(p.max()) for p in place) + 1, 32), np.uint8)
    nodes[place[-1]] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    for d in range(height - 1, -1, -1):
        below = nodes[place[d + 1]].tobytes().hex().encode()
        runs = [below[k:k + 64 * arity] for k in range(0, len(below), 64 * arity)]
        nodes[place[d]] = np.frombuffer(b"".join(hashlib.sha256(r).digest() for r in runs), np.uint8).reshape(-1, 32)
    return nodes.tobytes()


def level_runs(nodes: bytes, leaves: int, height: int, arity: int = ARITY) -> list[str]:
    """Each level's nodes below the block's root as one hexadecimal text, the
    leaves first."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    sizes = level_sizes(leaves, height, arity)
    return [table[addresses(height + 1, d, np.arange(sizes[d]), arity)].tobytes().hex() for d in range(height, 0, -1)]


def siblings(runs: list[str], index: int, arity: int = ARITY) -> list[tuple[str, str]]:
    """What stands before and after a leaf's ancestor in its run, per level."""
    out = []
    for level in runs:
        first = index // arity * arity
        own, stop = 64 * index, 64 * (first + arity)
        out.append((level[64 * first:own], level[own + 64:stop]))
        index //= arity
    return out


def ranked(rows: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """``rows`` (a stored table) with ``idx``, the place in its group, and
    ``n``, the group's rows (long columns)."""
    tie, keys = "row_tie", [*groups, *order]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id())
    placed = stored(dealt.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
                    .withColumn("place", F.monotonically_increasing_id()), "ranked") \
        .withColumn("part", F.shiftright("place", 33))  # the place has the partition above its lower 33 bits
    counts = placed.groupBy(*groups, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("own"))
    group = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("own").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = stored(counts.select(*[F.col(g).alias(f"{g}_of") for g in groups], F.col("part").alias("part_of"),
                                 (before - F.col("first")).alias("shift"), F.sum("own").over(group).alias("n")), "parts")
    same = F.col("part") == F.col("part_of")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_of"))
    return placed.join(parts, same).withColumn("idx", F.col("place") + F.col("shift")) \
        .drop("place", "shift", "part", "part_of", *[f"{g}_of" for g in groups])


def tree_height(n, arity: int):
    """Levels of edges of a tree over ``n`` leaves: how many powers are below n."""
    return sum((n > arity ** k).cast("int") for k in range(63) if arity ** k < 1 << 62)


def build_tier(leaves: DataFrame, depth: int, arity: int, more: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of (g, idx, n, digest): g, block, n, height, rows (the leaves'
    columns ``more``), leaves (their number), nodes, digest (the block's root)."""
    span = arity ** depth
    sorted_rows = F.sort_array(F.collect_list(F.struct("idx", "digest", *more)))
    blocks = leaves.groupBy("g", F.expr(f"idx div {span}").alias("block")).agg(F.max("n").alias("n"), sorted_rows.alias("x")) \
        .select("g", "block", "n", F.least(tree_height(F.col("n"), arity), F.lit(depth)).alias("height"),
                F.transform("x", lambda r: F.struct(*[r[m].alias(m) for m in more]) if more else F.lit(0)).alias("rows"),
                F.size("x").alias("leaves"), F.col("x.digest").alias("digests"))
    kept = blocks.drop("digests").schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", nodes binary, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):  # blocks held as Python objects at a time
                part = batch.slice(k, 64)
                heights = part.column("height").to_pylist()
                nodes = [build_block(d, h, arity) for d, h in zip(part.column("digests").to_pylist(), heights, strict=True)]
                columns = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(nodes, pa.binary()),
                                                  pa.array([x[:32] for x in nodes], pa.binary())],
                                                 names=[*(f.name for f in kept), "nodes", "digest"])

    return stored(blocks.mapInArrow(run, schema), "merkle-tier")


def build_tiers(leaves: DataFrame, depth: int, arity: int, more: tuple[str, ...] = ()) -> list[DataFrame]:
    """Tiers of blocks, the leaves' first, until each tree ends in one block."""
    span, tiers = arity ** depth, [build_tier(leaves, depth, arity, more)]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > span:
        up = tiers[-1].where(F.col("n") > span).select(
            "g", F.col("block").alias("idx"), F.expr(f"(n + {span - 1}) div {span}").alias("n"), "digest")
        tiers.append(build_tier(up, depth, arity))
    return tiers


def top_blocks(tiers: list[DataFrame], span: int) -> DataFrame:
    """(g, digest): the root of each tree."""
    ends = [t.where(F.col("n") <= span).select("g", "digest") for t in tiers]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


@dataclass
class Manifest:
    """Tiers of the groups' trees and of the tree over their subroots."""

    groups: DataFrame
    trees: list[DataFrame]
    top: list[DataFrame]
    depth: int
    arity: int


def build_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source",
                   offered: dict | None = None, depth: int = DEPTH, arity: int = ARITY) -> Manifest:
    """The manifest of ``docs``. ``offered`` maps fields to expressions: the
    form in which a row is offered for verification later; its leaf is kept
    beside the original (null where it's the same)."""
    have = set(docs.columns)
    value = lambda c: F.col(quoted(c)) if c in have else F.lit(None).cast("string")
    leaf = leaf_digest([value(c) for c in fields])
    rows = docs.select(value(key).alias("doc_id"), value(group).alias("source"), leaf.alias("digest"),
                       (leaf_digest([(offered or {}).get(c, value(c)) for c in fields]) if offered
                        else F.lit(None).cast("binary")).alias("offered"))
    rows = stored(rows.withColumn("offered", F.when(F.col("offered") != F.col("digest"), F.col("offered"))), "leaves")
    placed = ranked(rows, ["source"], ["doc_id", "digest"])
    groups = stored(rows.select("source").distinct(), "groups")
    groups = stored(ranked(groups.withColumn("all_groups", F.lit(0)), ["all_groups"], ["source"])
                    .select(F.col("source").alias("group_name"), F.col("idx").alias("g"), F.col("n").alias("n_groups")), "groups")
    leaves = placed.join(groups, F.col("source").eqNullSafe(F.col("group_name"))).select("g", "idx", "n", "digest", "doc_id", "offered")
    trees = build_tiers(leaves, depth, arity, ("doc_id", "offered"))
    subroots = top_blocks(trees, arity ** depth).join(groups, "g").select(
        F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.col("n_groups").alias("n"), "digest")
    return Manifest(groups, trees, build_tiers(subroots, depth, arity), depth, arity)


def hand_down(tiers: list[DataFrame], above: DataFrame, arity: int, depth: int) -> DataFrame:
    """The blocks of the lowest tier with the path above them: (g, path,
    subroot, root) rows of ``above``, one per tree, reach its top block, and
    each tier's blocks hand their leaves' paths to the tier below."""
    span, waiting = arity ** depth, None
    for t in range(len(tiers) - 1, -1, -1):
        blocks = tiers[t]
        first = blocks.where(F.col("n") <= span).join(above, "g").withColumn(
            "subroot", F.coalesce("subroot", F.lower(F.hex("digest"))))
        blocks = first if waiting is None else first.unionByName(blocks.where(F.col("n") > span).join(waiting, ["g", "block"]))
        if t:
            waiting = expand(blocks, arity)
    return blocks


def expand(blocks: DataFrame, arity: int) -> DataFrame:
    """(g, block, path, subroot, root) for each leaf of blocks with a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        for batch in batches:
            for row in batch.to_pylist():
                runs = level_runs(row["nodes"], row["leaves"], row["height"], arity)
                first = row["block"] * arity ** row["height"]
                n = row["leaves"]
                for k in range(0, n, 512):
                    some = range(k, min(k + 512, n))
                    paths = [[{"before": b, "after": a} for b, a in siblings(runs, i, arity)] + row["path"] for i in some]
                    root = row["root"] or row["nodes"][:32].hex()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["g"]] * len(some), pa.int64()), pa.array([first + i for i in some], pa.int64()),
                         pa.array(paths, kind), pa.array([row["subroot"]] * len(some)), pa.array([root] * len(some))],
                        names=["g", "block", "path", "subroot", "root"])

    return blocks.select("g", "block", "height", "leaves", "nodes", "path", "subroot", "root") \
        .mapInArrow(run, f"g long, block long, path {PATH}, subroot string, root string")


def verify(manifest: Manifest) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256 (of the
    original), folded_root (the offered leaf folded through the original
    siblings) and verified."""
    arity, depth = manifest.arity, manifest.depth
    none = F.array().cast(PATH)
    start = manifest.top[0].sparkSession.range(1).select(
        F.col("id").alias("g"), none.alias("path"), F.lit("").alias("subroot"), F.lit(None).cast("string").alias("root"))
    over = expand(hand_down(manifest.top, start, arity, depth), arity)
    above = over.select(F.col("block").alias("g"), "path", F.lit(None).cast("string").alias("subroot"), "root")
    blocks = hand_down(manifest.trees, above, arity, depth)
    kind = blocks.schema["rows"].dataType.elementType["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("rows").slice(k, 1).flatten()
                row = {c: batch.column(c)[k].as_py() for c in ("height", "leaves", "nodes", "path", "subroot", "root")}
                runs = level_runs(row["nodes"], row["leaves"], row["height"], arity)
                own = [row["nodes"][:32].hex()] if not row["height"] else [runs[0][64 * i:64 * i + 64] for i in range(row["leaves"])]
                tail = [(x["before"].encode(), x["after"].encode()) for x in row["path"]]
                shared = b"".join(b + a for b, a in tail)
                proofs, folded = [], []
                for i, offered in enumerate(rows.field("offered").to_pylist()):
                    mine = [(b.encode(), a.encode()) for b, a in siblings(runs, i, arity)]
                    proofs.append(hashlib.sha256(b"".join(b + a for b, a in mine) + shared).hexdigest())
                    node = offered.hex() if offered else own[i]
                    for b, a in mine + tail:
                        node = hashlib.sha256(b + node.encode() + a).hexdigest()
                    folded.append(node)
                n = len(folded)
                yield pa.RecordBatch.from_arrays(
                    [rows.field("doc_id"), pa.array(own), pa.array([row["subroot"]] * n), pa.array([row["root"]] * n),
                     pa.array(proofs), pa.array(folded), pa.array([f == row["root"] for f in folded])], names=names)

    return blocks.select("height", "leaves", "rows", "nodes", "path", "subroot", "root").mapInArrow(
        run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
