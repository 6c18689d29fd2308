"""SimHash near-duplicates by a byte-position index with count filtering
(operator 9).

A fingerprint has eight bytes. Two fingerprints that differ in at most ``d``
bits differ in at most ``d`` bytes, so they share at least ``8 - d``
positional bytes: the guaranteed minimum of matches. The index posts each
distinct fingerprint under small sets of byte positions chosen so that every
``8 - d`` shared positions contain one of the sets (for d = 4: the 20 triples
inside a cyclic chain of three position groups), which keeps a posting list at
N / 2**24 random fingerprints instead of N / 2**8. Inside a posting list the
shared positional bytes of each pair are tallied, pairs below the minimum are
dropped, and the rest are verified by their bit distance.

Copies of a fingerprint are aggregated before anything else, so a group of
exact copies is one posting. Of a posting list only a spanning forest is
emitted (a search that takes every unvisited neighbour at once), so a group of
near copies gives one link per member, not all its pairs, and no link between
components is lost. A list longer than ``block`` is split into blocks, and
every pair of blocks is searched by a task of its own, so no task holds more
than two blocks and nothing is capped.

Defined cases: null or wordless text has fingerprint zero and links like any
other; fewer words than a shingle make one shingle of the whole sequence;
repeated rows get the same class; an empty table gives an empty result; null
ids keep their row (their class is the smallest non-null id of the component,
or null); ids may be any 64-bit integers; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, pieces, quoted, stored
from ledgerline.llm.graph import components

SEED = 42
BLOCK = 20_000


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], stops[:-1]))
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    ends = (stops[last:last + n] - 1).tolist()
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends, strict=True)),
                         np.uint64, n)
    total = np.zeros(64, np.int64)
    for k in range(0, n, 65536):  # bounded memory for very long texts
        part = hashes[k:k + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text",
                 more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; and the longs ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (x for piece in pieces(batch, 1) for x in piece.column(1).cast(pa.binary()).to_pylist())
            fp = np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), *batch.columns[2:]],
                                             names=["doc_id", "fp", *more])

    rows = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), quoted(text), *more)
    return rows.mapInArrow(run, ", ".join(f"{x} long" for x in ("doc_id", "fp", *more)))


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``8 - max_bits`` positions contain
    one of them."""
    if max_bits == 4:
        groups = ((0, 1, 2), (3, 4, 5), (6, 7))
        sets = []
        for k, own in enumerate(groups):
            after = groups[(k + 1) % 3]
            sets += list(combinations(own, 3)) + [(*two, one) for two in combinations(own, 2) for one in after]
        wanted = [set(x) for x in combinations(range(8), 4)]
        if all(any(set(s) <= w for s in sets) for w in wanted):
            return sets
    return list(combinations(range(8), max(1, 8 - max_bits)))


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges (indexes) of a spanning forest of the fingerprints that differ in
    at most ``max_bits`` bits."""
    least = 8 - max_bits
    edges, rest = [], np.arange(len(fps))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            apart = fps[rest] ^ fps[at]
            shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # tally of positional bytes
            near = shared >= least
            near[near] = np.bitwise_count(apart[near]) <= max_bits
            found = rest[near]
            edges += [(int(at), int(x)) for x in found]
            queue += found.tolist()
            rest = rest[~near]
    return edges


def links(distinct: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``, with a node
    number ``node``) that span their components."""
    sets = position_sets(max_bits)

    def key(positions):
        parts = [F.call_function("shiftright", F.col("fp"), F.lit(8 * p)).bitwiseAND(F.lit(255)) for p in positions]
        value = parts[0]
        for part in parts[1:]:
            value = value * 256 + part
        return value

    postings = distinct.select("node", "fp", F.posexplode(F.array(*[key(s) for s in sets])).alias("pos", "key"))
    sizes = postings.groupBy("pos", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    posted = postings.join(sizes, ["pos", "key"])
    blocks = F.ceil(F.col("n") / block).cast("long")
    own = F.pmod(F.xxhash64("fp"), blocks)
    # block i meets every block j: unit (min, max); one block: the single unit (0, 0)
    pair = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1),
                       lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    units = posted.select("pos", "key", "fp", "node", F.explode(pair).alias("unit")) \
        .select("pos", "key", "unit.i", "unit.j", "fp", "node")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[np.ndarray]) -> pa.RecordBatch | None:
            nodes, fps = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
            pairs = forest(fps.view(np.uint64), max_bits)
            if not pairs:
                return None
            x = np.array(pairs)
            return pa.RecordBatch.from_arrays([pa.array(nodes[x[:, 0]]), pa.array(nodes[x[:, 1]])], names=["a", "b"])

        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(6)]
            ids = np.stack(cols[:4])
            cuts = np.flatnonzero((np.diff(ids, axis=1) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                group = tuple(ids[:, a].tolist())
                if group != last and held:
                    done = flush(held)
                    held = []
                    if done is not None:
                        yield done
                last = group
                held.append((cols[5][a:b], cols[4][a:b]))
        if held and (done := flush(held)) is not None:
            yield done

    keys = ["pos", "key", "i", "j"]
    return (units.select(*keys, "fp", "node").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(search, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """doc_id, fp (signed long) and component_id, one row per document."""
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    # classes are numbered apart from the ids, which may be missing or any 64 bits
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")
    named = _with_root(classes, max_bits, block)
    ends = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(ends, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _with_root(classes: DataFrame, max_bits: int, block: int) -> DataFrame:
    """``classes`` (stored; fp, node) with the number of their component."""
    roots = components(links(classes.select("fp", "node"), max_bits, block))
    return classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """The documents, one row of each near-duplicate component: the one of the
    smallest id; of equal ids, or without any, the one of the smallest hash of
    the text. Rows are told apart by id and text, so rows of one id or of none
    are judged each by its own text.

    Only what is to drop (and rows that repeat) is joined to the texts: ids of
    which no row stays by the id alone, the others by id and hashes, so the
    planner can broadcast them while they are few."""
    key = ("doc_id", "text_hash", "text_hash2")
    text = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    rows = docs.select("doc_id", "text", *[h.alias(k) for h, k in zip(hashes, key[1:], strict=True)])
    marked = stored(fingerprints(rows, shingle, more=key[1:]), "fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("last"), *key)
    classes = marked.groupBy("fp").agg(F.min(own).alias("first"))
    known = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    named = _with_root(known, max_bits, block)
    # the smallest row of the component stays
    ends = named.select("root", "fp").join(named.groupBy("root").agg(F.min("first").alias("first")), "root")
    stays = F.coalesce(F.col("first").eqNullSafe(own) & F.col("first").isNotNull(), F.lit(False))
    decided = stored(marked.join(ends, "fp").select(*key, stays.alias("stays"))
                     .groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("stays").alias("stays")), "decided")
    gone = stored(decided.where("doc_id is not null").groupBy("doc_id").agg(F.max("stays").alias("stays"))
                  .where("not stays").select("doc_id"), "gone")
    rest = stored(decided.where("not stays or n > 1").join(gone, "doc_id", "left_anti"), "rest")
    names = list(docs.columns)
    for k in ("doc_key", *key[1:], "row_doc_id", "row_hash", "row_hash2"):
        names.append(free_name(names, k))
    mine, marks = names[len(docs.columns):][:3], names[len(docs.columns):][3:]
    keyed = docs.select("*", F.col("doc_id").cast("long").alias(mine[0]),
                        *[h.alias(m) for h, m in zip(hashes, mine[1:], strict=True)])
    pick = lambda which: rest.where(which).select(*[F.col(k).alias(m) for k, m in zip(key, marks, strict=True)])
    same = F.lit(True)
    for m, k in zip(mine, marks, strict=True):
        same = same & F.col(m).eqNullSafe(F.col(k))
    left = keyed.join(gone.select(F.col("doc_id").alias(marks[0])), F.col(mine[0]) == F.col(marks[0]), "left_anti")
    kept = left.join(pick("not stays"), same, "left_anti")
    again = pick("stays")
    row = F.struct(*[quoted(c) for c in docs.columns])
    plain = [F.col(quoted(f.name)) for f in docs.schema.fields
             if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    one = (kept.join(again, same, "left_semi").groupBy(*mine)
           .agg(F.min_by(row, F.xxhash64(*plain)).alias(marks[0])).select(f"{marks[0]}.*"))
    return kept.join(again, same, "left_anti").select(*[quoted(c) for c in docs.columns]).unionByName(one)
