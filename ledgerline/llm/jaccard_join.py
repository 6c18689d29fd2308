"""N-gram Jaccard join by several global orders (operator 12).

A document's set is its distinct word shingles, each as the XXH64 of its
words. Under any total order of the shingles, two sets whose Jaccard
similarity reaches ``t`` share one of the first ``n - ceil(t * n) + 1``
shingles (the prefix) of each. So they share a prefix shingle under every
order, and a pair that lacks one under a single order is out.

**Orders.** Each order puts rare shingles first, by a different reading of
their count and with ties broken by a different hash. What has to be known of
counts is found without moving all shingles:

1. Rows with the same set are one class.
2. Each class posts a *run*, its shingles of smallest hash. A shingle that no
   other class posts is its own. Among the first ``head`` shingles of its run,
   a class that has a similar one can have fewer own ones than its prefix is
   long: it has no more shingles that the other lacks, and what the other has
   of its head lies in the other's run, which is longer than any head of a
   similar class by a prefix. So a class with as many own ones is linked with
   nothing, and is out.
3. Those left post their whole sets, made again from the text of one row each,
   and are judged once more by all of their shingles. What is left has a count
   for each shingle that another one has.

**Filters, intersected.** Of the classes left, each posts its prefix under
every order. A class stays only if it meets another one in every order, and a
pair is verified only if it shares a prefix shingle in each of them and its
sizes allow the similarity.

**Posting lists.** Lists of the first order with the same members are one
list. A list is searched in one task, with the members' shingles that others
have too: a search takes every unvisited near member at once, so a list gives a
spanning forest of its links, not all its pairs, and no link between different
components is lost. A list with more than ``block`` shingles is split into
blocks, and every pair of blocks is a unit of its own, so that no task holds
more than two blocks; nothing is capped. (A list of n members none of which
are similar, though all pass every filter, takes n * n / 2 comparisons.)

Defined cases: null or wordless text has an empty set, is linked with nothing
and is its own component; fewer words than a shingle make one shingle of the
whole sequence; repeated rows and copies are of one class; a component without
any id has a null id; rows of one id are judged each by its own text; an empty
table gives an empty result; extra columns are ignored. Memory follows a
text's own length, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import quoted, stored
from ledgerline.llm.graph import components

SHINGLE = 3
#: A similarity of 90 / 100.
THRESHOLD = (90, 100)
#: Shingles of a block of a posting list.
BLOCK = 1_000_000
ORDERS = 3
#: Classes (32 bytes each) that are told to the tasks instead of joined.
FEW = 500_000


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted XXH64 of the distinct shingles of a text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    starts = [0, *stops[:n - 1].tolist()]
    del words
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b]) for a, b in zip(starts, (stops[last:last + n] - 1).tolist(), strict=True)),
                         np.uint64, n)
    return np.unique(hashes)


def needed(n, threshold: tuple[int, int] = THRESHOLD):
    """Shingles that a set of ``n`` shares at least with any similar set."""
    return -(-n * threshold[0] // threshold[1])


def class_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    two = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
    return int(two[0]), int(two[1])


def prefix_length(n, threshold: tuple[int, int] = THRESHOLD):
    return n - needed(n, threshold) + 1


def run_lengths(n: int, threshold: tuple[int, int] = THRESHOLD) -> tuple[int, int]:
    """How many shingles of smallest hash a set of ``n`` is judged by, and how
    many it posts: as many as the largest similar set is judged by, and a
    prefix more."""
    head = lambda m: -(-3 * prefix_length(m, threshold) // 2)
    return head(n), head(n * threshold[1] // threshold[0]) + prefix_length(n, threshold)


def lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64()))


def text_of(value: pa.Scalar) -> bytes | None:
    buffer = value.as_buffer()
    return None if buffer is None else buffer.to_pybytes()


def with_row_hash(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, row_hash, text): the hash of a row's id and text."""
    value, own = F.col(quoted(text)).cast("string"), F.col(quoted(doc_id)).cast("long")
    return docs.select(own.alias("doc_id"), F.xxhash64(own, value).alias("row_hash"), value.alias("text"))


def scan(docs: DataFrame, shingle: int, threshold: tuple[int, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, row_hash, n, key1, key2, head, run): one row per row of ``docs``."""
    schema = "doc_id long, row_hash long, n long, key1 long, key2 long, head int, run array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, runs = [], []
            for value in batch.column(2):
                found = shingle_set(text_of(value), shingle)
                head, posted = run_lengths(len(found), threshold)
                rows.append((len(found), *class_key(found), head))
                runs.append(found[:posted].view(np.int64).copy())
            n, one, two, heads = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (n, one, two)), pa.array(heads, pa.int32()),
                 lists(runs)], names=["doc_id", "row_hash", "n", "key1", "key2", "head", "run"])

    return with_row_hash(docs, doc_id, text).mapInArrow(run, schema)


def own_counts(postings: DataFrame) -> DataFrame:
    """(node, own): how many counting tokens only one node posts (token, node,
    counts). One aggregation; copies of a node's postings change nothing."""
    one = postings.groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("other"), F.max("counts").alias("counts"))
    return one.where("node = other and counts").groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def short_of_own(classes: DataFrame, own: DataFrame, node: str, threshold: tuple[int, int]) -> DataFrame:
    """The classes with fewer own tokens than their prefix is long."""
    prefix = F.col("n") - F.expr(f"(n * {threshold[0]} + {threshold[1] - 1}) div {threshold[1]}") + 1
    named = own.withColumnRenamed("node", "own_node")
    return classes.join(named, F.col(node) == F.col("own_node"), "left").where(F.coalesce("own", F.lit(0)) < prefix).drop("own", "own_node")


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int, doc_id: str, text: str, few: int = FEW) -> DataFrame:
    """(node, tokens) of the classes ``wanted`` (stored; node, rep_hash, key1,
    key2), made again from the text of each one's representative row. Up to
    ``few`` classes are told to the tasks, and no text is moved; more are
    joined. Rows that are equal in id and text give the same row again."""
    rows = with_row_hash(docs, doc_id, text).select("row_hash", "text")
    known = None
    if wanted.limit(few + 1).count() <= few:
        told = wanted.select("rep_hash", "node", "key1", "key2").toPandas().sort_values("rep_hash")
        if told["rep_hash"].is_unique:
            known = told.to_numpy(np.int64)
    if known is None:
        rows = rows.join(wanted, F.col("row_hash") == F.col("rep_hash")).select("row_hash", "text", "node", "key1", "key2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if known is None:
                picked, names = range(batch.num_rows), np.stack([c.to_numpy() for c in batch.columns[2:]], axis=1)
            else:
                hashes = batch.column(0).to_numpy()
                at = np.minimum(np.searchsorted(known[:, 0], hashes), max(0, len(known) - 1))
                picked = np.flatnonzero(known[at, 0] == hashes).tolist() if len(known) else []
                names = known[at, 1:] if len(known) else known
            nodes, sets = [], []
            for i in picked:
                made = shingle_set(text_of(batch.column(1)[i]), shingle)
                if class_key(made) == (names[i, 1], names[i, 2]):  # another row may share the hash
                    nodes.append(names[i, 0])
                    sets.append(made.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists(sets)], names=["node", "tokens"])

    return rows.mapInArrow(run, "node long, tokens array<long>")


def live_sets(docs: DataFrame, classes: DataFrame, runs: DataFrame, shingle: int, threshold: tuple[int, int], doc_id: str,
              text: str, few: int = FEW) -> DataFrame:
    """(node, n, tokens: array of (n_posts, token), shared ones only) of the
    classes that may be linked. ``runs``: (key1, head, run)."""
    posted = runs.select("key1", "head", F.posexplode("run").alias("at", "token"))
    heads = own_counts(posted.select("token", F.col("key1").alias("node"), (F.col("at") < F.col("head")).alias("counts")))
    left = stored(short_of_own(classes, heads, "key1", threshold), "left")
    sets = stored(whole_sets(docs, left, shingle, doc_id, text, few), "sets")
    tokens = sets.select("node", F.explode("tokens").alias("token"))
    live = stored(short_of_own(left, own_counts(tokens.withColumn("counts", F.lit(True))), "node", threshold).select("node", "n"), "live")
    told = sets.join(live, "node").select("node", "n", F.explode("tokens").alias("token"))
    shared = told.groupBy("token").agg(F.count(F.lit(1)).alias("n_posts"), F.min("node").alias("a"), F.max("node").alias("b")) \
        .where("a < b").select("token", "n_posts")
    return told.join(shared, "token").groupBy("node").agg(F.max("n").alias("n"), F.collect_set(F.struct("n_posts", "token")).alias("tokens"))


def mixed(tokens: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of 64-bit hashes, one for each seed (multiply and shift)."""
    x = tokens.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def prefixes(n: int, tokens: np.ndarray, counts: np.ndarray, threshold: tuple[int, int], orders: int) -> list[np.ndarray]:
    """Positions in ``tokens`` (the shared ones) of the prefix under each
    order; own tokens come first in all of them."""
    length = prefix_length(n, threshold) - (n - len(tokens))
    out = []
    for k in range(orders):
        # counts as they are, then in powers of two, in powers of four ...
        rank = counts if not k else np.floor(np.log2(counts) / k).astype(np.int64)
        out.append(np.lexsort((mixed(tokens, k), rank))[:max(0, length)])
    return out


def with_prefixes(live: DataFrame, threshold: tuple[int, int], orders: int) -> DataFrame:
    """(node, n, tokens, prefixes): tokens sorted; a prefix is tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.int64()))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets, heads = [], []
                for n, row in zip(part.column(1).to_pylist(), part.column(2), strict=True):
                    values = row.values
                    counts, tokens = (values.field(f).to_numpy() for f in ("n_posts", "token"))
                    order = np.argsort(tokens)
                    tokens, counts = tokens[order], counts[order]
                    sets.append(tokens)
                    heads.append([tokens[p] for p in prefixes(n, tokens, counts, threshold, orders)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.list_(pa.int64())), pa.array(heads, kind)],
                                                 names=["node", "n", "tokens", "prefixes"])

    return live.mapInArrow(run, "node long, n long, tokens array<long>, prefixes array<array<long>>")


def similar(a: int, sizes: np.ndarray, shared: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    return threshold[1] * shared >= threshold[0] * (a + sizes - shared)


def flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated lists and where each begins."""
    return np.concatenate(lists), np.cumsum([0, *map(len, lists[:-1])])


def forest(sizes: np.ndarray, sets: list[np.ndarray], heads: list[list[np.ndarray]],
           threshold: tuple[int, int] = THRESHOLD) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the similar sets: filtered by
    size and by a shared prefix token under every order, then verified."""
    every, _ = flat(sets)
    names = np.unique(every)
    number = lambda lists: [np.searchsorted(names, x) for x in lists]
    members, heads = number(sets), [number(h) for h in zip(*heads, strict=True)]
    mark = np.zeros(len(names), bool)
    edges, rest = [], np.arange(len(sets))
    queue: list[int] = []

    def tables(rows):
        return [flat([h[i] for i in rows.tolist()]) for h in heads], flat([members[i] for i in rows.tolist()])

    tabled, (head_tables, whole) = rest, tables(rest)
    left = np.ones(len(sets), bool)
    while len(rest):
        if not queue:
            queue.append(int(rest[0]))
            left[rest[0]] = False
        at = queue.pop()
        rest = tabled[left[tabled]]
        if 2 * len(rest) < len(tabled) and len(rest):
            tabled, (head_tables, whole) = rest, tables(rest)
        if not len(rest):
            break
        ok = left[tabled] & (threshold[1] * np.minimum(sizes[at], sizes[tabled]) >= threshold[0] * np.maximum(sizes[at], sizes[tabled]))
        for head, (values, starts) in zip(heads, head_tables, strict=True):
            mark[head[at]] = True
            ok &= np.logical_or.reduceat(mark[values], starts)
            mark[head[at]] = False
        if ok.any():
            mark[members[at]] = True
            shared = np.add.reduceat(mark[whole[0]].astype(np.int32), whole[1])
            mark[members[at]] = False
            ok &= similar(int(sizes[at]), sizes[tabled], shared, threshold)
            found = tabled[ok]
            edges += [(at, x) for x in found.tolist()]
            queue += found.tolist()
            left[found] = False
            rest = tabled[left[tabled]]
    return edges


def links(live: DataFrame, threshold: tuple[int, int] = THRESHOLD, block: int = BLOCK, orders: int = ORDERS) -> DataFrame:
    """(a, b): links between classes (node, n, tokens) that span their
    components."""
    table = stored(with_prefixes(live, threshold, orders), "prefixes")
    posts = table.select("node", F.posexplode("prefixes").alias("ord", "prefix")).select("node", "ord", F.explode("prefix").alias("token"))
    met = posts.groupBy("ord", "token").agg(F.count(F.lit(1)).alias("n_list")).where("n_list > 1").drop("n_list")
    meets = posts.join(met, ["ord", "token"]).groupBy("node").agg(F.count_distinct("ord").alias("k")).where(F.col("k") == orders)
    kept = stored(table.join(meets.select("node"), "node"), "kept")
    lists = kept.select("node", F.size("tokens").alias("size"), F.explode(F.col("prefixes")[0]).alias("token"))
    marks = lists.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("size_sum"),
                                       F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum1"),
                                       F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(20,0)")).alias("sum2")).where("members > 1")
    alone = marks.groupBy("members", "size_sum", "sum1", "sum2").agg(F.min("token").alias("token")) \
        .select("token", F.ceil(F.col("size_sum") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # block i meets every block j: unit (min, max); one block: the single unit (0, 0)
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    units = lists.select("node", "token").join(alone, "token").select("token", "node", F.explode(pair).alias("unit")) \
        .select("token", "unit.i", "unit.j", "node").join(kept, "node")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        last = None

        def flush() -> list[pa.RecordBatch]:
            if len(held) < 2:
                return []
            nodes = np.array([r[0] for r in held])
            pairs = forest(np.array([r[1] for r in held]), [r[2] for r in held], [r[3] for r in held], threshold)
            if not pairs:
                return []
            x = np.array(pairs)
            return [pa.RecordBatch.from_arrays([pa.array(nodes[x[:, 0]]), pa.array(nodes[x[:, 1]])], names=["a", "b"])]

        for batch in batches:
            ids = list(zip(*(batch.column(c).to_pylist() for c in ("token", "i", "j")), strict=True))
            rows = zip(ids, batch.column("node").to_pylist(), batch.column("n").to_pylist(), batch.column("tokens"),
                       batch.column("prefixes"), strict=True)
            for unit, node, n, tokens, heads in rows:
                if unit != last:
                    yield from flush()
                    held.clear()
                    last = unit
                held.append((node, n, tokens.values.to_numpy().copy(), [h.values.to_numpy().copy() for h in heads]))
        yield from flush()

    keys = ["token", "i", "j"]
    return units.select(*keys, "node", "n", "tokens", "prefixes").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(search, "a long, b long")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, block: int = BLOCK,
                       orders: int = ORDERS, doc_id: str = "doc_id", text: str = "text", few: int = FEW) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row of ``docs``."""
    scanned = stored(scan(docs, shingle, threshold, doc_id, text), "scan")
    filled = scanned.where("n > 0")
    # numbered apart from the ids, which may repeat or be missing
    classes = stored(filled.groupBy("key1", "key2").agg(F.max("n").alias("n"), F.min("doc_id").alias("least"), F.min("row_hash").alias("rep_hash"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")
    live = live_sets(docs, classes, filled.select("key1", "head", "run"), shingle, threshold, doc_id, text, few)
    roots = stored(components(links(live, threshold, block, orders)), "roots")
    linked = classes.select("node", "key1", "key2", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("key1", "key2", "component_id")
    placed = filled.select("doc_id", "n", "key1", "key2").join(named, ["key1", "key2"])
    return placed.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        scanned.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
