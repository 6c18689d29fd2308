"""Mixing sources to target weights by weighted fair queueing (operator 10).

Every source is a queue. Its documents stand in a shuffled order (a hash of
the id), pass after pass while repeats are needed; a document's virtual finish
time is the running word count of its queue divided by the queue's target, so
all queues reach time 1 together; a document that would end later stands aside
for the next that fits. The mix is the documents in the order of
their finish times, cut at the total budget: the words of all documents.

A queue's target is its weight's share of the budget, at most ``max_passes``
times its own words; what a queue can't use goes to the others by weight
(water filling: the first level, in the order of the ratio of limit to weight,
at which the rest fits).

DataFrame functions only. Scale: the texts are read once, for the word counts;
everything after that handles rows of a few numbers. Running sums never need a
source, or the order, in one task: the shuffled order and the finish times are
cut into as many ranges as keep a thousand or so rows each, sums per range are
aggregated first, and a window runs only inside one range of one source. Only
the sums per range and per source meet in a window without rows of documents.

Defined cases: null or wordless text has size 0 and is never taken; a null
source is a source, last in the order; a null id is an id; repeated rows are
documents of their own; ties in the hash go by id, then size; an empty table
gives an empty result; extra columns are ignored, and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, quoted, stored, word_count

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
RANGE_ROWS = 1024


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and twin: repeated rows get numbers from 1."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return (rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("twin")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, longest (document), target: one row per source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("longest"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    queues = (sums.select("source", "source_size", "longest", weight.alias("weight"),
                          (F.col("source_size") * float(max_passes)).alias("most"))
              .withColumn("ratio", F.col("most") / F.col("weight")))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(Window.partitionBy())
    level = queues.withColumn("level", (budget - before) / after)
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(Window.partitionBy())
    target = F.when(fits.isNull() | (F.col("ratio") < fits["level"]), F.col("most")) \
        .otherwise(F.col("weight") * fits["level"])
    return level.select("source", "source_size", "longest", F.least(target, F.col("most")).alias("target"))


def queue_words(sizes: DataFrame, targets: DataFrame, ranges: int, max_passes: int = MAX_PASSES,
                 seed: int = 0) -> DataFrame:
    """One row per document and pass that its queue may reach, with ``done``:
    the queue's words up to its end (over the target: its finish time)."""
    named = targets.select(F.col("source").alias("q"), "source_size", "longest", "target")
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("q")), "left").drop("q")
    reach = F.filter(F.sequence(F.lit(0), F.lit(max_passes - 1)), lambda k: (k == 0) | (k * F.col("source_size") <= F.col("target")))
    rows = rows.withColumn("pass", F.explode(reach))
    mixed = F.xxhash64(F.lit(seed), "doc_id", "size", "twin", "pass")
    rows = rows.withColumn("draw", mixed).withColumn("part", F.pmod("draw", F.lit(ranges)))
    by = ["source", "pass", "part"]
    parts = rows.groupBy(*by).agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("source", "pass").orderBy("part")
                                .rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("source").alias("s"), F.col("pass").alias("p"), F.col("part").alias("r"),
                         F.coalesce(ahead, F.lit(0)).alias("ahead"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("pass") == F.col("p")) & (F.col("part") == F.col("r"))
    own = F.sum("size").over(Window.partitionBy(*by).orderBy("draw", "doc_id", "size", "twin")
                             .rowsBetween(Window.unboundedPreceding, 0))
    done = F.col("pass") * F.col("source_size") + F.col("ahead") + own
    return (rows.join(parts, same, "left").drop("s", "p", "r")
            .withColumn("done", done))


def fill(queued: DataFrame, aside: int = 4, rounds: int = 4) -> DataFrame:
    """``queued`` with the finish times at which documents really leave.

    A document that would end past its queue's target stands aside, and later
    ones that still fit move up; who never fits has no finish time. Looked at
    are the documents within ``aside`` longest documents behind the target, so
    a queue's window has a few rows however long the queue is."""
    ends = F.col("target") + aside * F.col("longest")
    near = (F.col("done") > F.col("target")) & (F.col("done") <= ends) & (F.col("target") > 0) & (F.col("size") > 0)
    in_time = F.col("done") <= F.col("target")
    names = queued.columns
    base = queued.where(in_time).groupBy("source").agg(F.max("done").alias("full"))
    base = base.select(F.col("source").alias("s"), "full")
    queue = Window.partitionBy("source")
    order = queue.orderBy("done", "draw", "doc_id", "twin").rowsBetween(Window.unboundedPreceding, 0)
    rows = queued.where(near).join(base, F.col("source").eqNullSafe(F.col("s")), "left")
    rows = rows.withColumn("gap", F.col("target") - F.coalesce("full", F.lit(0))).withColumn("at", F.lit(None).cast("double"))
    small = F.col("at").isNull() & (F.col("size") <= F.col("gap"))
    place = (F.col("target") - F.col("gap") + F.col("sum")) / F.col("target")
    for _ in range(rounds):
        rows = rows.withColumn("sum", F.sum(F.when(small, F.col("size"))).over(order))
        rows = rows.withColumn("fits", small & (F.col("sum") <= F.col("gap")))
        rows = rows.withColumn("at", F.when(F.col("fits"), place).otherwise(F.col("at")))
        moved = F.coalesce(F.max(F.when(F.col("fits"), F.col("sum"))).over(queue), F.lit(0))
        rows = rows.withColumn("gap", F.col("gap") - moved)
    finish = F.col("done") / F.col("target")
    parts = [queued.where(in_time).withColumn("finish", F.when(F.col("target") > 0, finish)),
             rows.select(*names, F.col("at").alias("finish")),
             queued.where(~in_time & ~near).withColumn("finish", F.lit(None).cast("double"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def take(queued: DataFrame, budget: int, ranges: int) -> DataFrame:
    """``queued`` with ``into``: whether the row is in the mix. The finish
    times (0 to 1) are cut into ranges, and each range is sorted by itself."""
    late = F.col("finish").isNull()
    rows = queued.where(~late).withColumn("slot", F.floor(F.col("finish") * ranges))
    slots = rows.groupBy("slot").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    slots = slots.select(F.col("slot").alias("k"), F.coalesce(ahead, F.lit(0)).alias("ready"))
    own = F.sum("size").over(Window.partitionBy("slot").orderBy("finish", "source", "draw", "doc_id", "size", "twin")
                             .rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.join(slots, F.col("slot") == F.col("k"), "left").withColumn("into", F.col("ready") + own <= budget)
    return placed.select(*queued.columns, "into").unionByName(queued.where(late).withColumn("into", F.lit(False)))


def mixed_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = 0,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken; one row per document."""
    sizes = stored(document_sizes(docs), "sizes")
    total = sizes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    ranges = max(1, -(-total["n"] // range_rows))
    targets = stored(source_targets(sizes, weights, max_passes), "targets")
    queued = stored(fill(stored(queue_words(sizes, targets, ranges, max_passes, seed), "queued")), "finish")
    chosen = take(queued, total["words"], ranges)
    by = ["doc_id", "source", "size", "twin"]
    return chosen.groupBy(*by).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum(F.when(F.col("into"), F.col("size")).otherwise(F.lit(0).cast("long"))).alias("taken")).drop("twin")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """The mix itself: the documents' rows, as often as they are taken. Rows
    that agree in id, source and size share what they are taken, rounded up."""
    taken = mixed_sizes(docs, weights, max_passes, seed).where("taken > 0").groupBy("doc_id", "source", "size").agg(
        F.ceil(F.sum(F.col("taken") / F.col("size")) / F.count(F.lit(1))).cast("int").alias("times"))
    names = [free_name(docs.columns, f"mix_{c}") for c in taken.columns]
    size = free_name([*docs.columns, *names], "words")
    rows = docs.withColumn(size, word_count(F.col("text")))
    same = (F.col("doc_id").eqNullSafe(F.col(names[0])) & F.col("source").eqNullSafe(F.col(names[1]))
            & (F.col(size) == F.col(names[2])))
    turn = free_name([*rows.columns, *names], "turn")
    out = rows.join(taken.toDF(*names), same)
    return out.select(*[quoted(c) for c in docs.columns], F.explode(F.sequence(F.lit(1), names[3])).alias(turn)) \
        .drop(turn)
