"""Spelling variants by k-d trees over letter-count vectors (operator 13).

A word is a point: how often it has each letter. One replaced code point moves
it by 2 in L1 distance, one inserted or deleted code point by 1. So a word's
near words lie within 2 among the words of its own length and within 1 among
those one longer: one range search per pair of lengths, and each pair is found
once, from its shorter word (of one length: from the lower box, or in a box
from the smaller word).

**Two levels of trees.** The words of a length are cut into boxes by a k-d tree
of splits (letter, count). The splits are fitted on a bounded sample of words
(about ``sample`` of the distinct words, drawn by hash and taken to the driver)
until a box holds about ``box`` words; any splits give the same result, as
every word is put into its box and every search visits each box that its ball
may reach. A box and its searches meet in one task, which builds a k-d tree of
its own over the box, prunes by the bounding boxes of its leaves, and looks at
a leaf's words through 64-bit signatures before their letter counts. A box that grew
beyond twice ``box`` all the same (words of one letter count, or a poor sample)
is split into blocks by hash, and each search visits all of its blocks.

**Letter order.** What is left within the distance is verified: of one length,
exactly one position differs; else the longer word without one code point is
the shorter one.

Defined cases: null text has no words; a null id is written as the empty
text when occurrences are dealt with; words of any length are searched; equal
counts of near words go to the smallest word in code-point order; repeated
rows count; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import quoted, stored

#: The alphabet of the contract: a-z (A-Z lower-cased) and U+00C0 to U+00FF.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)])
MIN_LENGTH = 7
MIN_COUNT = 2
DROP = 31
RATIO = 10
SAMPLE = 100_000
BOX = 8_000
LEAF = 128
#: Comparisons at a time: what they need stays in a core's cache.
CELLS = 16_384
FLUSH = 200_000


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                drop: int = DROP) -> DataFrame:
    """(word, n): the words' occurrences, one row per word and part of a batch.

    A run shorter than ``min_length`` can't become a word, so only longer ones
    are taken. Where ``drop`` divides the CRC-32 of id and run, the run loses
    the code point at CRC-32 modulo its length."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, min_length))

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc32 = zlib.crc32
        counts: Counter = Counter()
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                raw = value.as_buffer()
                if raw is None:
                    continue
                start = crc32(f"{key.as_py() or ''}:".encode())
                for word, times in Counter(runs.findall(raw.to_pybytes().lower().decode("utf-8", "replace"))).items():
                    h = crc32(word.encode(), start)
                    if h % drop == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    counts[word] += times
                if len(counts) > FLUSH:
                    yield flush(counts)
                    counts = Counter()
        if counts:
            yield flush(counts)

    rows = docs.select(F.col(quoted(doc_id)).cast("string"), F.col(quoted(text)).cast("string"))
    return rows.mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, **names) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences."""
    found = occurrences(docs, min_length=min_length, **names)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def codes(words: list[str]) -> np.ndarray:
    """The code points of words of one length, one row per word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int32)


def letter_counts(points: np.ndarray, block: int = 4096) -> np.ndarray:
    """How often each row of code points has each letter of the alphabet."""
    slot = np.zeros(0x110000 if points.size and points.max() > 0xFF else 0x100, np.int64)
    slot[LETTERS] = np.arange(len(LETTERS))
    out = np.zeros((len(points), len(LETTERS)), np.int32)
    for k in range(0, len(points), block):
        part = slot[points[k:k + block]]
        flat = part + np.arange(len(part))[:, None] * len(LETTERS)
        out[k:k + block] = np.bincount(flat.ravel(), minlength=len(part) * len(LETTERS)).reshape(len(part), -1)
    return out


def best_split(points: np.ndarray) -> tuple[int, int] | None:
    """(letter, count) whose "at most count" side is nearest to half of the
    points; None if they are all the same point."""
    best = None
    for d in np.flatnonzero(points.min(axis=0) != points.max(axis=0)).tolist():
        share = np.cumsum(np.bincount(points[:, d])) / len(points)
        at = int(np.argmin(np.abs(share[:-1] - 0.5)))
        gap = abs(float(share[at]) - 0.5)
        if best is None or gap < best[0]:
            best = gap, d, at
    return best and best[1:]


def fit_splits(points: np.ndarray, scale: float, box: int):
    """Nested (letter, count, low side, high side, boxes below); None is a box.
    A sampled point stands for ``scale`` words."""
    if len(points) * scale <= box or len(points) < 4 or (split := best_split(points)) is None:
        return None
    low = points[:, split[0]] <= split[1]
    sides = fit_splits(points[low], scale, box), fit_splits(points[~low], scale, box)
    return *split, *sides, sum(boxes(side) for side in sides)


def boxes(splits) -> int:
    return 1 if splits is None else splits[4]


def route(splits, points: np.ndarray, reach: int) -> list[tuple[int, np.ndarray]]:
    """(box number, rows) for each box within ``reach`` of the points; a reach
    of 0 gives each point's own box."""
    out = []

    def outside(value, bounds):
        return np.maximum(np.maximum(bounds[0] - value, value - bounds[1]), 0)

    def walk(node, first, rows, apart, bounds):
        if not len(rows):
            return
        if node is None:
            out.append((first, rows))
            return
        letter, at, low, high, _ = node
        value = points[rows, letter]
        own = bounds.get(letter, (0, 1 << 30))
        for side, begin, new in ((low, first, (own[0], at)), (high, first + boxes(low), (at + 1, own[1]))):
            now = apart - outside(value, own) + outside(value, new)
            ok = now <= reach
            walk(side, begin, rows[ok], now[ok], bounds | {letter: new})

    walk(splits, 0, np.arange(len(points)), np.zeros(len(points), np.int64), {})
    return out


def signatures(points: np.ndarray) -> np.ndarray:
    """64 bits per point; each step of one letter's count flips one bit, so
    points differ in at most as many bits as their L1 distance."""
    out = np.zeros(len(points), np.uint64)
    for d in np.flatnonzero(points.any(axis=0)).tolist():
        count = points[:, d]
        spare = 52 + d % 12
        at = (d, 26 + d, spare) if d < 26 else (spare, spare, spare)
        for k, bit in enumerate(at[:2]):
            out ^= (count > k).astype(np.uint64) << np.uint64(bit)
        out ^= (np.maximum(count - 2, 0) & 1).astype(np.uint64) << np.uint64(at[2])
    return out


def unary(points: np.ndarray) -> np.ndarray:
    """64 bits per point: for each letter, whether it is there and whether it
    is there twice. Accented letters share bits, so a missing bit is certain
    and points that differ in k bits have an L1 distance of k at least."""
    out = np.zeros(len(points), np.uint64)
    for d in np.flatnonzero(points.any(axis=0)).tolist():
        for k, bit in enumerate((d, 26 + d) if d < 26 else (52 + d % 12,)):
            out |= (points[:, d] > k).astype(np.uint64) << np.uint64(bit)
    return out


class Box:
    """The words of one box, with a k-d tree of its own over them."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts, self.spelt = words, counts, codes(words)
        self.points = letter_counts(self.spelt)
        self.marks = signatures(self.points)
        self.leaves = [rows for _, rows in route(fit_splits(self.points, 1.0, LEAF), self.points, 0)]
        steps = unary(self.points)
        # the leaves' bounding boxes: steps that all of a leaf's words have, and that any of them has
        self.low = np.array([np.bitwise_and.reduce(steps[rows]) for rows in self.leaves])
        self.beyond = np.array([~np.bitwise_or.reduce(steps[rows]) for rows in self.leaves])

    def search(self, asked: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows of ``asked``, rows of the box) whose L1 distance is exactly
        ``reach`` (one edit gives no other)."""
        marks, steps = signatures(asked), unary(asked)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        apart = np.bitwise_count(steps[:, None] & self.beyond) + np.bitwise_count(~steps[:, None] & self.low)
        for own, reached in zip(self.leaves, (apart <= reach).T, strict=True):
            rows = np.flatnonzero(reached)
            for k in range(0, len(own), 4096):
                part = own[k:k + 4096]
                near, step = self.marks[part], max(1, CELLS // len(part))
                for j in range(0, len(rows), step):
                    some = rows[j:j + step]
                    hits = np.flatnonzero(np.bitwise_count(marks[some][:, None] ^ near) <= reach)
                    found.append((some[hits // len(part)], part[hits % len(part)]))
        q, p = (np.concatenate(x) for x in zip(*found, strict=True))
        exact = [np.abs(asked[q[k:k + CELLS]] - self.points[p[k:k + CELLS]]).sum(axis=1) == reach for k in range(0, len(q), CELLS)]
        ok = np.concatenate(exact) if exact else np.zeros(0, bool)
        return q[ok], p[ok]


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of code points are one replacement (of one length) or one
    insertion apart."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(axis=1) == 1
    ahead = np.cumprod(short == long[:, :n], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return ahead + behind >= n


def near_pairs(words: DataFrame, sample: int = SAMPLE, box: int = BOX) -> DataFrame:
    """(a, n_a, b, n_b): each pair of near words of the stored table
    (word, n) once."""
    sized = words.select("word", "n", F.length("word").cast("int").alias("length"))
    totals = {r["length"]: r["count"] for r in sized.groupBy("length").count().collect()}
    if not totals:
        return words.sparkSession.createDataFrame([], "a string, n_a long, b string, n_b long")
    share = min(1.0, sample / sum(totals.values()))
    drawn = sized.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("word", "length").collect()
    scale = max(1.0, sum(totals.values()) / max(1, len(drawn)))
    by_length: dict[int, list[str]] = {}
    for r in drawn:
        by_length.setdefault(r["length"], []).append(r["word"])
    trees = {k: fit_splits(letter_counts(codes(v)), scale, box) for k, v in by_length.items()}
    lengths = set(totals)

    def place(asks: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                all_lengths = batch.column("length").to_numpy()
                for n in np.unique(all_lengths).tolist():
                    part = batch.filter(pa.array(all_lengths == n))
                    points = letter_counts(codes(part.column("word").to_pylist()))
                    home = np.zeros(len(points), np.int64)
                    for number, rows in route(trees.get(n), points, 0):
                        home[rows] = number
                        yield placed_rows(part, rows, n, number, 0)
                    if not asks:
                        continue
                    # of two boxes of one length the lower one's words search the higher one
                    for number, rows in route(trees.get(n), points, 2):
                        yield placed_rows(part, rows[home[rows] == number], n, number, 1)
                        yield placed_rows(part, rows[home[rows] < number], n, number, 2)
                    if n + 1 in lengths:
                        for number, rows in route(trees.get(n + 1), points, 1):
                            yield placed_rows(part, rows, n + 1, number, 3)

        return sized.mapInArrow(run, "length int, box int, role int, word string, n long")

    def placed_rows(part, rows, length, number, role):
        """Rows of a box: role 0 are its words; 1 its own words as searches, 2
        words of its length, 3 words one shorter."""
        some, k = part.take(pa.array(rows)), len(rows)
        return pa.RecordBatch.from_arrays([*(pa.array(np.full(k, x, np.int32)) for x in (length, number, role)),
                                           some.column("word"), some.column("n")], names=["length", "box", "role", "word", "n"])

    own = place(False).groupBy("length", "box").agg(F.ceil(F.count(F.lit(1)) / (2 * box)).cast("int").alias("blocks"))
    # a box that is too large is several blocks by hash: a word is in one, a search visits all
    dealt = place(True).join(own, ["length", "box"]).withColumn("block", F.explode(
        F.when(F.col("role") > 0, F.sequence(F.lit(0), F.col("blocks") - 1))
        .otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))))).drop("blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ask(box: Box, role: int, asking: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts, counts = asking.column("word").to_pylist(), asking.column("n").to_numpy()
            for k in range(0, len(texts), 4096):
                words, times = texts[k:k + 4096], counts[k:k + 4096]
                spelt = codes(words)
                q, p = box.search(letter_counts(spelt), 1 if role == 3 else 2)
                ok = one_edit(spelt[q], box.spelt[p])
                both = [(i, j) for i, j in zip(q[ok].tolist(), p[ok].tolist(), strict=True) if role != 1 or words[i] < box.words[j]]
                if both:
                    q, p = np.array(both).T
                    yield pa.RecordBatch.from_arrays([pa.array([words[i] for i, _ in both]), pa.array(times[q]),
                                                      pa.array([box.words[j] for _, j in both]), pa.array(box.counts[p])],
                                                     names=["a", "n_a", "b", "n_b"])

        key = tree = None
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("length", "box", "block", "role")])
            cuts = [0, *(np.flatnonzero((np.diff(ids, axis=1) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part, now = batch.slice(a, b - a), tuple(ids[:3, a].tolist())
                if now != key:
                    key, tree, waiting = now, None, []
                if not ids[3, a]:
                    waiting.append(part)
                    continue
                if tree is None and waiting:
                    table = pa.Table.from_batches(waiting)
                    tree = Box(table.column("word").to_pylist(), table.column("n").to_numpy())
                if tree is not None:
                    yield from ask(tree, int(ids[3, a]), part)

    keys = ["length", "box", "block"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(
        search, "a string, n_a long, b string, n_b long")


def best_forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n: the form is the near word of most
    occurrences, where it has at least ``ratio`` times the word's own."""
    both = pairs.select(F.col("a").alias("near_of"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("near_of"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("near_of").agg(F.count(F.lit(1)).alias("n_near"),
                                       F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, F.col("word") == F.col("near_of"), "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by doubling: each round a word
    jumps to what its target points at. Occurrences rise along a chain, so it
    ends."""
    now = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("via"), F.col("root").alias("next"))
        step = stored(now.join(ahead, F.col("root") == F.col("via"), "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, sample: int = SAMPLE, box: int = BOX, ratio: int = RATIO, **names) -> DataFrame:
    """word, n, n_near, form, form_n, root: one row per word."""
    words = stored(vocabulary(docs, **names), "words")
    forms = stored(best_forms(words, near_pairs(words, sample, box), ratio), "variants")
    ends = roots(forms).withColumnRenamed("word", "rooted")
    return forms.join(ends, F.col("word") == F.col("rooted"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
