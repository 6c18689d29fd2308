"""Quality classifier from weak labels (operator 1).

Heuristic labellers vote good, bad or abstain on each document; they overlap
and err. Expectation-maximisation over the vote patterns estimates the share
of good documents and how often each labeller votes what for either class, and
so the posterior of every pattern. The posteriors are the soft labels on which
a hashed linear scorer is trained: logistic regression over hashed words, word
shapes and shape pairs, each with its share of the document's words.

Scale: one scan makes the votes; there are at most 3**8 patterns, so their
counts are one small aggregate, and the estimation runs on that table. The
scorer is fitted in one task on about ``train_docs`` documents, chosen by a
hash of the id (a documented bound; whole texts), and its weights (2**16
floats) are broadcast to score every document where it is read.

Defined cases: null or wordless text gets the votes of all counts 0 and
the score of an empty sum; repeated rows are labelled alike; labellers
that never vote keep an even prior; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.quality_rules import text_features

DIMS = 1 << 16
TRAIN_DOCS = 4000
GOOD, BAD, NONE = 1, 0, 2
LABELLERS = ("repeats", "neighbours", "distinct", "symbols", "bare_marks", "short_words", "word_length", "capitals")
MARKS = frozenset(bytes([b]) for b in range(33, 127) if not chr(b).isalnum())


def counts_of(text: bytes | None) -> tuple:
    """n, words equal to the one before, different words, words that are one
    mark, words of up to three bytes, capitals, small letters."""
    text = text or b""
    words = text.split()
    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    return (n, sum(map(eq, words[1:], words)), len(set(words)), sum(map(MARKS.__contains__, words)),
            int((size <= 3).sum()), len(text) - len(text.translate(None, bytes(range(65, 91)))),
            len(text) - len(text.translate(None, bytes(range(97, 123)))))


def votes_of(texts: list) -> np.ndarray:
    """A row of votes for each text (UTF-8 bytes or None)."""
    q = {k: np.array(v, float) for k, v in text_features(texts).items()}
    n, same, kinds, bare, short, upper, lower = np.array([counts_of(t) for t in texts], float).reshape(-1, 7).T
    some = np.maximum(n, 1)
    width, caps = q["word_chars"] / some, upper / np.maximum(upper + lower, 1)
    vote = lambda good, bad: np.where(bad, BAD, np.where(good, GOOD, NONE))
    return np.stack([
        vote(q["n_repeat_words"] < 0.1 * some, (q["n_repeat_words"] > 0.35 * some) & (n > 30)),
        vote(same < 0.02 * some, same > 0.1 * some),
        vote((kinds > 0.5 * some) & (n > 20), (kinds < 0.3 * some) & (n > 40) & (n < 2000)),
        vote(q["n_symbols"] < 0.02 * some, q["n_symbols"] > 0.25 * some),
        vote(bare < 0.01 * some, bare > 0.1 * some),
        vote((short > 0.2 * some) & (bare < 0.1 * some), (short - bare < 0.12 * some) & (n > 30)),
        vote((width > 4) & (width < 6), ((width > 6.8) | (width < 2.5)) & (n > 15)),
        vote(caps < 0.1, caps > 0.5)], axis=1).astype(np.int64)


def with_votes(docs: DataFrame) -> DataFrame:
    """(doc_id, pattern): the votes as digits of a number to base 3."""
    base = 3 ** np.arange(len(LABELLERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = votes_of(batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((votes * base).sum(axis=1).astype(np.int64))],
                                             names=["doc_id", "pattern"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, pattern long")


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns (rows of votes) and their
    counts: the posterior of good for each pattern, the labellers' tables
    [class, labeller, vote] (bad, good), and the share of good documents."""
    hot = np.stack([patterns == v for v in (BAD, GOOD)], axis=2).astype(float)  # no vote is no evidence
    ups, downs = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
    post = (ups + 1) / (ups + downs + 2)  # the start: their majority
    table, share = np.full((2, patterns.shape[1], 2), 1 / 2), 0.5
    for _ in range(rounds):
        before = post
        weight = np.stack([counts * (1 - post), counts * post])
        table = np.einsum("cp,plv->clv", weight, hot) + 0.1
        table /= table.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        logs = np.einsum("plv,clv->cp", hot, np.log(table)) + np.log([[1 - share], [share]])
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(post - before).max(initial=0) < 1e-9:
            break
    return post, table, share


def shape_of(word: bytes) -> bytes:
    """A word's shape: runs of small letters, capitals and digits as one
    character each, the rest as it is."""
    return re.sub(rb"[A-Z]+", b"A", re.sub(rb"[0-9]+", b"0", re.sub(rb"[a-z\x80-\xff]+", b"a", word)))[:24]


class Hasher:
    """Hashed features of texts: per word the slots of the word and its shape,
    and of the shape pair that it ends; a word equal to the last has its own."""

    ROOM = 500_000  # different words kept at a time

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.table = np.zeros((2, 1024), np.int64)

    def _learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.number]
        if len(self.number) + len(fresh) > self.ROOM:
            self._clear()
            fresh = list(words)
        start = len(self.number)
        while start + len(fresh) > self.table.shape[1]:
            self.table = np.concatenate((self.table, np.zeros_like(self.table)), axis=1)
        for k, w in enumerate(fresh, start):
            self.number[w] = k
            self.table[:, k] = zlib.crc32(w.lower()) % DIMS, zlib.crc32(shape_of(w), 7) % DIMS

    def slots(self, text: bytes | None) -> np.ndarray:
        """(3, n) slots of a text's n words."""
        words = (text or b"").split()
        if not words:
            return np.zeros((3, 0), np.int64)
        try:
            ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        except KeyError:
            self._learn(set(words))
            ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        own, shape = self.table[:, ids]
        last = np.concatenate(([0], shape[:-1]))
        same = np.concatenate(([False], own[1:] == own[:-1]))
        pairs = (last * 31 + shape * 17 + 5) % (DIMS - 1)
        return np.stack([own, shape, np.where(same, DIMS - 1, pairs)])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, rate: float = 2.0) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression on soft
    labels, by stochastic gradient steps scaled per weight."""
    weights, squares = np.zeros(DIMS + 1), np.full(DIMS + 1, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            z = weights[at] @ x + weights[DIMS]
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[k]
            for where, slope in ((at, error * x), (np.array([DIMS]), np.array([error]))):
                squares[where] += slope * slope
                weights[where] -= rate * 0.1 * slope / np.sqrt(squares[where])
    return weights


def train(sample: DataFrame, posterior: dict[int, float]) -> np.ndarray:
    """Fit the scorer in one task on a bounded sample."""
    base = 3 ** np.arange(len(LABELLERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rows, labels = Hasher(), [], []
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            patterns = (votes_of(texts) * base).sum(axis=1).tolist() if texts else []
            for pattern, text in zip(patterns, texts, strict=True):
                slots = hasher.slots(text)
                at, n = np.unique(slots, return_counts=True)
                rows.append((at, n / max(1, slots.shape[1])))
                labels.append(posterior[pattern])
        weights = fit(rows, np.array(labels))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()])], names=["weights"])

    made = sample.select("text").repartition(1).mapInArrow(run, "weights binary").collect()
    return np.frombuffer(made[0]["weights"]) if made else np.zeros(DIMS + 1)


def classify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, weak (the posterior of the votes), score and keep (both agree
    by their mean), one row per document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = with_votes(narrow).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3**8 rows
    numbers = np.array(sorted((r["pattern"], r["n"]) for r in counted), np.int64).reshape(-1, 2)
    patterns = numbers[:, :1] // 3 ** np.arange(len(LABELLERS)) % 3
    post = estimate(patterns, numbers[:, 1].astype(float))[0] if len(numbers) else np.zeros(0)
    posterior = dict(zip(numbers[:, 0].tolist(), post.tolist(), strict=True))
    total = int(numbers[:, 1].sum())
    part = 1_000_000 if total <= train_docs else max(1, train_docs * 1_000_000 // total)
    chosen = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1_000_000)) < part
    weights = train(narrow.where(chosen), posterior) if total else np.zeros(DIMS + 1)

    shared = docs.sparkSession.sparkContext.broadcast((weights, posterior))
    base = 3 ** np.arange(len(LABELLERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (w, known) = Hasher(), shared.value
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            weak = [known[p] for p in (votes_of(texts) * base).sum(axis=1).tolist()] if texts else []
            slots = [hasher.slots(x) for x in texts]
            z = np.array([w[s].sum() / max(1, s.shape[1]) + w[DIMS] for s in slots], float)
            own = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weak, pa.float64()), pa.array(own),
                 pa.array((own + np.array(weak)) / 2 >= 0.5, pa.bool_())], names=["doc_id", "weak", "score", "keep"])

    return narrow.mapInArrow(run, "doc_id long, weak double, score double, keep boolean")
