"""Benchmark decontamination by a generalised suffix automaton (operator 2).

The normalised test items (words in lower case) make one automaton whose
states are the sets of word sequences with the same ends in the items. A
document's words run through it once; after each word the automaton holds the
longest sequence of item words that ends there. Where that length reaches the
window, the last ``window`` words are a window of every item in the state's
set, and the words are hit. An item of fewer words than the window is one
window itself.

Scale: documents are only scanned, never shuffled. The items are read to the
driver one block at a time (at most ``block_words`` words) and broadcast in
groups of at most ``group_bytes``; a larger benchmark takes further passes of
the same scan, so neither the driver nor a task ever holds more than that.
Words outside the items, and word pairs that no item has, are skipped by
numpy before the automaton walks the rest. A task has the words of one text at
a time, and the last pass also cuts, so a task has one Python worker a pass.

Defined cases: null or wordless text has no words and no hits; an item without
words or text is no window; an item without id marks words but is not listed;
an empty table gives an empty result and an empty benchmark no hits; repeated
rows are judged alike; extra columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import PIECE_BYTES, append_struct, free_name, quoted

WINDOW = 10
BLOCK_WORDS = 100_000
GROUP_BYTES = 128 << 20
#: Automata that a task has at a time.
KEPT = 4
#: A-Z to a-z; every other ASCII character that is no letter or digit to a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()),
                                                     T.StructField("stop", T.IntegerType())])))])
#: With the text that is left where there are hits.
CUT = T.StructType([*HITS.fields, T.StructField("left", T.StringType())])


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


class Automaton:
    """Generalised suffix automaton over the word numbers of a block of items."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, int | None]]] = {}
        pairs, self.least = set(), window
        for item, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            pairs.update(zip(ids, ids[1:], strict=False))
            self.least = min(self.least, len(ids))
            last = 0
            for word in ids:
                last = self._extend(last, word)
                ends.setdefault(last, set()).add(item)
        for item, words in items:  # states are final only now
            if len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][self.vocab[w]]
                self.short.setdefault(state, []).append((len(words), item))
        self.size = len(self.vocab)
        self.pairs = np.array(sorted(a * self.size + b for a, b in pairs), np.int64)
        self._gather(ends)

    def _add(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for the longest sequence of ``state`` and ``word``, made
        from the one it shares with longer sequences when it has to be."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # another item has been here
            return self._split(last, word)
        new = self._add(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def _gather(self, ends: dict[int, set]) -> None:
        """The items of each state that stands for a whole window, and for
        every longer state the window state above it."""
        w, self.items, self.top = self.window, {}, {}
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for s in order:
            if self.length[s] >= w:
                self.top[s] = s if self.length[self.link[s]] < w else self.top[self.link[s]]
        for s, found in ends.items():
            if s in self.top:
                self.items.setdefault(self.top[s], set()).update(found)
        self.chain: dict[int, list] = {0: []}
        if self.short:
            for s in order:
                self.chain[s] = self.short.get(s, []) + self.chain[self.link[s]]

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Maximal stretches [a, b) of words in which an occurrence can lie."""
        inside = ids >= 0
        if self.least == 1:
            steps, extra = inside, 0
        else:
            keys = ids[:-1] * self.size + ids[1:]
            steps, extra = inside[:-1] & inside[1:], 1
            at = np.flatnonzero(steps)
            if len(at):
                place = np.searchsorted(self.pairs, keys[at])
                steps[at] = self.pairs[np.minimum(place, len(self.pairs) - 1)] == keys[at]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], steps.view(np.int8), [0]))))
        need = max(1, self.least - 1) if extra else 1
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= need:
                yield a, b + extra

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (merged, in words) and the items with an occurring window."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        if not self.vocab or len(words) < self.least:
            return spans, items
        get = self.vocab.get
        ids = np.fromiter((get(x, -1) for x in words), np.int64, len(words))
        for a, b in self.runs(ids):
            state = size = 0
            for p, word in enumerate(ids[a:b].tolist(), a):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                state = self.next[state].get(word, 0)
                size = size + 1 if state else 0
                hit = 0
                if size >= self.window:
                    hit = self.window
                    items |= self.items.get(self.top[state], set())
                if self.short:
                    for length, item in self.chain[state]:
                        if size >= length:
                            hit = max(hit, length)
                            items.add(item)
                if hit:
                    first = p + 1 - hit
                    if spans and first <= spans[-1][1]:
                        while spans and first <= spans[-1][0]:
                            spans.pop()
                        if spans and first <= spans[-1][1]:
                            first = spans.pop()[0]
                    spans.append((first, p + 1))
        return spans, items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Blocks of (item_id, words), read one after the other; a single item may
    be longer than a block."""
    block, n = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        words = words_of(row["text"].encode("utf-8", "surrogatepass") if row["text"] else None)
        if words:
            if block and n + len(words) > block_words:
                yield block
                block, n = [], 0
            block.append((row["item_id"], words))
            n += len(words)
    if block:
        yield block


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, from the first word of each to the end of
    its last."""
    at = [m.span() for m in WORD.finditer(text)]
    keep, last = [], 0
    for first, stop in spans:
        keep.append(text[last:at[first][0]])
        last = at[stop - 1][1]
    return b"".join([*keep, text[last:]])


def _scan_group(docs: DataFrame, name: str, text: str, blocks: list, window: int, before: tuple[str, ...],
                cut: bool) -> DataFrame:
    """One pass: ``docs`` with a struct column ``name``, which counts in what
    the column ``before`` has. ``blocks``: broadcasts."""
    kept: dict[int, list[Automaton]] = {}

    def automata(k: int) -> list[Automaton]:
        if k not in kept:
            kept.clear()
            kept[k] = [Automaton(x.value, window) for x in blocks[k:k + KEPT]]
        return kept[k]

    def make(texts: list, earlier: list | None = None) -> dict[str, list]:
        n_words = [0] * len(texts)
        spans: list[list] = [[(s["first"], s["stop"]) for s in x["spans"]] for x in earlier or ()] or [[] for _ in texts]
        items: list[set] = [set(x["items"]) for x in earlier or ()] or [set() for _ in texts]
        for k in range(0, max(1, len(blocks)), KEPT):
            group = automata(k)
            for i, x in enumerate(texts):
                words = words_of(x)
                n_words[i] = len(words)
                for own in group:
                    got, found = own.scan(words)
                    if got:
                        spans[i] = merged(spans[i] + got) if spans[i] else got
                        items[i] |= found
        made = {"n_words": n_words, "n_hit": [sum(b - a for a, b in x) for x in spans],
                "items": [sorted(i for i in x if i is not None) for x in items],
                "spans": [[{"first": a, "stop": b} for a, b in x] for x in spans]}
        if cut:
            made["left"] = [without(x, own) if own else None for x, own in zip(texts, spans, strict=True)]
        return made

    # more blocks than a task keeps are gone through once a batch, not once a piece
    return append_struct(docs, name, CUT if cut else HITS, text, make, before,
                         PIECE_BYTES if len(blocks) <= KEPT else None)


def with_hits(docs: DataFrame, items: DataFrame, name: str, text: str = "text", window: int = WINDOW,
              block_words: int = BLOCK_WORDS, group_bytes: int = GROUP_BYTES, cut: bool = False) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, n_hit, the item_ids
    with occurring windows and the hit spans, in words; with ``cut`` also left,
    the text without the hit spans (null if it has none)."""
    sc = docs.sparkSession.sparkContext
    groups, held = [[]], 0
    for block in item_blocks(items, block_words):
        size = sum(len(w) for _, words in block for w in words)
        if groups[-1] and held + size > group_bytes:
            groups, held = [*groups, []], 0
        groups[-1].append(sc.broadcast(block))
        held += size
    out, before = docs, ()
    for k, blocks in enumerate(groups):
        own = free_name(out.columns, name)
        out = _scan_group(out, own, text, blocks, window, before, cut and k == len(groups) - 1).drop(*before)
        before = (own,)
    return out.withColumnRenamed(own, name)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.0,
                  length: str = "n_chars") -> DataFrame:
    """The documents without test passages, with their own columns: one whose
    hit share of words is above ``max_coverage`` goes whole, in the others the
    hit spans (each at least a window long) are cut, and the column ``length``,
    if there is one, gets the code points left. At the default of 0 every
    document with a hit goes."""
    hits = free_name(docs.columns, "hits")
    scanned = with_hits(docs, items, hits, window=window, cut=max_coverage > 0)
    got = F.col(quoted(hits))
    kept = scanned.where(got["n_hit"] <= got["n_words"] * F.lit(float(max_coverage)))
    if max_coverage > 0:
        kept = kept.withColumn("text", F.coalesce(got["left"], F.col("text")))
        if length in docs.columns:
            own = F.col(quoted(length))
            left = F.length("text").cast(docs.schema[length].dataType)
            kept = kept.withColumn(length, F.when(got["n_hit"] > 0, left).otherwise(own))
    return kept.select(*[quoted(c) for c in docs.columns])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = with_hits(docs.select("doc_id", "text"), items, "h").select("doc_id", "h")
    names = F.array_join(F.array_sort(F.transform("h.items", lambda i: i.cast("string"))), ",")
    return rows.select("doc_id", "h.n_words", "h.n_hit", F.size("h.items").cast("long").alias("n_items"),
                       F.sha2(names, 256).alias("items_sha256"), (F.col("h.n_hit") > 0).alias("contaminated"))
