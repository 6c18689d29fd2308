"""Operator 13 against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import EDGE, low

from ledgerline.llm import queries, variants
from ledgerline.llm.common import stored


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def plain(counts):
    """The query's rows: near words through what is left without one code point."""
    cut = {}
    for w in counts:
        for k in range(len(w)):
            cut.setdefault(w[:k] + w[k + 1:], set()).add(w)
    forms, out = {}, []
    for w, n in counts.items():
        close = {x for k in range(len(w)) for x in cut[w[:k] + w[k + 1:]]} | cut.get(w, set())
        close |= {w[:k] + w[k + 1:] for k in range(len(w))} & counts.keys()
        close = [x for x in close if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * n:
            forms[w] = best
        out.append((w, n, len(close)))
    rows = []
    for w, n, k in out:
        end = w
        while end in forms:
            end = forms[end]
        rows.append((w, forms.get(w), end, n, k, counts[forms[w]] if w in forms else None))
    return sorted(rows)


def test_table(spark, data, plain_words=None):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    result = queries.op13_spelling_variants(spark, data)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = sorted(map(tuple, result.collect()))
    assert found == plain(words(rows)) and any(r[1] for r in found)


def drawn_words(count, letters, seed):
    draw = random.Random(seed)
    out = Counter()
    while len(out) < count:
        base = "".join(draw.choice(letters) for _ in range(draw.randint(7, 10)))
        for _ in range(draw.randint(1, 6)):
            out[base] += draw.choice([2, 3, 40, 500])
            k = draw.randrange(len(base))
            change = draw.choice(["", draw.choice(letters), base[k] + draw.choice(letters)])
            if len(base[:k] + change + base[k + 1:]) >= 7:
                base = base[:k] + change + base[k + 1:]
    return out


@pytest.mark.parametrize(("letters", "sample", "box"), [("abc", 100_000, 20), ("ab", 50, 8), ("abcdefghéÿ÷", 300, 30),
                                                        ("abcdefghéÿ÷", 0, 30), ("abcde", 100_000, 4000)])
def test_searches(spark, letters, sample, box):
    """Few letters: many words of one letter count, boxes split by hash, long chains of forms."""
    counts = drawn_words(1500, letters, seed=len(letters) + box)
    counts["ab" * 3000], counts["ab" * 3000 + "b"], counts["ab" * 2999 + "aa"] = 2, 30, 400
    table = stored(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5), "words")
    pairs = variants.near_pairs(table, sample=sample, box=box)
    forms = stored(variants.best_forms(table, pairs), "variants")
    root = dict(map(tuple, variants.roots(forms).select("word", "root").collect()))
    found = sorted((r["word"], r["form"], root.get(r["word"], r["word"]), r["n"], r["n_near"], r["form_n"]) for r in forms.collect())
    assert found == plain(counts)


def test_route_reaches_every_near_point():
    draw = np.random.default_rng(3)
    points = draw.integers(0, 9, (400, 3)).astype(np.int32)
    splits = variants.fit_splits(points, 1.0, 5)
    home = {i: k for k, rows in variants.route(splits, points, 0) for i in rows.tolist()}
    assert sorted(home) == list(range(400)) and variants.boxes(splits) == max(home.values()) + 1
    for reach in (1, 2):
        seen = {(i, k) for k, rows in variants.route(splits, points, reach) for i in rows.tolist()}
        for i in range(400):
            apart = np.abs(points - points[i]).sum(axis=1)
            assert all((i, home[j]) in seen for j in np.flatnonzero(apart <= reach).tolist())


def test_edge(spark, edge):
    rows = [(r[0], r[1]) for r in EDGE]
    found = sorted(map(tuple, variants.spelling_variants(edge).collect()))
    assert found == plain(words(rows))
    assert variants.spelling_variants(edge.limit(0)).count() == 0
    many = [(k, "Strasbourg Strasbourgs strasbourg straßbourg Strasbour") for k in range(40)] + [(None, "Strasbourh"), (3, "Strasbourh")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in many * 2], "doc_id long, text string, n int, word string")
    assert sorted(map(tuple, variants.spelling_variants(frame).collect())) == plain(words(many * 2))
