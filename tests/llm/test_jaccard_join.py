"""Operator 12 against a plain version."""

import random

import numpy as np
import pytest
from brute import EDGE, SPACED, low
from pyspark.sql import functions as F

from ledgerline.llm import jaccard_join as J
from ledgerline.llm import queries


def grams(text, size=3):
    w = SPACED.findall(low(text or ""))
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def plain(rows):
    """(doc_id, text) rows -> (doc_id, n_shingles, component_id), sorted; every
    pair that shares a shingle is compared."""
    sets = [grams(t) for _, t in rows]
    where, up = {}, list(range(len(rows)))
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 90 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = root(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=str)


def found(frame, **more):
    return sorted(map(tuple, J.jaccard_components(frame, **more).collect()), key=str)


def test_table(spark, data, plain_rows=None):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    result = queries.op12_jaccard_join(spark, data)
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    want = plain(rows)
    assert sorted(map(tuple, result.collect()), key=str) == want
    assert len({r[2] for r in want}) < len(want)


def drawn(seed, copies=25):
    """Chains of edits about the threshold, groups that share passages, long and short texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(4000)}"
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for group in range(10):
        base = [word() for _ in range(draw.choice([12, 30, 60, 150, 400]))]
        for _ in range(copies):
            at = list(base)
            for _ in range(draw.randint(0, max(1, len(at) // 45))):
                at[draw.randrange(len(at))] = word()
            if draw.random() < 0.3:
                base = at
            rows.append((len(rows) * 3, " ".join(at if group % 2 else passage + at)))
    rows += [(10_000 + k, " ".join(passage + [word() for _ in range(20)])) for k in range(60)]
    rows += [(20_000 + k, " ".join(f"c{draw.randrange(6)}" for _ in range(draw.randint(1, 14)))) for k in range(120)]
    return rows


@pytest.mark.parametrize(("seed", "block", "orders"), [(1, J.BLOCK, 3), (2, 900, 3), (3, 200, 1)])
def test_links(spark, seed, block, orders):
    rows = drawn(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = plain(rows)
    assert found(frame, block=block, orders=orders) == want
    assert 2 < len({r[2] for r in want}) < len(want)


def test_hot_group(spark):
    """Most rows are near copies of one text, the ones without an id too."""
    draw = random.Random(4)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for k in range(400):
        at = list(base)
        for _ in range(draw.randint(0, 5)):
            at[draw.randrange(200)] = f"e{draw.randrange(10**6)}"
        rows.append((None if k % 7 == 0 else k, " ".join(at)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    assert found(frame, block=20_000) == want == found(frame, few=0)


def test_heads_of_similar_sets_lie_in_runs():
    """Of the head of a set, what a similar one has is in the other's run."""
    draw = np.random.default_rng(6)
    for _ in range(400):
        n = int(draw.integers(1, 300))
        common = np.unique(draw.integers(0, 2**62, n))
        more = int(draw.integers(0, n // 9 + 1))
        mine, theirs = (np.unique(np.concatenate([common, draw.integers(0, 2**62 if draw.random() < 0.5 else 2**50, k)]))
                        for k in (more, max(0, n // 9 - more)))
        if 100 * len(common) < 90 * (len(mine) + len(theirs) - len(common)):
            continue
        for a, b in ((mine, theirs), (theirs, mine)):
            head, run = a[:J.run_lengths(len(a))[0]], b[:J.run_lengths(len(b))[1]]
            assert set(head) & set(b) <= set(run)
            assert len(set(a) - set(b)) < J.prefix_length(len(a))


def test_prefixes_meet_under_every_order():
    """Similar sets share a prefix token in each order, whatever the counts."""
    draw = np.random.default_rng(5)
    for _ in range(300):
        n = int(draw.integers(1, 80))
        a = np.unique(draw.integers(-2**62, 2**62, n))
        b = np.unique(np.concatenate([a[draw.random(len(a)) > 0.05], draw.integers(-2**62, 2**62, int(draw.integers(0, 4)))]))
        both = np.intersect1d(a, b)
        if not len(b) or 100 * len(both) < 90 * (len(a) + len(b) - len(both)):
            continue
        counts = {int(t): int(draw.integers(2, 500)) for t in both}
        heads = []
        for s in (a, b):
            # a set's own tokens stand before the shared ones and are left out
            assert len(s) - len(both) < len(s) - J.needed(len(s)) + 1
            heads.append([set(both[p].tolist()) for p in J.prefixes(len(s), both, np.array([counts[int(t)] for t in both]), (90, 100), 4)])
        assert all(x & y for x, y in zip(*heads, strict=True))


def test_edge(edge):
    rows = [(r[0], r[1]) for r in EDGE]
    assert found(edge) == plain(rows)
    clashing = edge.withColumns({c: F.lit(1) for c in ("n", "node", "token", "key1", "key2", "run", "text_hash", "root")})
    assert found(clashing) == plain(rows)
    assert found(edge.limit(0)) == [] and found(edge.where("text is null")) == [(1, 0, 1)]
    ends = [(2**63 - 1, "a b c d"), (-2**63, "a b c d"), (2**62 + 5, "x y z"), (2**62 + 7, "x Y  z"), (None, "q r s t"), (None, "q r s t")]
    frame = edge.sparkSession.createDataFrame(ends, "doc_id long, text string")
    assert found(frame) == plain(ends)
