"""Operator 11 against a plain version."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import low
from pyspark.sql import functions as F

from ledgerline.llm import merkle, queries


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Levels from the leaves to the single node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + 16])))
        at //= 16
    return out


def plain(rows):
    """(doc_id, source, lang, n_chars, text) rows -> the query's rows, sorted."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order]) if order else []
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            mine = path(trees[s], i) + path(top, k)
            changed = r[4] if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 or r[4] is None else low(r[4])
            node = leaf((*r[:4], changed))
            for b, a in mine:
                node = digest(b + node + a)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], digest("".join(b + a for b, a in mine)), node,
                        node == top[-1][0]))
    return sorted(out, key=str)


def found(frame, **more):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    offered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered).otherwise(F.col("text"))
    return sorted(map(tuple, merkle.verify(merkle.build_manifest(frame, offered={"text": offered}, **more)).collect()), key=str)


def test_addresses_fill_the_subtree():
    for levels in (1, 2, 3, 4, 5):
        for arity in (2, 3, 16):
            if merkle.subtree_size(levels, arity) > 10_000:
                continue
            place = np.concatenate([merkle.addresses(levels, d, np.arange(arity ** d), arity) for d in range(levels)])
            assert sorted(place.tolist()) == list(range(merkle.subtree_size(levels, arity)))
    # four levels: the upper two, then each lower pair of levels as one run
    assert merkle.addresses(4, 2, np.array([1]), 2)[0] == 6 and merkle.addresses(4, 3, np.array([2, 3]), 2).tolist() == [7, 8]


def test_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "source", "lang", "n_chars", "text").collect()]
    result = queries.op11_merkle_manifest(spark, data)
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, result.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_tiers(spark, depth):
    """A hot source over several tiers, many small ones, and blocks that end in a run of one."""
    rows = [(k, "hot", "en", k % 7, f"Text {k}") for k in range(16 * 16 * 2 + 17)]
    rows += [(k, f"s{k:03d}", None, None, None if k % 3 else "Lone") for k in range(300)]
    rows += [(None, None, "x", 3, "A"), (None, "hot", "x", 3, "A"), (5, "hot", "x", 3, "A"), (5, "hot", "x", 3, "A"),
             (6, None, "", 0, ""), (7, "", None, -1, "É ü")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(frame.repartition(5), depth=depth) == plain(rows)


def test_edge(edge):
    """No n_chars column, clashing extra columns, repeated rows, no rows."""
    rows = [(r["doc_id"], r["source"], r["lang"], None, r["text"]) for r in edge.collect()]
    clashing = edge.withColumns({c: F.lit(1) for c in ("idx", "n", "g", "digest", "offered", "place", "block")})
    assert found(clashing) == plain(rows)
    assert found(edge.limit(0)) == []
    assert found(edge.limit(1)) == plain(rows[:1])
