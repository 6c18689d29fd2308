"""Operators 9, 10 and 5 against brute-force versions; the pipeline."""

import random
from collections import Counter

import numpy as np
import brute
import pytest
from brute import EDGE

import corpus_pipeline
from ledgerline.llm import graph, mixing, simhash, token_output
from ledgerline.llm.common import stored
from ledgerline.llm.queries import tokenizer_path


def test_position_sets_cover():
    from itertools import combinations
    sets = simhash.position_sets(4)
    assert len(sets) == 20 and all(any(set(s) <= set(w) for s in sets) for w in combinations(range(8), 4))


@pytest.mark.parametrize("block", [20_000, 3])
def test_components_of_fingerprints(spark, block):
    """Chains, near copies and copies, with and without split lists."""
    draw = random.Random(7)
    prints = {}
    for group in range(12):
        at = draw.getrandbits(64)
        for _ in range(25):
            for _ in range(draw.randint(0, 4)):
                at ^= 1 << draw.randrange(64)
            prints[len(prints)] = at
    table = spark.createDataFrame([(k, int(np.uint64(v).astype(np.int64))) for k, v in prints.items()], "node long, fp long")
    classes = table.groupBy("fp").agg({"node": "min"}).toDF("fp", "node")
    roots = dict(map(tuple, graph.components(simhash.links(classes, 4, block)).collect()))
    first = {}
    for k, v in prints.items():
        first.setdefault(v, k)
    assert {k: roots.get(first[v], first[v]) for k, v in prints.items()} == brute.classes(prints)


def test_near_duplicates(documents, plain):
    prints = {r[0]: brute.simhash(r[1]) for r in plain}
    found = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(documents).collect()}
    up = brute.classes(prints)
    assert found == {i: (prints[i], up[i]) for i in prints}


def test_near_duplicates_edge(spark, edge):
    found = simhash.near_duplicates(edge).collect()
    assert len(found) == len(EDGE)
    ids = [r["doc_id"] for r in found if r["component_id"] == 1]
    assert {1, 2, 3} <= set(ids)  # no words: fingerprint zero
    lone = [r for r in found if r["doc_id"] is None]
    assert len(lone) == 1 and lone[0]["component_id"] is None
    assert simhash.near_duplicates(edge.limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    left = Counter(r["doc_id"] for r in kept.collect())
    assert left[4] == 1 and left[9] == 1 and 10 not in left and left[None] == 1


def test_classes_of_any_ids(spark):
    """Ids over the whole 64-bit range, and rows without one, keep their class."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(2**63 - 1, a), (2**62 + 5, b), (2**62 + 7, b), (2**62 + 9, b + " b60"), (-2**63, c), (None, a), (None, "x y z q")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter((r["doc_id"], r["component_id"]) for r in found.collect())
    least = 2**62 + 9 if brute.classes({0: brute.simhash(b), 1: brute.simhash(b + " b60")})[1] else 2**62 + 5
    assert got == Counter([(2**63 - 1, 2**63 - 1), (2**62 + 5, 2**62 + 5), (2**62 + 7, 2**62 + 5), (2**62 + 9, least),
                           (-2**63, -2**63), (None, 2**63 - 1), (None, None)])


def test_near_duplicates_go_by_row(spark):
    """An id may stand for several texts, and rows may have none."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcde")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, d, "x"), (3, d, "y"), (4, d, "x"), (None, e, "x"),
            (None, e, "y"), (None, a, "x"), (None, None, "x"), (None, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_hash string")
    for part in (docs, docs.repartition(7, "row_hash")):
        left = simhash.drop_near_duplicates(part)
        assert left.columns == docs.columns
        assert Counter((r["doc_id"], r["text"] or "") for r in left.collect()) == Counter(
            [(1, a), (2, b), (3, c), (3, d), (None, e), (None, "")])
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_mixture(documents, plain):
    want = brute.targets([(r[3], len(brute.SPACED.findall(r[1] or ""))) for r in plain])
    source = {r[0]: r[3] for r in plain}
    size = {r[0]: len(brute.SPACED.findall(r[1] or "")) for r in plain}
    rows = mixing.mixed_sizes(documents).collect()
    again = mixing.mixed_sizes(documents.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    taken, longest = Counter(), Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], want[s][0])
        assert r["target"] == pytest.approx(want[s][1])
        assert r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s, (_, target) in want.items():
        assert target - longest[s] <= taken[s] <= target
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    times = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]} == times


def test_mixture_edge(edge):
    rows = mixing.mixed_sizes(edge, range_rows=2).collect()
    want = brute.targets([(r[3], len(brute.SPACED.findall(r[1] or ""))) for r in EDGE])
    assert len(rows) == len(EDGE)
    for r in rows:
        assert (r["source_size"], pytest.approx(r["target"])) == want[r["source"]]
        assert r["taken"] <= 3 * r["size"]
    assert mixing.mixed_sizes(edge.limit(0)).count() == 0
    assert mixing.mix(edge).columns == edge.columns


def test_codes_round_trip():
    draw = np.random.default_rng(1)
    table = token_output.length_table()
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (draw.integers(0, 2**32, n) >> draw.choice([0, 8, 16, 24], n)).astype(np.uint32)
        control, data = token_output.encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert (token_output.decode_ranks(control, data, n, table) == ranks).all()


@pytest.mark.parametrize("which", ["documents", "edge"])
def test_tokens(which, request):
    from tokenizers import Tokenizer
    docs = request.getfixturevalue(which)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute.token_rows(rows, Tokenizer.from_file(tokenizer_path()))
    for shard in (token_output.SHARD_IDS, 20_000):
        found = token_output.token_output(docs, tokenizer_path(), shard_ids=shard).collect()
        assert sorted(map(tuple, found), key=lambda r: r[1]) == want


def test_tokens_of_odd_spaces():
    """Parts give the ids of the whole, whatever white space there is."""
    import pyarrow as pa
    from tokenizers import Tokenizer
    draw = random.Random(5)
    marks = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "It's", "12", ",", "é", "𝒳", "<|endoftext|>", "'s"]
    texts = ["".join(draw.choice(marks) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    whole = Tokenizer.from_file(tokenizer_path())
    found = token_output.Encoder(tokenizer_path()).encode(pa.array(texts))
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokens_empty(edge):
    assert token_output.token_output(edge.limit(0), tokenizer_path()).count() == 0


def test_pipeline_edge(spark, data, edge):
    """Edge rows, clashing columns and an empty table go through every stage."""
    long = " ".join(f"w{k} x{k % 97}" for k in range(400))
    rows = [(50, long, "en", "a"), (50, long, "en", "a"), (None, long + " more", "en", None), (51, "other " + long[::-1], None, "b")]
    extra = edge.sparkSession.createDataFrame([(*r, "x", 1, True, [1]) for r in rows], edge.schema)
    for docs in (edge.unionByName(extra), edge.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, data), name)
            assert name == "token_output" or docs.columns == columns
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids <= {50, 51, None} and (not columns or bool(ids) == bool(docs.count()))


def test_pipeline(spark, data, documents, plain):
    """Every stage against a plain version of it on its own input."""
    from tokenizers import Tokenizer
    from ledgerline.llm import quality_rules
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "simhash_near_dedup", "decontamination", "mixing", "token_output"]
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stored(stage(spark, docs, data), name)
        if name != "token_output":
            assert docs.columns == documents.columns
    ids = {k: Counter(r["doc_id"] for r in v.select("doc_id").collect()) for k, v in seen.items()}
    text = {r[0]: r[1] for r in plain}
    kept = {r["doc_id"] for r in quality_rules.quality_verdicts(documents).where("kept").collect()}
    assert set(ids["simhash_near_dedup"]) == kept
    up = brute.classes({i: brute.simhash(text[i]) for i in kept})
    assert ids["decontamination"] == Counter({i: 1 for i, c in up.items() if i == c})
    known = brute.windows([tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()])
    cut = {i: brute.cut(text[i], *known, corpus_pipeline.MAX_COVERAGE) for i in ids["decontamination"]}
    clean = {i: x for i, x in cut.items() if x is not None}
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in seen["mixing"].collect()}
    size = {r["doc_id"]: r["n_chars"] for r in documents.collect()}
    assert left == {i: (x, len(x) if x != text[i] else size[i]) for i, x in clean.items()}
    assert any(x != text[i] for i, x in clean.items()) and ids["mixing"] == Counter({i: 1 for i in clean})
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixed_sizes(seen["mixing"]).collect() if r["taken"]}
    assert ids["token_output"] == Counter(taken)
    want = brute.token_rows([(i, clean[i]) for i, n in taken.items() for _ in range(n)],
                            Tokenizer.from_file(tokenizer_path()))
    assert sorted(map(tuple, docs.collect()), key=lambda r: r[1]) == want
