"""Quality rules with adaptive thresholds (operator 3).

Each document's features are integers, shares in thousandths of which one
occurrence is taken off first (a single one proves nothing in a short text).
Per (lang, source) they are gathered in mergeable quantile sketches:
histograms whose buckets keep the leading ``SKETCH_BITS`` bits of a value, so
a bucket is at most 1/256 wide relative to its value, any two sketches merge by
adding counts, and a sketch never has more than some thousand buckets however
many rows it describes.

**Fences.** A stratum's limit comes from its own sketch and nothing else:
``reach`` times the distance from the median to an outer quantile, beyond that
quantile. ``RULES`` gives each feature's quantile, that is the share of a
stratum that may be unsound before the fence gives way. Where the outer
quantile is the median, the fence is there: the only smallest distance is what
a bucket hides (its width less one, nothing for values below 512).

**Small strata.** Every sketch is blended with the wider one: the language's
sketch, itself blended with the corpus's, counts as ``prior`` documents more.
A stratum's own documents outweigh it gradually as they become more; no number
of documents switches anything. The weights are exact integers.

Scale: one scan makes the features; map-side aggregation shrinks them to the
sketches before any shuffle, so a hot source costs one row per bucket and
task; the thresholds are written as a table, and the planner broadcasts it
only while it is under the session's threshold.

Defined cases: null text has no words, so every count is 0 and the base rule
rejects it; null lang or source form strata of their own; an empty table gives
an empty result; repeated rows are judged alike; ties share a bucket; extra
columns, also with names used here, pass through ``filter_documents``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import append_struct, free_name, quoted, stored

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
SKETCH_BITS = 9
#: Features with fences: name, outer quantile above, and below if a low value
#: rejects too (as fractions).
RULES = (("symbol_rate", (9, 10), None), ("repeat_rate", (49, 50), None), ("dup_line_rate", (49, 50), None),
         ("word_length", (9, 10), (1, 10)))
PRIOR = 50
REACH = 3
#: Words that one repetition of a three-word window covers.
REPEAT = 6
FEATURES = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")])


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n + 2)
    size = len(number)
    if size < 2_000_000:
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # three such numbers no longer fit in 64 bits
        pairs = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)[1]
        keys = pairs * size + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift:shift + n] |= twice
    return int(covered.sum())


def text_features(texts: list) -> dict[str, list]:
    """The base counts of each text (UTF-8 bytes or None)."""
    out: dict[str, list] = {f.name: [] for f in FEATURES.fields}
    for text in texts:
        text = text or b""
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
        points = len(text.decode("utf-8", "surrogatepass")) - (len(text) - len(text.translate(None, SPACE)))
        out["n_words"].append(len(words))
        out["word_chars"].append(points)
        out["n_symbols"].append(len(text) - len(text.translate(None, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_lines"].append(len(lines))
        out["n_repeat_words"].append(repeated_words(words))
    return out


def with_features(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``name`` of the base counts."""
    return append_struct(docs, name, FEATURES, text, text_features)


def base_failed(q):
    return (q["n_words"] < 50) | (q["n_repeat_words"] * 100 > q["n_words"] * 50)


def rates(q) -> dict:
    """The features that get fences, as integers (in thousandths)."""
    per = lambda a, b, one: F.floor(F.greatest(a - one, F.lit(0)) * 1000 / F.greatest(b, F.lit(1)))
    return {"symbol_rate": per(q["n_symbols"], q["n_words"], 1), "repeat_rate": per(q["n_repeat_words"], q["n_words"], REPEAT),
            "dup_line_rate": per(q["n_dup_lines"], q["n_lines"], 1), "word_length": per(q["word_chars"], q["n_words"], 0)}


def bucket(value):
    """Lower bound of a value's sketch bucket: its leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def bucket_width(value):
    """How many values a bucket stands for."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0)))


def sketches(featured: DataFrame, q: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, feature, bucket, n): one mergeable sketch for each
    stratum and feature. Documents that fail the base rules are left out."""
    every = F.array(*[F.struct(F.lit(k).alias("feature"), bucket(v.cast("long")).alias("bucket"))
                      for k, v in rates(F.col(quoted(q))).items()])
    rows = featured.where(~base_failed(F.col(quoted(q)))).select(
        F.col(quoted(lang)).alias("lang"), F.col(quoted(source)).alias("source"), F.explode(every).alias("x"))
    return rows.groupBy("lang", "source", F.col("x.feature").alias("feature"),
                        F.col("x.bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def blended(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, feature, bucket, w, total): each stratum's sketch, with
    its language's (blended with the corpus's) as ``prior`` documents more.

    The weights are whole numbers: a language's are its counts times the
    corpus's documents plus ``prior`` times the corpus's counts, and a
    stratum's are made of its own and its language's the same way. They fit in
    38 digits up to 10 ** 12 documents."""
    def named(t, suffix, *keys):
        return t.select(*[F.col(k).alias(k + suffix) for k in keys], *[c for c in t.columns if c not in keys])

    big = lambda c: F.col(c).cast("decimal(38,0)")
    wide = lambda c: c.cast("decimal(38,0)")
    own = stored(sketch, "sketch")
    corpus = own.groupBy("feature", "bucket").agg(F.sum("n").alias("n0"))
    languages = own.groupBy("lang", "feature", "bucket").agg(F.sum("n").alias("n1"))
    # every document has one bucket per feature: a feature's counts add up to the documents
    t2 = own.where(F.col("feature") == RULES[0][0]).groupBy("lang", "source").agg(F.sum("n").alias("t2"))
    t1 = languages.groupBy("lang", "feature").agg(F.sum("n1").alias("t1"))
    t0 = t2.agg(F.sum("t2").alias("t0")).first()["t0"] or 0
    per_lang = named(t1, "_a", "lang").join(corpus, "feature")
    same = (F.col("lang_a").eqNullSafe(F.col("lang_b")) & (F.col("feature") == F.col("feature_b")) & (F.col("bucket") == F.col("bucket_b")))
    lang = per_lang.join(named(languages, "_b", "lang", "feature", "bucket"), same, "left").select(
        F.col("lang_a"), "feature", "bucket",
        wide(F.coalesce(big("n1"), F.lit(0)) * F.lit(t0) + big("n0") * F.lit(prior)).alias("w1"),
        wide((big("t1") + F.lit(prior)) * F.lit(t0)).alias("total1"))
    strata = t2.join(stored(lang, "languages"), F.col("lang").eqNullSafe(F.col("lang_a")))
    same = (F.col("lang").eqNullSafe(F.col("lang_c")) & F.col("source").eqNullSafe(F.col("source_c"))
            & (F.col("feature") == F.col("feature_c")) & (F.col("bucket") == F.col("bucket_c")))
    return strata.join(named(own, "_c", "lang", "source", "feature", "bucket"), same, "left").select(
        "lang", "source", "feature", "bucket",
        wide(F.coalesce(big("n"), F.lit(0)) * big("total1") + big("w1") * F.lit(prior)).alias("w"),
        wide(big("total1") * (big("t2") + F.lit(prior))).alias("total"))


def thresholds(sketch: DataFrame, prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """(lang, source, then high and low of each feature) for every stratum.

    A quantile is the bucket at which the running weight reaches its share;
    the window runs over the buckets of one stratum, never over documents."""
    run = "PARTITION BY lang, source, feature ORDER BY bucket ROWS UNBOUNDED PRECEDING"
    marks = blended(sketch, prior).select("lang", "source", "feature", "bucket", "total", F.expr(f"sum(w) OVER ({run})").cast(
        "decimal(38,0)").alias("upto"))
    at = lambda share: F.min(F.when(F.col("upto") * share[1] >= F.col("total") * share[0], F.col("bucket")))
    shares = {share for _, *both in RULES for share in both if share} | {(1, 2)}
    name = lambda share: f"q{share[0]}_{share[1]}"
    quant = marks.groupBy("lang", "source", "feature").agg(*[at(x).alias(name(x)) for x in sorted(shares)])
    limits = []
    for feature, high, low in RULES:
        for side, share in (("high", high), ("low", low)):
            if share:
                outer = F.col(name(share))
                apart = F.greatest(F.abs(outer - F.col("q1_2")), bucket_width(outer) - 1) * reach
                limit = outer + apart if side == "high" else outer - apart
                limits.append(F.max(F.when(F.col("feature") == feature, limit)).alias(f"{feature}_{side}"))
    return quant.groupBy("lang", "source").agg(*limits)


def judge(featured: DataFrame, limits: DataFrame, q: str, verdict: str, lang: str = "lang",
          source: str = "source") -> DataFrame:
    """``featured`` with a boolean column ``verdict`` (true: kept)."""
    own = [free_name([*featured.columns, verdict], f"limit_{c}") for c in limits.columns]
    named = limits.toDF(*own)
    of = dict(zip(limits.columns, own, strict=True))
    col = F.col(quoted(q))
    ok = ~base_failed(col)
    for name, _, low in RULES:
        value = bucket(rates(col)[name].cast("long"))  # as the fences' quantiles are rounded
        ok = ok & (value <= F.coalesce(F.col(of[f"{name}_high"]), value))
        if low:
            ok = ok & (value >= F.coalesce(F.col(of[f"{name}_low"]), value))
    on = F.col(quoted(lang)).eqNullSafe(F.col(of["lang"])) & F.col(quoted(source)).eqNullSafe(F.col(of["source"]))
    return featured.join(named, on, "left").withColumn(verdict, ok).drop(*own)


def quality_verdicts(docs: DataFrame, prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, one row per document."""
    narrow = docs.select("doc_id", "lang", "source", "text")
    featured = stored(with_features(narrow, "q").drop("text"), "features")
    limits = stored(thresholds(sketches(featured, "q"), prior, reach), "thresholds")
    out = judge(featured, limits, "q", "kept")
    return out.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
                      base_failed(F.col("q")).alias("base_failed"), "kept")


def filter_documents(docs: DataFrame, prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """The documents that pass, with their own columns.

    The first scan makes the sketches, the second judges each document where
    it is read: the texts are never shuffled while the thresholds are small."""
    q = free_name(docs.columns, "q")
    narrow = docs.select("lang", "source", "text")
    limits = stored(thresholds(sketches(with_features(narrow, "q"), "q"), prior, reach), "thresholds")
    verdict = free_name([*docs.columns, q], "kept")
    judged = judge(with_features(docs, q), limits, q, verdict)
    return judged.where(F.col(verdict)).select(*[quoted(c) for c in docs.columns])
