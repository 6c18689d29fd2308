"""Secret scans with a randomness battery (operator 6).

The base patterns mark credentials that name themselves. The method adds the
ones that don't: every other run of 20 or more code characters is a
candidate. Its encoding is inferred (hexadecimal, base 32 or base 64), and its
symbols are tested against that alphabet: chi-squared uniformity, runs above
and below the alphabet's middle, and serial correlation. A candidate that
looks random is still a discovery only if ordinary text would hardly give it:
the number of equal symbol pairs and of switches between letter cases and
digits, compared with what text of that length has, give a p-value, and within
each stratum of length the Benjamini-Hochberg rule keeps the share of false
discoveries at ``rate``. So a short candidate needs more than a long one.

DataFrame functions only. Scale: one scan writes the spans and candidates of
each document; the rule needs one count per stratum and p-value step, and its
few thresholds go to a literal. No shuffle of texts, no group of documents.

Defined cases: null or empty text has no spans; a document's candidates that
touch a base span are left to it; repeated rows are marked alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.spans import bind, count_kind, match_spans, span_text

ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"[A-Za-z0-9+/_.=-]+")
ASSIGN_VALUE = r"^(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
CODE = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{CODE}])[{CODE}]{{20,}}+"
BASE = ("assign", "access", "hex")

#: Chances in ordinary text: two symbols equal, three equal, a switch of class.
PAIR, TRIPLE, SWITCH = 0.066, 0.0055, 0.08
STRATA = (28, 40, 64)
STEPS, TOP = 10, 400
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE16 = "0123456789abcdef"


def tail(z):
    """Upper tail of the normal distribution, within 0.3 %."""
    def right(x):
        return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) / (x * 0.661 + F.sqrt(x * x + 5.51) * 0.339)

    return F.when(z >= 0, right(z)).otherwise(1 - right(-z))


def base_spans(text):
    has = lambda part: F.contains(text, F.lit(part))
    only = lambda test: F.when(test, text).otherwise(F.lit(""))
    named = F.filter(match_spans(only(has("=") | has(":")), ASSIGN, "assign", 0),
                     lambda s: F.length(F.regexp_extract(s["value"], ASSIGN_VALUE, 1)) >= 12)
    return F.array_sort(F.flatten(F.array(named, match_spans(only(has("AKIA")), ACCESS, "access", 1),
                                          match_spans(text, HEX, "hex", 2))))


def battery(value):
    """The tests of one candidate: random (whether it passes those for its
    alphabet) and p (the chance that ordinary text is as even). Every step is
    bound before a fold uses it, so the work follows the length."""
    each = lambda text: F.split(text, "(?!^)(?!$)")

    def encoded(plain):
        is16 = plain.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        is32 = plain.rlike("^[A-Z2-7]+$")
        alphabet = F.when(is16, F.lit(BASE16)).when(is32, F.lit(BASE32)).otherwise(F.lit(BASE64))
        classes = F.translate(plain, BASE64, "B" * 26 + "a" * 26 + "0" * 10 + "++")
        return F.struct(each(F.when(is16, F.lower(plain)).otherwise(plain)).alias("marks"), each(classes).alias("classes"),
                        alphabet.alias("alphabet"), F.length(alphabet).cast("double").alias("size"))

    def numbered(x):
        codes = F.transform(x["marks"], lambda c: (F.call_function("instr", x["alphabet"], c) - 1).cast("double"))
        return F.struct(codes.alias("codes"), x["classes"].alias("classes"), x["size"].alias("size"))

    def total(array, of):
        return F.aggregate(array, F.lit(0.0), lambda acc, y: acc + of(y))

    def steps(array, of):
        return F.aggregate(F.sequence(F.lit(1), F.size(array) - 1), F.lit(0.0),
                           lambda acc, k: acc + of(F.get(array, k), F.get(array, k - 1)))

    differ = lambda a, b: F.when(a != b, F.lit(1.0)).otherwise(F.lit(0.0))

    def sums(x):
        c, size = x["codes"], x["size"]
        squares = F.aggregate(F.array_distinct(c), F.lit(0.0), lambda acc, s: acc + F.pow(
            F.size(F.filter(c, lambda y: y == s)).cast("double"), F.lit(2.0)))
        high = lambda y: y * 2 >= size
        return F.struct(F.size(c).cast("double").alias("n"), size.alias("size"), squares.alias("squares"),
                        total(c, lambda y: high(y).cast("double")).alias("high"),
                        steps(c, lambda a, b: differ(high(a), high(b))).alias("turns"),
                        total(c, lambda y: y).alias("s1"), total(c, lambda y: y * y).alias("s2"),
                        steps(c, lambda a, b: a * b).alias("s11"), F.get(c, 0).alias("first"),
                        F.element_at(c, -1).alias("last"), steps(x["classes"], differ).alias("switches"))

    def verdict(t):
        n, size, mean = t["n"], t["size"], t["s1"] / t["n"]
        spread = t["s2"] - n * mean * mean
        shared = t["s11"] - mean * (2 * t["s1"] - t["first"] - t["last"]) + (n - 1) * mean * mean
        chi = (size / n * t["squares"] - n - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
        split = 2 * t["high"] * (n - t["high"])
        var = split * (split - n) / (n * n * (n - 1))
        runs = F.when(var > 0, (t["turns"] - split / n) / F.sqrt(F.greatest(var, F.lit(1e-9)))).otherwise(F.lit(9.0))
        serial = F.when(spread > 1e-9, (shared / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)) \
            .otherwise(F.lit(9.0))
        pairs = n * (n - 1) / 2
        few = (pairs * PAIR - (t["squares"] - n) / 2) / F.sqrt(
            pairs * PAIR * (1 - PAIR) + n * (n - 1) * (n - 2) * (TRIPLE - PAIR * PAIR))
        often = (t["switches"] - SWITCH * (n - 1)) / F.sqrt(SWITCH * (1 - SWITCH) * (n - 1))
        return F.struct(((chi < 4) & (F.abs(runs) < 4) & (F.abs(serial) < 4)).alias("random"),
                        tail((few + often) / math.sqrt(2.0)).alias("p"))

    plain = F.translate(F.regexp_replace(value, "=+$", ""), "-_", "+/")
    return bind(bind(plain, lambda p: F.when(F.length(p) >= 16, bind(encoded(p), numbered))),
                lambda x: F.when(x.isNotNull(), bind(sums(x), lambda t: bind(verdict(t), lambda v: v))))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, base (spans) and more (candidates: start, rank, stop, kind,
    value, random, p, stratum, step)."""
    own = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.col(text)).withColumn("base", base_spans(own))
    apart = F.filter(match_spans(own, CANDIDATE, "random", 3), lambda s: ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    rows = rows.withColumn("apart", apart)
    tested = F.transform("apart", lambda s: F.struct(s.alias("span"), battery(s["value"]).alias("test")))
    rows = rows.withColumn("tested", tested)
    length = lambda s: F.length(s["value"])

    def full(x):
        s, t = x["span"], x["test"]
        stratum = F.lit(0)
        for k, edge in enumerate(STRATA, 1):
            stratum = F.when(length(s) >= edge, F.lit(k)).otherwise(stratum)
        step = F.floor(-F.log10(F.greatest(t["p"], F.lit(1e-300))) * STEPS)
        return F.struct(s["start"], s["rank"], s["stop"], s["kind"], s["value"],
                        F.coalesce(t["random"], F.lit(False)).alias("random"),
                        F.coalesce(t["p"], F.lit(1.0)).alias("p"), stratum.alias("stratum"),
                        F.coalesce(F.greatest(F.lit(0), F.least(F.lit(TOP), step)), F.lit(0)).cast("int").alias("step"))

    return rows.select("doc_id", "base", F.transform("tested", full).alias("more"))


def thresholds(scanned: DataFrame, rate: float = 0.01) -> dict[int, int]:
    """For each stratum the least step (tenths of -log10 p) that the
    Benjamini-Hochberg rule accepts; strata without any are left out."""
    counts = (scanned.select(F.explode("more").alias("m")).groupBy("m.stratum", "m.step")
              .agg(F.count(F.lit(1)).alias("n")))
    down = Window.partitionBy("stratum").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    marks = counts.select("stratum", "step", F.sum("n").over(down).alias("found"),
                          F.sum("n").over(Window.partitionBy("stratum")).alias("tried"))
    good = marks.where(F.col("tried") * F.pow(F.lit(10.0), -F.col("step") / STEPS) <= rate * F.col("found"))
    return {r["stratum"]: r["step"] for r in good.groupBy("stratum").agg(F.min("step").alias("step")).collect()}


def find_secrets(docs: DataFrame, text: str = "text", rate: float = 0.01) -> DataFrame:
    """doc_id, base and found: the base spans, and all of them."""
    scanned = stored(scan(docs, text), "secrets")
    least = thresholds(scanned, rate)

    def accepted(m):
        ok = F.lit(False)
        for stratum, step in least.items():
            ok = ok | ((m["stratum"] == stratum) & (m["step"] >= step))
        return m["random"] & ok

    more = F.transform(F.filter("more", accepted), lambda m: F.struct(
        m["start"], m["rank"], m["stop"], m["kind"], m["value"]))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("found"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans."""
    rows = find_secrets(docs.select("doc_id", "text"))
    return rows.select("doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in BASE],
                       F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                       span_text(F.col("found")).alias("spans"))
