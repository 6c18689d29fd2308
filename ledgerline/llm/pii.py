"""Personal data: patterns propose, checksums confirm, context scores
(operator 8).

Regular expressions propose spans; validators confirm them (parts of an
address, Luhn for cards, mod-97 for bank accounts, digit counts for phones);
words nearby raise or lower the score of a span. The base kinds always stay;
the kinds that the method adds (``iban``, and ``tel``: a national phone number)
stay from a score of ``min_score``.

DataFrame functions only, one scan, no shuffle. The patterns are written so
that a long run of matching characters is tried once, from its start
(possessive quantifiers and look-behinds), and the validators' running states
are folds over the few characters of a span.

Defined cases: null or empty text has no spans; a kind's matches don't
overlap, spans of different kinds may; repeated rows are marked alike; an
empty table gives an empty result; extra columns pass through ``with_pii``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, quoted
from ledgerline.llm.spans import bind, count_kind, digits, match_spans, near, span_text

LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
TEL = r"(?<![0-9+.-])\(?0[0-9]{1,4}\)?[\x20/-][0-9](?:[\x20.-]?[0-9]){4,10}+(?![0-9])"
BASE = ("email", "ip", "card", "phone")

#: Words that make a span likelier, by kind, and that make any span less likely:
#: whole words, with a plural or feminine ending.
CONTEXT = {"email": "e?mails?|contacto?s?|kontakt|write to", "ip": "ip|address|server|host|login",
           "card": "cards?|visa|mastercard|master|credit|debit|karte|carte|tarjeta",
           "phone": "tel|telephone|telefono|telefon|phones?|call|fax|mobile?|mobil",
           "iban": "iban|accounts?|konto|comptes?|cuentas?|bank", "tel": "tel|telephone|telefono|telefon|téléphone|teléfono|phones?|call|fax|mobile?"
           "|anruf|appel|appelez|llamar|llame"}
AGAINST = "example|sample|dummy|test|placeholder|invoice no|order no"
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "tel": 0.3}
WIDTH = 48


def whole_words(words: str) -> str:
    """A pattern for any of ``words``, in either case, not inside other words."""
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"


def luhn(number):
    """Whether a string of digits passes the Luhn check."""
    def weigh(c, i):
        own = c.cast("int") * F.when(i % 2 == 1, F.lit(2)).otherwise(F.lit(1))
        return F.when(own > 9, own - 9).otherwise(own)

    parts = F.transform(F.split(F.reverse(number), "(?!^)(?!$)"), weigh)
    return F.aggregate(parts, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def mod97(account):
    """Whether an account number (letters and digits) passes mod 97 = 1."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(acc, c):
        code = F.ascii(c)
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def confirmed(text) -> list:
    """An array of confirmed spans for each kind."""
    count = lambda s: F.length(digits(s["value"]))
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    card = lambda s: count(s).between(12, 19) & luhn(digits(s["value"]))
    only = lambda part: F.when(F.contains(text, F.lit(part)), text).otherwise(F.lit(""))
    return [
        match_spans(only("@"), EMAIL, "email", 0),
        F.filter(match_spans(text, IP, "ip", 1), lambda s: s["value"].rlike(rf"^{octet}(?:\.{octet}){{3}}$")),
        F.filter(match_spans(text, CARD, "card", 2), card),
        F.filter(match_spans(only("+"), PHONE, "phone", 3), lambda s: count(s).between(9, 15)),
        F.filter(match_spans(text, IBAN, "iban", 4), lambda s: bind(
            F.regexp_replace(s["value"], " ", ""), lambda v: F.length(v).between(15, 34) & mod97(v))),
        F.filter(match_spans(text, TEL, "tel", 5), lambda s: count(s).between(8, 13))]


def scored(text, span):
    """A span's score between 0 and 1."""
    prior, words = F.lit(0.0), F.lit(False)
    for kind in PRIOR:
        prior = F.when(span["kind"] == kind, F.lit(PRIOR[kind])).otherwise(prior)
        words = F.when(span["kind"] == kind, near(text, span, WIDTH, whole_words(CONTEXT[kind]))).otherwise(words)
    up = F.when(words, F.lit(0.3)).otherwise(F.lit(0.0))
    down = F.when(near(text, span, WIDTH, whole_words(AGAINST)), F.lit(0.3)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), prior + up - down))


def with_pii(docs: DataFrame, name: str, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """``docs`` with an array column ``name`` of the spans: start, rank, stop,
    kind, value and score, by start and kind."""
    own = F.coalesce(F.col(quoted(text)), F.lit(""))
    found = free_name([*docs.columns, name], "found")
    rows = docs.withColumn(found, F.flatten(F.array(*confirmed(own))))
    marked = F.transform(F.col(found), lambda s: F.struct(
        s["start"], s["rank"], s["stop"], s["kind"], s["value"], scored(own, s).alias("score")))
    kept = F.filter(marked, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= min_score))
    return rows.withColumn(name, F.array_sort(kept)).drop(found)


def redact(docs: DataFrame, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets;
    of overlapping spans the first one counts."""
    spans = free_name(docs.columns, "spans")
    rows = with_pii(docs, spans, text, min_score)
    own = F.col(quoted(text))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(own, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            s["stop"].alias("at"), F.concat(acc["out"], gap, F.lit("<"), s["kind"], F.lit(">")).alias("out")))

    clean = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(
        acc["out"], F.substring(own, acc["at"] + 1, F.length(own))))
    return rows.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(own)).select(*map(quoted, docs.columns))


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans and scores."""
    rows = with_pii(docs.select("doc_id", "text"), "found").select("doc_id", "found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return rows.select("doc_id", *[count_kind(F.col("found"), k).alias(f"n_{k}") for k in BASE],
                       F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"),
                       F.array_join(F.transform("found", lambda s: F.round(s["score"], 2).cast("string")), ",")
                       .alias("scores"))
