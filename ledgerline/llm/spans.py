"""Spans of regular-expression matches, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import functions as F

CHUNK = 256
SPANS = "array<struct<start:int,rank:int,stop:int,kind:string,value:string>>"


def bind(value, then):
    """``then(value)`` with ``value`` evaluated once, whatever its uses."""
    return F.get(F.transform(F.array(value), then), 0)


def match_spans(text, pattern: str, kind: str, rank: int):
    """Array of spans (start, rank, stop, kind, value): the leftmost
    non-overlapping matches of a Java pattern, in code points, end exclusive.

    Matches and the gaps between them (``split`` by the same pattern)
    alternate; running sums of their lengths are the positions. The sums are
    made chunk by chunk, so that a text of very many matches stays cheap."""
    none = F.array().cast(SPANS)

    def step(acc, x):
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["value"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"),
                        x["value"].alias("value"))
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def placed(chunk, at):
        return F.aggregate(chunk, F.struct(at.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    def chunks_of(pairs):
        starts = F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK))
        return F.transform(starts, lambda k: F.slice(pairs, k, CHUNK))

    def width(chunk):
        return F.aggregate(chunk, F.lit(0), lambda acc, x: acc + x["gap"] + F.length(x["value"]))

    def begins(chunks):
        first = F.array(F.lit(0))
        return F.aggregate(chunks, first, lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + width(c))))

    def place(found):
        pairs = F.slice(F.zip_with(F.split(text, pattern, -1), found, lambda g, v: F.struct(
            F.length(g).alias("gap"), v.alias("value"))), 1, F.size(found))
        cut = bind(pairs, chunks_of)
        return bind(cut, lambda c: F.flatten(F.zip_with(
            c, F.slice(begins(c), 1, F.size(c)), lambda chunk, at: placed(chunk, at))))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bind(matches, lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none))


def span_text(spans):
    """kind:start:stop of each span, comma-joined, in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def count_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def near(text, span, width: int, pattern: str):
    """Whether ``pattern`` is within ``width`` characters before or after.

    The windows are widened to whole words (by one word piece of at most
    ``width`` characters at each outer edge), so that a word which the edge
    would cut is seen as a whole or, where it is longer, not as a shorter one."""
    far = 2 * width
    before = F.substring(text, F.greatest(span["start"] - far, F.lit(0)) + 1, F.least(span["start"], F.lit(far)))
    after = F.substring(text, span["stop"] + 1, F.lit(far))
    ahead = F.regexp_extract(before, rf"(?s)[\p{{L}}\p{{N}}]*.{{0,{width}}}$", 0)
    behind = F.regexp_extract(after, rf"(?s)^.{{0,{width}}}[\p{{L}}\p{{N}}]*", 0)
    return ahead.rlike(pattern) | behind.rlike(pattern)
