"""Plain versions of the operators' contracts, row by row, to test against."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

#: (doc_id, text, lang, source): nulls, empties, ties, repeats, odd characters.
EDGE = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, None), (None, "some words here", "en", "b"),
    (4, "one", "en", "b"), (4, "one", "en", "b"), (5, "é ü 𝒳 word word", "fr", None),
    (6, "a\n\na\n b\n b \n a", "de", "c"), (7, "word " * 30_000, "en", "c"), (8, "x" * 50_000, "en", "c"),
    (9, "The quick brown fox jumps over the lazy dog again and again until night falls.", "en", "a"),
    (10, "The quick brown fox jumps over the lazy dog again and again until night falls.", "en", "d"),
    (11, "a  b   c \n\n d\t e   f <|endoftext|> g", "en", "d"), (-5, "negative id", "es", "d"),
]

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def windows(items, size=10):
    out, lengths = defaultdict(set), set()
    for item, text in items:
        w = WORDS.findall(low(text or ""))
        if w:
            n = min(size, len(w))
            lengths.add(n)
            for k in range(len(w) - n + 1):
                out[tuple(w[k:k + n])].add(item)
    return out, lengths


def contamination(text, known, lengths):
    w = WORDS.findall(low(text or ""))
    hit, items = set(), set()
    for n in lengths:
        for k in range(len(w) - n + 1):
            if (found := known.get(tuple(w[k:k + n]))) is not None:
                hit.update(range(k, k + n))
                items |= found
    items.discard(None)
    return len(w), len(hit), len(items), sha(",".join(sorted(map(str, items)))), bool(hit)


def cut(text, known, lengths, limit):
    """The text without its hit spans, or None if they are more than ``limit``
    of its words."""
    at = [(m.start(), m.end()) for m in WORDS.finditer(low(text or ""))]
    w = [low(text)[a:b] for a, b in at]
    hit = {k + o for n in lengths for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in known for o in range(n)}
    if len(hit) > limit * len(w):
        return None
    gone = set()
    for k in hit:
        gone.update(range(at[k][0], at[k + 1][0] if k + 1 in hit else at[k][1]))
    return "".join(c for i, c in enumerate(text) if i not in gone) if hit else text


def quality(text):
    text = text or ""
    w = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    covered = {k + d for v in at.values() if len(v) > 1 for k in v for d in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def simhash(text):
    w = SPACED.findall(low(text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits=4):
    """{id: smallest id reachable} of {id: fingerprint}."""
    ids = sorted(prints)
    all_of = np.array([prints[i] for i in ids], np.uint64)
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(all_of ^ all_of[i]) <= bits):
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    return {ids[k]: ids[find(k)] for k in range(len(ids))}


def targets(rows):
    """{source: (size, target)} of (source, words) rows."""
    size = Counter()
    for source, n in rows:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    out, free, rest = {s: 0.0 for s in order}, set(order), float(sum(size.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > 3 * size[s]]
        for s in over or list(free):
            out[s] = 3.0 * size[s] if over else rest * weight[s] / total
        if not over:
            break
        for s in over:
            free.discard(s)
            rest -= out[s]
    return {s: (size[s], out[s]) for s in order}


def token_rows(rows, tokenizer, end=2):
    """[(doc_id, start, n, crc)] of (doc_id, text) rows, by id."""
    out, start = [], 0
    coded = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end])
        coded.append((i is not None, i or 0, zlib.crc32(ids.astype("<u2").tobytes()), i, ids))
    for *_, i, ids in sorted(coded, key=lambda x: x[:3]):
        out.append((i, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        start += len(ids)
    return out


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def only_digits(text):
    return re.sub("[^0-9]", "", text)


PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
       ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(only_digits(m[0])) <= 19 and luhn(only_digits(m[0]))),
       ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m[0])) <= 15)]
SECRETS = [("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            lambda m: len(m[2]) >= 12),
           ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]


def spans(kinds, text):
    """(counts by kind, sha256 of the spans' list)."""
    counts, found = [], []
    for rank, (kind, pattern, good) in enumerate(kinds):
        own = [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if good(m)]
        counts.append(len(own))
        found += own
    return *counts, sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found)))


def archive(pages):
    """{page_id: (bytes, digest, type, refers_to)} of (page_id, html)."""
    last = {}
    for i, html in pages:
        last[html or ""] = max(last.get(html or "", i), i)
    out = {}
    for i, html in pages:
        raw, first = (html or "").encode(), last[html or ""]
        out[i] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                  "response" if first == i else "revisit", None if first == i else first)
    return out
