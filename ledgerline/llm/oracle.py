"""DuckDB SQL of the queries that SQL can express: decontamination, quality
rules, archives. Written from the contracts, over whole tables."""

from __future__ import annotations

import string

_SMALL = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_ITEM_WORDS = rf"regexp_extract_all({_SMALL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
    known AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
                     list_slice(w, k + 1, k + least(10, len(w))) AS words
              FROM i, LATERAL (SELECT unnest(range(len(w) - least(10, len(w)) + 1)) AS k) WHERE len(w) > 0),
    seen AS (SELECT r, s.n, k, list_slice(w, k + 1, k + s.n) AS words
             FROM d, (SELECT DISTINCT n FROM known) s, LATERAL (SELECT unnest(range(len(w) - s.n + 1)) AS k)),
    found AS (SELECT r, k, n, item_id FROM seen JOIN known USING (n, words)),
    hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM found, LATERAL (SELECT unnest(range(k, k + n)) AS p) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


# Shares in thousandths less one occurrence (six words for a repeated window);
# a bucket is a value with all but its nine leading bits cleared. Limits are the
# outer quantile and three times its distance from the median (at least what
# its bucket hides) beyond it:
# 90 % of symbols and word length (10 % below), 98 % of repeated words and
# lines. A language counts as 50 documents of each of its strata, the corpus as
# 50 of each language.
_LEADING = "(v >> greatest(length(bin(v)) - 9, 0)) << greatest(length(bin(v)) - 9, 0)"
_HIDDEN = "(1 << greatest(length(bin(q)) - 9, 0)) - 1"
QUALITY = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    three AS (SELECT r, k, count(*) OVER (PARTITION BY r, g) AS n
              FROM (SELECT r, k, list_slice(w, k, k + 2) AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS k))),
    again AS (SELECT r, count(DISTINCT k + o) AS n_repeat_words FROM three, range(3) x(o) WHERE n > 1 GROUP BY r),
    lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    counts AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                      CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                      CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                      CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
                      coalesce(n_repeat_words, 0) AS n_repeat_words
               FROM d JOIN lines USING (r) LEFT JOIN again USING (r)),
    rated AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
    vals AS (SELECT r, lang, source, base_failed, x.f, {_LEADING.replace('v', 'x.v')} AS b
             FROM (SELECT *, unnest([{{'f': 'sym', 'v': greatest(n_symbols - 1, 0) * 1000 // greatest(n_words, 1)}},
                                     {{'f': 'rep', 'v': greatest(n_repeat_words - 6, 0) * 1000 // greatest(n_words, 1)}},
                                     {{'f': 'dup', 'v': greatest(n_dup_lines - 1, 0) * 1000 // greatest(n_lines, 1)}},
                                     {{'f': 'len', 'v': word_chars * 1000 // greatest(n_words, 1)}}]) AS x FROM rated)),
    good AS (SELECT lang, source, f, b, count(*) AS n FROM vals WHERE NOT base_failed GROUP BY ALL),
    strata AS (SELECT lang, source, f, sum(n) AS t2, sum(sum(n)) OVER (PARTITION BY lang, f) AS t1, sum(sum(n)) OVER (PARTITION BY f) AS t0
               FROM good GROUP BY lang, source, f),
    marks AS (SELECT f, b, sum(n) AS n0 FROM good GROUP BY ALL),
    weighed AS (SELECT s.lang, s.source, s.f, m.b,
                       CAST(coalesce(own.n, 0) AS HUGEINT) * t0 * (t1 + 50)
                       + 50 * (coalesce(l.n1, 0) * t0 + 50 * n0) AS w, CAST(t2 + 50 AS HUGEINT) * t0 * (t1 + 50) AS total
                FROM strata s JOIN marks m USING (f)
                LEFT JOIN good own ON own.lang IS NOT DISTINCT FROM s.lang AND own.source IS NOT DISTINCT FROM s.source
                  AND own.f = s.f AND own.b = m.b
                LEFT JOIN (SELECT lang, f, b, sum(n) AS n1 FROM good GROUP BY ALL) l
                  ON l.lang IS NOT DISTINCT FROM s.lang AND l.f = s.f AND l.b = m.b),
    upto AS (SELECT lang, source, f, b, total, sum(w) OVER (PARTITION BY lang, source, f ORDER BY b) AS c FROM weighed),
    quants AS (SELECT lang, source, f, min(b) FILTER (2 * c >= total) AS mid, min(b) FILTER (10 * c >= 9 * total) AS q9,
                      min(b) FILTER (50 * c >= 49 * total) AS q49, min(b) FILTER (10 * c >= total) AS q1
               FROM upto GROUP BY lang, source, f),
    fences AS (SELECT *, CASE WHEN f IN ('sym', 'len') THEN q9 ELSE q49 END AS top FROM quants),
    odd AS (SELECT DISTINCT r FROM vals v JOIN fences q
              ON q.lang IS NOT DISTINCT FROM v.lang AND q.source IS NOT DISTINCT FROM v.source AND q.f = v.f
            WHERE v.b > top + 3 * greatest(top - mid, {_HIDDEN.replace('q', 'top')})
               OR (v.f = 'len' AND v.b < q1 - 3 * greatest(mid - q1, {_HIDDEN.replace('q', 'q1')})))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND r NOT IN (SELECT r FROM odd) AS kept
    FROM rated"""


# Base 32 of a SHA-1: each five hexadecimal digits are four characters.
ARCHIVES = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
    SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
               CAST('0x' || substr(x, 1 + 5 * (k // 4), 5) AS INTEGER) >> (15 - 5 * (k % 4))) & 31 AS INTEGER), 1)), '')
               AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM m"""


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, two half bytes a step."""
    table = []
    for k in range(16):
        for _ in range(4):
            k = (k >> 1) ^ (0xEDB88320 * (k & 1))
        table.append(k)
    lookup = f"({table}::BIGINT[])"
    half = lambda c, b: f"xor({c} >> 4, {lookup}[(xor({c}, {b}) & 15) + 1])"
    nibbles = (f"list_transform(range(2 * strlen({text})), lambda k: CAST('0x' || "
               f"substr(hex(encode({text})), 2 * (k // 2) + 2 - k % 2, 1) AS BIGINT))")
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {nibbles}), lambda c, b: {half('c', 'b')}), 4294967295::BIGINT)"


_FIELDS = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
_LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_OFFERED = f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_LOWERED} ELSE text END"

# Every level of every tree; the subroots' tree is the one without a source number.
MANIFEST = f"""
    WITH RECURSIVE d AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, source, sha256(concat({', '.join(_FIELDS)}, {_field('text')})) AS leaf,
               sha256(concat({', '.join(_FIELDS)}, {_field(f'({_OFFERED})')})) AS offered FROM documents),
    p AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n FROM d),
    inner_nodes AS (
        SELECT g, 0 AS lvl, i, leaf AS h, n FROM p
        UNION ALL
        SELECT g, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 15) // 16 FROM inner_nodes WHERE n > 1
        GROUP BY g, lvl, i // 16),
    sub AS (SELECT g, h AS subroot FROM inner_nodes WHERE n = 1),
    top_nodes AS (
        SELECT 0 AS lvl, g AS i, subroot AS h, count(*) OVER () AS n FROM sub
        UNION ALL
        SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 15) // 16 FROM top_nodes WHERE n > 1
        GROUP BY lvl, i // 16),
    steps AS (
        SELECT r, 0 AS part, lvl, string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < p.i >> (4 * lvl)) AS b,
               string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > p.i >> (4 * lvl)) AS a
        FROM p JOIN inner_nodes x ON x.g = p.g AND x.n > 1 AND x.i // 16 = p.i >> (4 * lvl + 4) GROUP BY r, lvl
        UNION ALL
        SELECT r, 1, lvl, string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < p.g >> (4 * lvl)),
               string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > p.g >> (4 * lvl))
        FROM p JOIN top_nodes x ON x.n > 1 AND x.i // 16 = p.g >> (4 * lvl + 4) GROUP BY r, lvl),
    paths AS (SELECT r, string_agg(coalesce(b, '') || coalesce(a, ''), '' ORDER BY part, lvl) AS proof,
                     list(coalesce(b, '') || '|' || coalesce(a, '') ORDER BY part, lvl) AS sides FROM steps GROUP BY r),
    folded AS (SELECT p.*, coalesce(proof, '') AS proof, list_reduce(list_concat([offered], coalesce(sides, [])),
                      lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
               FROM p LEFT JOIN paths USING (r))
    SELECT doc_id, leaf, subroot, (SELECT h FROM top_nodes WHERE n = 1) AS root, sha256(proof) AS proof_sha256, folded_root,
           folded_root = (SELECT h FROM top_nodes WHERE n = 1) AS verified
    FROM folded JOIN sub USING (g)"""

_SPACED = rf"regexp_extract_all({_SMALL}, '[^\x20\x09-\x0D]+')"

# Pairs by counting common shingles; copies of a set are one class first.
JACCARD = rf"""
    WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(list_transform(
            range(CASE WHEN len(w) = 0 THEN 0 ELSE greatest(1, len(w) - 2) END), lambda k: array_to_string(w[k + 1:k + 3], ' ')))) AS s
        FROM (SELECT doc_id, {_SPACED} AS w FROM documents)),
    sets AS MATERIALIZED (SELECT row_number() OVER () AS c, min(doc_id) AS least, s, len(s) AS n FROM d WHERE len(s) > 0 GROUP BY s),
    grams AS (SELECT c, n, unnest(s) AS gram FROM sets),
    pairs AS MATERIALIZED (SELECT x.c AS a, y.c AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.c <> y.c AND 10 * x.n >= 9 * y.n
                AND 10 * y.n >= 9 * x.n GROUP BY ALL HAVING 100 * count(*) >= 90 * (max(x.n) + max(y.n) - count(*))),
    reach AS (SELECT c, c AS o FROM sets UNION SELECT r.c, p.b FROM reach r JOIN pairs p ON r.o = p.a),
    ends AS (SELECT r.c, min(o.least) AS component_id FROM reach r JOIN sets o ON o.c = r.o GROUP BY r.c)
    SELECT doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, CASE WHEN len(d.s) = 0 THEN doc_id ELSE component_id END AS component_id
    FROM d LEFT JOIN sets ON sets.s = d.s LEFT JOIN ends USING (c)"""

# Words are near if they are equal without one code point of one or of both.
VARIANTS = rf"""
    WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
                              '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run FROM documents),
    dealt AS (SELECT run, n, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h
              FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL)),
    cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM dealt),
    words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    less AS MATERIALIZED (SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest
                          FROM words, LATERAL (SELECT unnest(range(length(word))) AS k)),
    pairs AS (SELECT x.word AS a, y.word AS b, y.n FROM less x JOIN less y ON x.rest = y.rest AND x.k = y.k AND x.word <> y.word
              UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
              UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
    best AS (SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS b, max(n) AS form_n FROM pairs GROUP BY a),
    forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN b END AS form,
                                  CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM words LEFT JOIN best ON a = word),
    chain AS (SELECT word, word AS tip, form AS ahead FROM forms
              UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead)
    SELECT word, f.form, tip AS root, f.n, f.n_near, f.form_n FROM chain JOIN forms f USING (word) WHERE ahead IS NULL"""
