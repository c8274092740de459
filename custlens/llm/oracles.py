"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from custlens.llm import quality, vector_codes

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_BASE32 = " || ".join(
    f"translate(to_base(CAST('0x' || substr(h, {1 + 10 * i}, 10) AS BIGINT), 32, 8), "
    "'0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
    for i in range(4)
)

OP4 = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS main FROM p GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = main THEN 'response' ELSE 'revisit' END AS record_type,
       CAST(CASE WHEN page_id <> main THEN main END AS DOUBLE) AS refers_to
FROM p JOIN m USING (h)"""

OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER)} AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(generate_series(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
both_ AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT both_.b, r.c FROM r JOIN both_ ON both_.a = r.doc_id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n"""

OP10 = f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g HAVING count(*) > 1),
cut AS (SELECT DISTINCT doc_id, i + o AS pos FROM win JOIN f USING (g), range(50) t(o) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n
         FROM words ANTI JOIN cut USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _distance(p: str, q: str) -> str:
    part = "CASE WHEN {0} > 0 THEN {0} * log2({0} * 2 / (z[1] + z[2])) ELSE 0 END"
    terms = (
        f"list_transform(list_zip(list_transform({p}, lambda x: x / list_sum({p})), list_transform({q}, lambda x: x / list_sum({q}))), "
        f"lambda z: ({part.format('z[1]')} + {part.format('z[2]')}) / 2)"
    )
    return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN round(sqrt(greatest(0, list_sum({terms}))), 6) ELSE 0.0 END"


_LISTS = " ".join(f"WHEN '{code}' THEN {words!r}" for code, words in sorted(quality.COMMON_WORDS.items()))
_CLASSES = ", ".join(
    "length(body) - length(regexp_replace(body, '{}', '', 'g'))".format(p.replace("'", "''"))
    for p in ("[a-z]+", *quality.CHARACTER_CLASSES)
)

OP9 = rf"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
                  {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
b AS (
  SELECT *, len(ws) AS n_words, array_to_string(ws, '') AS body,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         CASE lang {_LISTS} ELSE [] END AS common FROM w),
t AS (SELECT doc_id, i, ws[i:i + 2] AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, n_words - 2)) AS i FROM b)),
d AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM t) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM d, range(3) v(o) GROUP BY doc_id),
h0 AS (SELECT *, [{_CLASSES}] AS c0, list_transform(common, lambda k: len(list_filter(ws, lambda x: x = k))) AS h0 FROM b),
h AS (SELECT *, list_append(c0, length(body) - list_sum(c0)) AS chars,
             list_append(h0, n_words - coalesce(list_sum(h0), 0)) AS hits FROM h0),
rc AS (SELECT lang, list(v ORDER BY i) AS ref_chars FROM (
  SELECT lang, i, sum(v) AS v FROM (SELECT lang, unnest(chars) AS v, unnest(generate_series(1, len(chars))) AS i FROM h)
  GROUP BY ALL) GROUP BY lang),
rh AS (SELECT lang, list(v ORDER BY i) AS ref_hits FROM (
  SELECT lang, i, sum(v) AS v FROM (SELECT lang, unnest(hits) AS v, unnest(generate_series(1, len(hits))) AS i FROM h)
  GROUP BY ALL) GROUP BY lang),
m AS (
  SELECT doc_id, n_words, length(body) AS word_chars,
         length(body) - length(translate(body, '{quality.SYMBOLS}', '')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         {_distance("chars", "ref_chars")} AS class_distance, {_distance("hits", "ref_hits")} AS word_distance
  FROM h JOIN rc USING (lang) JOIN rh USING (lang) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < {quality.MIN_BASE_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND (n_words < {quality.MIN_WORDS} OR
       (class_distance <= {quality.MAX_CLASS_DISTANCE} AND word_distance <= {quality.MAX_WORD_DISTANCE})) AS kept
FROM f"""

# The rounds of operator 13, written out one after another.
_NEAREST = """p{r} AS MATERIALIZED (
  SELECT vec_id, p, x, min([list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) AS best
  FROM parts JOIN c{r} USING (p) GROUP BY vec_id, p, x)"""
_MEANS = """m{r} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, CAST(floor(sum(v) / count(*)) AS BIGINT) AS m
    FROM (SELECT p, best[2] AS e, unnest(x) AS v, unnest(generate_series(1, len(x))) AS i FROM p{r}) GROUP BY ALL) GROUP BY ALL),
c{n} AS MATERIALIZED (SELECT p, e, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (p, e))"""
_ROUNDS = ",\n".join(
    _NEAREST.format(r=r) + ("" if r == vector_codes.ROUNDS else ",\n" + _MEANS.format(r=r, n=r + 1)) for r in range(vector_codes.ROUNDS + 1)
)

OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {vector_codes.PARTS} + 1 : (p + 1) * len(v) // {vector_codes.PARTS}] AS x
  FROM kept, range({vector_codes.PARTS}) t(p)),
c0 AS MATERIALIZED (
  SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts)
  WHERE e < {vector_codes.ENTRIES}),
{_ROUNDS},
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM c{vector_codes.ROUNDS}),
coded AS (
  SELECT vec_id, string_agg(lower(format('{{:02x}}', best[2])), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM p{vector_codes.ROUNDS} GROUP BY vec_id),
by_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label)
SELECT kept.vec_id, code, error, label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (vec_id) JOIN by_label ON kept.label IS NOT DISTINCT FROM by_label.label, books"""

ORACLE = {"op4_warc": OP4, "op6_ngram_join": OP6, "op9_quality_rules": OP9, "op10_fm_dedup": OP10, "op13_vector_codes": OP13}
