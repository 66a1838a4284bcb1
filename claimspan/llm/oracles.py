"""The queries that SQL can express, in DuckDB's dialect; the others are held against brute force in the tests."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = _LOWER.format("coalesce(text, '')")
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = rf"regexp_extract_all({_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LINES = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
parts AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM docs),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS k FROM parts),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
marked AS (SELECT *, k IN (SELECT k FROM common) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

PASSAGES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS k
  FROM i, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(p)),
hits AS (SELECT r, p, n, item FROM doc_windows JOIN item_windows USING (n, k)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM hits, unnest(generate_series(p, p + n - 1)) AS t(q) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + least(5, len(w)) - 1], ' ') AS s
  FROM d, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * pairs.n >= 75 * (x.n + y.n - pairs.n)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM pairs WHERE same)
  WHERE place <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score, p.place AS positive_rank,
         row_number() OVER (PARTITION BY p.r, p.place ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives AS p JOIN pairs AS n ON p.r = n.r AND NOT n.same
  WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score,
       CAST(positive_rank AS INTEGER) AS positive_rank
FROM negatives WHERE place <= 10
"""

SQL = {
    "op1_line_dedup": LINES,
    "op6_decontaminate": PASSAGES,
    "op8_bit_sliced": TOP_K,
    "op10_near_dup": NEAR_DUPLICATES,
    "op11_hard_negatives": HARD_NEGATIVES,
}
