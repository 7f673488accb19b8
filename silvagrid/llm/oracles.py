"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

#: A-Z lowered, all other characters as they are.
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of documents that share a shingle, compared on full sets.
_OP5 = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM docs),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
  SELECT doc_id, doc_id FROM docs
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
lowest AS (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_OP12 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
langs AS (SELECT l.lang, count(k.term) AS v, coalesce(sum(k.n), 0)::HUGEINT AS total
          FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k USING (lang) GROUP BY l.lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT g.lang, g.source, any_value(l.v) AS v, any_value(l.total) AS lang_total, coalesce(sum(c.n), 0)::HUGEINT AS total
           FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source)
           GROUP BY g.lang, g.source),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + g.v) AS p,
                 1 + 1000000000::HUGEINT * (k.n + 1) // (g.lang_total + g.v) AS q
          FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM cells WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_OP13 = rf"""
WITH steps AS (
  SELECT n, list_reduce([n] || list_transform(range(8), lambda x: 0::BIGINT),
                        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256))::BIGINT AS n)),
crc_table AS (SELECT list(c ORDER BY n) AS c FROM steps),
docs AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
target AS (SELECT unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
words AS (SELECT id, unnest(words) AS word FROM docs),
corpus AS (SELECT word, count(*) AS n FROM words GROUP BY word),
goal AS (SELECT word, count(*) AS n FROM target GROUP BY word),
distinct_words AS (SELECT word, hex(word) AS h FROM (SELECT word FROM corpus UNION SELECT word FROM goal)),
placed AS (
  SELECT word, xor(list_reduce(
           [4294967295::BIGINT] || list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, crc_table.c[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_words, crc_table),
s AS (SELECT bucket, sum(n)::BIGINT AS n FROM corpus JOIN placed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS n FROM goal JOIN placed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t),
gains AS (
  SELECT p.word, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (totals.s + 10000)
                                 / ((coalesce(s.n, 0) + 1)::DOUBLE * (totals.t + 10000))))::BIGINT AS gain
  FROM placed p LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
sums AS (SELECT id, count(*) AS n, sum(gain)::HUGEINT AS gain FROM words JOIN gains USING (word) GROUP BY id),
weighed AS (
  SELECT d.doc_id, coalesce(w.n, 0)::BIGINT AS n_features,
         CASE WHEN w.n IS NULL THEN 0 ELSE (w.gain - ((w.gain % w.n) + w.n) % w.n) // w.n END::BIGINT AS weight,
         ('0x' || left(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 8))::BIGINT AS h
  FROM docs d LEFT JOIN sums w USING (id)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         (SELECT count(*) FROM scored WHERE n_features >= 20) AS eligible
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM ranked
"""

ORACLES: dict[str, str] = {"op5_lsh_forest": _OP5, "op12_pattern_tree_divergence": _OP12, "op13_segment_resampling": _OP13}
