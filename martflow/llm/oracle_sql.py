"""DuckDB SQL for operators whose results SQL can state plainly, by comparing
everything with everything.  It is meant for small tables; the operators find the
same by their own methods."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: op4: every 100-byte string of every text, kept where it starts first.
OP4_SQL = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS row, doc_id, encode(coalesce(text, '')) AS b,
         octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT row, o, b[o + 1:o + 100] AS s FROM (
    SELECT row, b, unnest(generate_series(0, n - 100)) AS o FROM d WHERE n >= 100)),
again AS (
  SELECT row, o FROM (SELECT row, o, row_number() OVER (PARTITION BY md5(hex(s)) ORDER BY row, o) AS nth FROM w) WHERE nth > 1),
runs AS (   -- stretches of removed bytes
  SELECT row, min(o) AS a, max(o) + 100 AS z FROM (
    SELECT row, o, sum(fresh) OVER (PARTITION BY row ORDER BY o) AS run FROM (
      SELECT row, o, CASE WHEN o - lag(o) OVER (PARTITION BY row ORDER BY o) <= 100 THEN 0 ELSE 1 END AS fresh FROM again))
  GROUP BY row, run),
per AS (
  SELECT row, sum(z - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends
  FROM runs GROUP BY row),
kept AS (
  SELECT d.row, doc_id, n, n_removed, n_spans,
         CASE WHEN n_spans IS NULL THEN b ELSE list_reduce(list_transform(generate_series(0, n_spans), lambda i:
           b[CASE WHEN i = 0 THEN 1 ELSE ends[i] + 1 END:CASE WHEN i = n_spans THEN n ELSE starts[i + 1] END]),
           lambda x, y: x || y) END AS left_over
  FROM d LEFT JOIN per ON d.row = per.row)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(left_over) AS kept_sha256
FROM kept
"""

#: op5: all pairs of documents that share a shingle.
OP5_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w),
five AS (
  SELECT doc_id, n, i, concat_ws(' ', t, lead(t, 1) OVER p, lead(t, 2) OVER p, lead(t, 3) OVER p, lead(t, 4) OVER p) AS x
  FROM t WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT DISTINCT doc_id, md5(x) AS x FROM five WHERE i <= greatest(n - 4, 1)),
s AS (SELECT w.doc_id, count(x) AS n FROM w LEFT JOIN e ON w.doc_id = e.doc_id GROUP BY w.doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN s x ON a = x.doc_id JOIN s y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, component_id
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

#: op10: all pairs of vectors.
OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT m.vec_id, coalesce(n, 0) AS n_links, component_id, m.vec_id = component_id AS kept
FROM embeddings m JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c ON m.vec_id = c.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON m.vec_id = l.a
"""
