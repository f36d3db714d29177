"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
),
lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM split
),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_UPPER.lower()}') AS key FROM lines
),
frequent AS (
  SELECT key AS gone FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent ON key = gone GROUP BY doc_id"""

EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings
),
units AS (
  SELECT vec_id, list_transform(v, lambda c: c / sqrt(list_inner_product(v, v))) AS u FROM vectors
  WHERE list_inner_product(v, v) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.u, b.u) >= 0.9
),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM vectors
  UNION
  SELECT node, b FROM reach JOIN links ON other = a
)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links,
       min(other) AS component_id, min(other) = node AS kept
FROM reach GROUP BY node"""

EXACT_TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

FILL_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS r1,
         CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS r2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
),
cuts AS (
  SELECT *, array_to_string(u[1:least(r1, r2)], '') AS prefix,
         array_to_string(u[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
         array_to_string(u[greatest(r1, r2) + 1:n], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cuts"""

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op3_embedding_near_dedup": EMBEDDING_NEAR_DEDUP,
    "op9_exact_top_k": EXACT_TOP_K,
    "op13_fill_middle": FILL_MIDDLE,
}
