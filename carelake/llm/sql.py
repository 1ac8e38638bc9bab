"""DuckDB SQL of the operators that SQL can state, by other means than theirs.

All take ``documents`` with distinct doc_ids.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4_SQL = rf"""
WITH split AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split
), windows AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i:i + 19], ' ') END AS passage FROM places
), marked AS (
  SELECT doc_id, i, word,
    passage IS NOT NULL AND row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1 AS again
  FROM windows
), covered AS (
  SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM marked
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM covered GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

OP6_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS grams
  FROM split
), held AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM held a JOIN held b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT doc_id, len(grams)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""

OP9_SQL = """
WITH spelled AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), places AS (
  SELECT doc_id, n, x, unnest(range(0, n)) AS i FROM spelled
), strings AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 2) AS one, CASE WHEN i + 50 <= n THEN md5(substr(x, 2 * i + 1, 100)) END AS string FROM places
), marked AS (
  SELECT doc_id, i, one, string IS NOT NULL AND min(doc_id) OVER (PARTITION BY string) < doc_id AS again FROM strings
), covered AS (
  SELECT doc_id, i, one, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM marked
), edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS head FROM covered
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (head) AS n_spans, string_agg(one, '' ORDER BY i) FILTER (NOT gone) AS x
  FROM edged GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept.x, ''))) AS kept_sha256
FROM spelled LEFT JOIN kept USING (doc_id)
"""
