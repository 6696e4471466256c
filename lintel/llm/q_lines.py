"""op4: documents without lines that an earlier line repeats, exactly or but for a word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.lines import dedup_lines
from lintel.storage import table


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_exact", "n_near", "kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


QUERIES = {"op4_line_dedup": op4_line_dedup}
SQL = {
    "op4_line_dedup": r"""
WITH l AS (
  SELECT doc_id, i, l[i] AS line,
    trim(regexp_replace(translate(l[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), lines AS (SELECT norm, string_split(norm, ' ') AS w, min((doc_id, i)) AS pos FROM l WHERE norm <> '' GROUP BY norm),
long_lines AS (SELECT * FROM lines WHERE len(w) >= 8),
variants AS (
  SELECT norm, pos, i, array_to_string(w[:i - 1] || w[i + 1:], ' ') AS rest
  FROM (SELECT norm, pos, w, unnest(range(1, len(w) + 1)) AS i FROM long_lines)
), near_lines AS (
  SELECT norm FROM (SELECT norm, pos, min(pos) OVER (PARTITION BY i, rest) AS least FROM variants) WHERE least < pos
  UNION
  SELECT CASE WHEN v.pos < o.pos THEN o.norm ELSE v.norm END FROM variants v JOIN long_lines o ON v.rest = o.norm
), judged AS (
  SELECT l.doc_id, l.i, l.line, l.norm <> '' AS counts, l.norm <> '' AND (l.doc_id, l.i) <> lines.pos AS later,
    l.norm IN (SELECT norm FROM near_lines) AS near
  FROM l LEFT JOIN lines USING (norm)
), kept AS (
  SELECT doc_id, count(*) FILTER (counts) AS n_lines, count(*) FILTER (later) AS n_exact,
    count(*) FILTER (near AND NOT later) AS n_near,
    string_agg(line, chr(10) ORDER BY i) FILTER (NOT coalesce(later, false) AND NOT near) AS text
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
  coalesce(n_lines - n_exact - n_near, 0) AS kept, sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
}
