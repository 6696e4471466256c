"""op13: how far the sources of each language are from one another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lintel.llm.divergence import audited
from lintel.storage import table


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {"op13_source_divergence": op13_source_divergence}
SQL = {
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(c) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + v.v) AS p, 1 + (1000000000 * (k.c + 1)) // (v.n + v.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang
    LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
}
