"""Views that give the test tables the shape of cases and predictions.

Each view is one SQL text that means the same in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lintel.storage import table


def nibble(h: str, at: int) -> str:
    """The value of one hexadecimal digit of a hash."""
    return f"(instr('0123456789abcdef', substr({h}, {at}, 1)) - 1)"


CONFIGS = "(VALUES " + ", ".join(f"('{m}', '{p}', {c})" for m in ("m1", "m2") for p in ("zero_shot", "zero_shot_cot", "few_shot_cot") for c in ("false", "true")) + ") AS c(model, prompt_type, context_enabled)"
BYTE = f"(16 * {nibble('h', 1)} + {nibble('h', 2)})"

VIEWS = {
    "cases": """
SELECT d.doc_id AS id, d.source || '-' || CAST(d.doc_id AS STRING) AS test_id, l.quality = 0 AS is_flaky,
  CASE WHEN l.quality = 0 THEN CASE d.lang WHEN 'de' THEN 'Time Dependent' WHEN 'en' THEN 'Implementation Dependent'
    WHEN 'es' THEN 'Non-Idempotent' ELSE 'Order Dependent' END ELSE 'Non-Flaky' END AS issue_category,
  d.source AS repo_url, d.lang AS lang, d.text AS test_code,
  'String u = "http://x/' || CAST(d.doc_id AS STRING) || '"; // ' || d.source || chr(10) || '/* block' || chr(10) || ' */ char s = ''/'';   ' || chr(10) || chr(10) || chr(10) || d.text AS java_code,
  CASE WHEN d.doc_id % 11 = 0 THEN '' ELSE 'Failed Rounds: ' || CAST(d.doc_id % 9 + 1 AS STRING) || '/10' || chr(10)
    || 'java.lang.AssertionError: expected ' || CAST(d.doc_id AS STRING) || '   ' || chr(10) || chr(10) || chr(10) || chr(10)
    || '    at org.junit.Assert.fail(Assert.java:86)' || chr(10)
    || '    at com.acme.C' || CAST(d.doc_id % 7 AS STRING) || 'Test.m' || CAST(d.doc_id % 5 AS STRING) || '(C.java:' || CAST(d.doc_id % 13 AS STRING) || ')' || chr(10)
    || 'Caused by: java.lang.IllegalStateException' || chr(10) || '    at com.acme.S' || CAST(d.doc_id % 3 AS STRING) || '.<init>(S.java:7)' || chr(13) || chr(10) || '    ... 3 more' END AS failure_log
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "predictions": f"""
SELECT id, test_id, CASE WHEN is_flaky THEN 'Flaky' ELSE 'Non-Flaky' END AS actual, issue_category AS actual_category,
  CASE WHEN flaky THEN 'Flaky' ELSE 'Non-Flaky' END AS predicted,
  CASE WHEN NOT flaky THEN 'Non-Flaky' WHEN {nibble('h', 3)} < 9 AND is_flaky THEN issue_category
    WHEN {nibble('h', 4)} < 4 THEN 'Time Dependent' WHEN {nibble('h', 4)} < 8 THEN 'Implementation Dependent'
    WHEN {nibble('h', 4)} < 12 THEN 'Non-Idempotent' ELSE 'Order Dependent' END AS predicted_category,
  CASE {nibble('h', 5)} % 7 WHEN 0 THEN 'The failure is deterministic, rather than timing or execution order.'
    WHEN 1 THEN 'An AssertionError shows a logic error.' WHEN 2 THEN 'It fails consistently and is repeatable.'
    WHEN 3 THEN 'There is no evidence of flakiness.' WHEN 4 THEN 'Order-dependent state, seen in an environment variable.'
    WHEN 5 THEN NULL ELSE 'Unclear.' END AS reasoning,
  split(nullif(concat_ws(';', CASE WHEN {nibble('h', 6)} % 2 = 0 THEN 'Failure Log: NPE' END, CASE WHEN {nibble('h', 6)} % 4 < 2 THEN 'helper setUp' END,
    CASE WHEN {nibble('h', 7)} % 3 = 0 THEN 'Foo.bar(x)' END, CASE WHEN {nibble('h', 7)} % 5 = 0 THEN 'misc' END,
    CASE WHEN {nibble('h', 8)} % 2 = 0 THEN 'Test Code' END, CASE WHEN {nibble('h', 8)} % 7 = 0 THEN 'assertion exception' END), ''), ';') AS evidence,
  model, prompt_type, context_enabled
FROM (
  SELECT *, {BYTE} < CASE WHEN is_flaky THEN CASE WHEN context_enabled THEN 150 ELSE 30 END
      ELSE CASE WHEN context_enabled THEN 40 ELSE 5 END END + CASE model WHEN 'm1' THEN 10 ELSE 0 END AS flaky
  FROM (
    SELECT k.*, c.*, md5(concat_ws('|', CAST(k.id AS STRING), c.model, c.prompt_type, CAST(c.context_enabled AS STRING))) AS h
    FROM {{cases}} k, {CONFIGS}
    WHERE k.is_flaky IS NOT NULL
  ) AS hashed
) AS judged""",
    "responses": f"""
SELECT model || '|' || prompt_type || '|' || CAST(context_enabled AS STRING) || '|' || CAST(id AS STRING) AS sample_id, id, model, prompt_type, context_enabled,
  CASE {nibble('g', 1)} WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```' WHEN 1 THEN substr(body, 1, length(body) - 3)
    WHEN 2 THEN replace(body, 'The failure', 'The "failure"') WHEN 3 THEN '[' || body || ']' WHEN 4 THEN 'no answer'
    WHEN 5 THEN replace(body, 'Non-Flaky"', 'Unknown"') ELSE body END AS raw
FROM (
  SELECT *, md5(CAST(id AS STRING) || model || prompt_type) AS g,
    '{{{{"classification": "' || predicted || '", "category": "' || predicted_category || '", "reasoning": "' || coalesce(reasoning, '') || '", "evidence": ["Test Code"]}}}}' AS body
  FROM {{predictions}}
) AS told""",
    "rounds": """
SELECT event_id AS round, user_id AS test, CASE WHEN event_type = 'error' THEN 'FAILURE' WHEN event_type = 'click' THEN ' Error ' ELSE 'pass' END AS status,
  'at com.acme.C' || CAST(event_id % 4 AS STRING) || '.run(C.java:1)' || chr(10) || 'message ' || CAST(event_id AS STRING) AS trace
FROM {events}""",
}
NEEDS = {"cases": ("documents", "labels"), "predictions": ("cases",), "responses": ("predictions",), "rounds": ("events",)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    frames = {n: view(spark, sf_dir, n) if n in VIEWS else table(spark, sf_dir, n) for n in NEEDS[name]}
    return spark.sql(VIEWS[name], **frames)


def _text(name: str) -> str:
    return VIEWS[name].format(**{n: n for n in NEEDS[name]})


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL that may read the named views."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, ()):
            add(n)
        if name in VIEWS and name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    heads = ", ".join(f"{n} AS ({_text(n)})" for n in wanted)
    body = sql.strip()
    return f"WITH {heads}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {heads} {body}"
