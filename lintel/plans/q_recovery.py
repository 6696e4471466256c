"""Queries over runs of experiments, their recovery, and the small operators around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.functions import structures as S
from lintel.functions import text as T
from lintel.operators import code as C
from lintel.operators import profile as P
from lintel.operators import prompts as R
from lintel.operators import recovery as V
from lintel.operators import responses as A
from lintel.operators import select as L
from lintel.operators import stages as G
from lintel.operators import traces as X
from lintel.operators.quantiles import with_quantiles
from lintel.plans.adapters import view, with_views
from lintel.plans.q_flow import RECOVERED, on, sql
from lintel.plans.q_profile import JAVA_STRIP
from lintel.storage import table, written


def _lined(df):
    return L.numbered(df, ["model"], ["sample_id"], "line")


def _rejects(df):
    _, bad = V.parsed_with_rejects(_lined(df))
    return bad.select("line", "sample_id", "error", F.md5("raw_response").alias("raw_md5"))


def _manifest(df):
    requests, failed = df.select("sample_id", "raw"), A.parse(df).filter("error is not null")
    return V.retry_manifest(requests, failed)[1]


def _requests(df) -> DataFrame:
    return df.select("sample_id", "id", "model", F.col("prompt_type").alias("input"))


GOOD = '{"classification": "Flaky", "category": "Time Dependent", "reasoning": "again", "evidence": []}'
BROKEN = '{"classification": "Non-Flaky", "category": "Non-Flaky", "reasoning": "a "b"", "evidence": ['


def _scorer(requests):
    """Asked again, one in three is well formed and one in three can be read by field; under strict rules two more of seven are."""
    strict = F.contains(F.col("input"), F.lit("IMPORTANT OUTPUT RULES"))
    raw = F.when(strict & (F.col("id") % 7 < 2), GOOD).when(~strict & (F.col("id") % 3 == 0), GOOD).when(~strict & (F.col("id") % 3 == 1), BROKEN).otherwise("nothing")
    return requests.select("sample_id", raw.alias("raw"))


def _recovered(df):
    out, _ = V.recovered(_requests(df), df.select("sample_id", "raw"), None, _scorer)
    return out.select("sample_id", "via", "output.classification", "output.category")


def _best_effort(df):
    failed = A.parse(df).filter("error is not null").select("sample_id")
    got = V.retry_parsed(written(_scorer(_requests(df)), "fixture"), failed, strict=False)
    return got["parsed"].select("sample_id", "output.classification", "recovered").unionByName(got["unresolved"].select("sample_id", F.lit(None).cast("string").alias("classification"), F.lit(None).cast("boolean").alias("recovered")))


def _strict(df):
    failed = A.parse(df).filter("error is not null").select("sample_id")
    return V.strict_requests(_requests(df), failed).select("sample_id", F.length("input").cast("long").alias("chars"), F.md5("input").alias("md5"))


def _strict_pass(df):
    base = A.parse(df).filter("error is null").select("sample_id", "output")
    left = df.select("sample_id").join(base, "sample_id", "left_anti")
    return V.strict_pass(_requests(df), base, left, _scorer)[2]


def _client(prompt):
    if "cot" in prompt:
        raise ValueError(f"no answer to {prompt}")
    return '```json\n{"classification": "Flaky", "category": "Order Dependent", "reasoning": "r", "evidence": ["e"]}\n```' if prompt else "words"


def _single(spark, sf_dir):
    """Every prompt by itself; a failing client gives an error row."""
    replies = view(spark, sf_dir, "responses").select("sample_id", "id", "model", F.when(F.col("id") % 5 == 0, "").otherwise(F.col("prompt_type")).alias("prompt"))
    rows = V.with_error_rows(V.scored(replies, _client))
    return rows.select("sample_id", *V.fields(F.col("output"))).withColumn("evidence", F.array_join("evidence", ","))


def _predictions(spark, sf_dir):
    replies = A.parse(view(spark, sf_dir, "responses")).filter("error is null")
    cases = view(spark, sf_dir, "cases").select("id", "test_id", F.col("is_flaky").cast("int").alias("isFlaky"), "issue_category")
    out = V.predictions(replies, cases, F.col("model"), F.col("prompt_type"), F.col("context_enabled"))
    return out.withColumn("evidence", F.array_join("evidence", ",")).withColumn("folder", V.experiment_folder(F.col("context_enabled")))


def _chunked_run(df):
    out = V.run(_requests(df).withColumn("part", F.col("id") % 3), lambda part: _scorer(part), chunk="part")
    return out.groupBy("raw").agg(F.count("*").alias("n"))


def _policy(df):
    return V.policy(A.fill_missing(A.parse(df).filter("error is null").select("sample_id", F.col("output.classification").alias("predicted")), df.select("sample_id")).filter("is_filled"), "m1")


def _errors(spark, sf_dir):
    one = F.struct(F.concat(F.lit("code"), (F.col("c_custkey") % 3).cast("string")).alias("code"), F.col("c_name").alias("message"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("param"))
    return table(spark, sf_dir, "customer").select("c_custkey", A.error_text(one).alias("said"))


def _reply_texts(spark, sf_dir):
    """Two text parts around a part of another kind."""
    k = F.col("c_custkey").cast("string")
    response = F.concat(F.lit('{"output":[{"type":"reasoning"},{"type":"message","content":[{"type":"output_text","text":"```json'), k, F.lit('"},{"type":"refusal","text":"no"},{"type":"output_text","text":"```"}]}]}'))
    return table(spark, sf_dir, "customer").select("c_custkey", V.reply_text(response).alias("said"))


def _percentiles(df):
    """Rows of a case and strategy count once: the case with the longer log."""
    rows = df.select((F.col("id") % 50).alias("sample"), "lang", F.length("test_code").alias("v"), "id")
    first = L.keep_first(rows, ["sample", "lang"], [F.desc("v"), F.col("id")])
    first = written(first.select("lang", "v"), "deduped")
    out = with_quantiles(first.groupBy("lang").agg(F.count("*").alias("n")), first, ["lang"], {f"p{int(100 * p)}": (F.col("v"), p) for p in (0.95, 0.99)})
    return out.select("lang", "n", F.round("p95", 4).alias("p95"), F.round("p99", 4).alias("p99"))


def _tokens(df):
    """The caller's tokenizer runs in Arrow batches: here words and other signs."""
    return R.counted_tokens(df.select("id", F.col("test_code").alias("t")), "t", _signs).select("id", F.col("tokens").cast("long").alias("tokens"))


def _signs(text):
    return sum(len(w) > 0 for w in text.split(" "))


def _scaled(df):
    m = df.groupBy("lang").agg(F.round(F.avg(F.col("is_flaky").cast("int")), 6).alias("Baseline share"), F.round(F.avg((F.col("id") % 2).cast("int")), 6).alias("Δ share"), F.count("*").alias("n"))
    return P.scaled(m, ("Baseline", "Context", "Δ")).select("lang", F.round("Baseline share", 3).alias("baseline"), F.round("Δ share", 3).alias("delta"), "n")


def _split(df):
    long = df.groupBy("lang").agg(F.count("*").alias("Baseline F1"), F.max("id").alias("Context Macro F1")).unpivot(["lang"], ["Baseline F1", "Context Macro F1"], "name", "v")
    return P.split_column(long, "name", "setting", "measure")


def _orphans(df):
    code = F.concat(F.lit(" * left\n */\n<p>x\n\n"), F.substring("test_code", 1, 10**9))
    return df.select("id", F.md5(T.strip_orphan_docs(code)).alias("md5"), F.md5(C.without_orphan_comments(F.concat(F.lit("  * a\n/** b\n*c\n */ d\n"), "test_code"))).alias("masked"))


def _rounds_text(df):
    lines = F.split(F.col("failure_log"), "\n")
    return df.select("id", F.md5(T.without_rounds(F.col("failure_log"))).alias("bare"), F.md5(T.format_frames(lines)).alias("frames"))


def _map_values(df):
    m = F.map_from_arrays(F.array("repo_url", F.lit("b")), F.array("java_code", F.lit("x // y")))
    clean = S.mapped(m, T.strip_comments)
    return df.select("id", F.md5(F.array_join(F.map_values(clean), "|")).alias("md5"), S.is_empty_map(F.when(F.col("id") % 2 == 0, m)).alias("empty"), S.is_empty_map(F.map_filter(m, lambda k, _: k == "none")).alias("none"))


def _sections(spark, sf_dir):
    text = F.concat(F.lit("head\n--- a.B::one\nlog "), F.col("c_name"), F.lit("\n\n\n--- no section\nx\n--- a.C::two\n"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(X.sections(text)).alias("i", "s")).select("c_custkey", F.col("i").cast("long").alias("i"), "s.*")


def _diff(spark, sf_dir):
    patch = F.concat(F.lit("--- a\n-before\n@@ -1 @@\n-one "), F.col("c_name"), F.lit("\n kept\n+new\n--- b\n-out\n@@ -2 @@\n-two"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.removed_lines(patch).alias("removed"), X.removed_lines(patch, True).alias("context"))


def _schema(df):
    out = P.schema_difference(df, ["id", "test_id", "other"]).withColumnRenamed("state", "what")
    return out.unionByName(P.schema_listing(df).select("column", F.col("type").alias("what")))


#: Documents as JSON objects: fields that some lack, of more than one type, and text that is no object.
RECORDS = """SELECT CASE WHEN doc_id % 11 = 10 THEN '[1]' ELSE '{{"id":' || CAST(doc_id AS STRING) || ',"lang":' || CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE '"' || lang || '"' END || CASE WHEN doc_id % 3 = 0 THEN ',"parts":[' || CAST(n_chars AS STRING) || ']' ELSE '' END
  || ',"size":' || CASE WHEN n_chars > 2000 THEN '"' || CAST(n_chars AS STRING) || '"' ELSE CAST(n_chars AS STRING) END || CASE WHEN doc_id % 5 = 0 THEN ',"good":true,"more":{{}}' ELSE '' END || '}}' END AS j FROM {documents}"""


def _record_schemas(spark, sf_dir):
    rows = spark.sql(RECORDS, documents=table(spark, sf_dir, "documents"))
    return P.record_schema(rows, "j", ["id", "lang", "parts", "gone"])


def _element(df):
    return L.element(df.select("id", "repo_url", "lang"), 3)


def _limited(df):
    """The first fifty that are still to do."""
    todo, _ = L.filled_only(df.select("id", "failure_log"), "failure_log")
    return G.first_rows(todo, ["id"], 50).select("id")


def _ordered(df):
    """The first twenty by number, which as texts would stand elsewhere."""
    return L.in_numeric_order(df.select(F.col("id").cast("string").alias("id"), "lang"), "id")


def _folders(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Name"), F.col("c_custkey").cast("string")).alias("name"))
    there = names.filter("c_custkey % 3 = 1").select(F.col("name").alias("folder")).unionByName(names.filter("c_custkey % 3 < 2").select(F.upper("name").alias("folder")))
    return G.known_folders(names, "name", there)


QUERIES = {
    "rejects_with_lines": on("responses", _rejects),
    "retry_manifest": on("responses", _manifest),
    "retry_best_effort": on("responses", _best_effort),
    "strict_requests": on("responses", _strict),
    "strict_pass_counts": on("responses", _strict_pass),
    "recovered_run": on("responses", _recovered),
    "single_scoring": _single,
    "prediction_records": _predictions,
    "chunked_run": on("responses", _chunked_run),
    "fill_policy": on("responses", _policy),
    "batch_errors": _errors,
    "reply_texts": _reply_texts,
    "deduped_percentiles": on("cases", _percentiles),
    "token_counts": on("cases", _tokens),
    "scaled_columns": on("cases", _scaled),
    "split_measures": on("cases", _split),
    "orphan_docs": on("cases", _orphans),
    "rounds_text": on("cases", _rounds_text),
    "map_values": on("cases", _map_values),
    "trigger_sections": _sections,
    "diff_lines": _diff,
    "schema_checks": on("cases", _schema),
    "record_schemas": _record_schemas,
    "element_by_key": on("cases", _element),
    "limit_of_open": on("cases", _limited),
    "numeric_order": on("cases", _ordered),
    "known_folders": _folders,
}
BAD = "NOT good"
SUFFIX = "'" + V.STRICT_SUFFIX.replace("'", "''") + "'"
SQL = {
    "rejects_with_lines": sql("responses", f"WITH {RECOVERED}, n AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY sample_id) AS line FROM v) SELECT line, sample_id, 'not a JSON object' AS error, md5(raw) AS raw_md5 FROM n WHERE {BAD}"),
    "retry_manifest": sql("responses", f"WITH {RECOVERED} SELECT sample_id FROM v WHERE {BAD}"),
    "retry_best_effort": sql("responses", f"WITH {RECOVERED} SELECT sample_id, CASE id % 3 WHEN 0 THEN 'Flaky' WHEN 1 THEN 'Non-Flaky' END AS classification, CASE id % 3 WHEN 0 THEN false WHEN 1 THEN true END AS recovered FROM v WHERE {BAD}"),
    "strict_requests": sql("responses", f"WITH {RECOVERED} SELECT sample_id, length(prompt_type || {SUFFIX}) AS chars, md5(prompt_type || {SUFFIX}) AS md5 FROM v WHERE {BAD}"),
    "strict_pass_counts": sql("responses", f"WITH {RECOVERED} SELECT count(*) FILTER ({BAD}) AS before, count(*) FILTER ({BAD} AND id % 7 >= 2) AS after, count(*) FILTER (good OR id % 7 < 2) AS rows FROM v"),
    "recovered_run": sql("responses", f"""WITH {RECOVERED} SELECT sample_id, CASE WHEN good THEN 'reply' WHEN id % 3 < 2 THEN 'retry' WHEN id % 7 < 2 THEN 'strict' ELSE 'filled' END AS via,
  CASE WHEN good THEN t ->> '$.classification' WHEN id % 3 = 0 OR id % 3 = 2 AND id % 7 < 2 THEN 'Flaky' ELSE 'Non-Flaky' END AS classification, CASE WHEN good THEN t ->> '$.category' WHEN id % 3 = 0 OR id % 3 = 2 AND id % 7 < 2 THEN 'Time Dependent' ELSE 'Non-Flaky' END AS category FROM v"""),
    "single_scoring": sql("responses", """WITH x AS (SELECT *, CASE WHEN id % 5 = 0 THEN 'not a JSON object' WHEN prompt_type LIKE '%cot%' THEN 'no answer to ' || prompt_type END AS why FROM responses)
SELECT sample_id, CASE WHEN why IS NULL THEN 'Flaky' ELSE 'ERROR' END AS classification, CASE WHEN why IS NULL THEN 'Order Dependent' ELSE 'ERROR' END AS category, coalesce(why, 'r') AS reasoning, CASE WHEN why IS NULL THEN 'e' ELSE '' END AS evidence FROM x"""),
    "prediction_records": sql("responses", f"""WITH {RECOVERED} SELECT v.id, k.test_id, CASE WHEN k.is_flaky THEN 'Flaky' ELSE 'Non-Flaky' END AS ground_truth_classification, k.issue_category AS ground_truth_category, t ->> '$.classification' AS predicted_classification,
  t ->> '$.category' AS predicted_category, t ->> '$.reasoning' AS reasoning, array_to_string(t ->> '$.evidence[*]', ',') AS evidence, model, prompt_type, context_enabled, CAST(NULL AS DOUBLE) AS latency_ms, CASE WHEN context_enabled THEN 'with_context' ELSE 'without_context' END AS folder
  FROM v JOIN cases k ON k.id = v.id WHERE good"""),
    "chunked_run": sql("responses", f"SELECT CASE id % 3 WHEN 0 THEN '{GOOD}' WHEN 1 THEN '{BROKEN}' ELSE 'nothing' END AS raw, count(*) AS n FROM responses GROUP BY 1"),
    "fill_policy": sql("responses", f"WITH {RECOVERED} SELECT 'm1' AS experiment, count(*) AS filled, 'Non-Flaky' AS classification, 'Non-Flaky' AS category, min(sample_id) AS first, max(sample_id) AS last FROM v WHERE {BAD}"),
    "batch_errors": "SELECT c_custkey, 'code' || c_custkey % 3 || ': ' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ' (' || c_mktsegment || ')' ELSE '' END AS said FROM customer",
    "reply_texts": "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS said FROM customer",
    "deduped_percentiles": with_views("WITH f AS (SELECT lang, length(test_code) AS v FROM cases QUALIFY row_number() OVER (PARTITION BY id % 50, lang ORDER BY length(test_code) DESC, id) = 1) SELECT lang, count(*) AS n, round(quantile_cont(v, 0.95), 4) AS p95, round(quantile_cont(v, 0.99), 4) AS p99 FROM f GROUP BY lang", "cases"),
    "token_counts": with_views("SELECT id, len(list_filter(string_split(test_code, ' '), lambda w: w <> '')) AS tokens FROM cases", "cases"),
    "scaled_columns": with_views("SELECT lang, round(round(avg(CAST(is_flaky AS INT)), 6) * 100, 3) AS baseline, round(round(avg(id % 2), 6) * 100, 3) AS delta, count(*) AS n FROM cases GROUP BY lang", "cases"),
    "split_measures": with_views("SELECT lang, 'Baseline' AS setting, 'F1' AS measure, count(*) AS v FROM cases GROUP BY lang UNION ALL SELECT lang, 'Context', 'Macro F1', max(id) FROM cases GROUP BY lang", "cases"),
    "orphan_docs": with_views(r"""WITH l AS (SELECT id, test_code, string_split(test_code, chr(10)) AS ls FROM cases), o AS (SELECT *, list_transform(ls, lambda l: trim(l) = '' OR trim(l) LIKE '*%' OR l LIKE '%<sup>%' OR l LIKE '%<p>%') AS bad FROM l),
  f AS (SELECT *, coalesce(list_position(bad, false), len(ls) + 1) AS first FROM o)
SELECT id, md5(array_to_string(ls[first:], chr(10))) AS md5, md5(chr(10) || chr(10) || '*c' || chr(10) || chr(10) || array_to_string(list_transform(ls, lambda l: CASE WHEN regexp_matches(l, '^ *(\* |\*/|/\*\*)') THEN '' ELSE l END), chr(10))) AS masked FROM f""", "cases"),
    "rounds_text": with_views(r"SELECT id, md5(CASE WHEN failure_log LIKE 'Failed Rounds:%' THEN substr(failure_log, instr(failure_log, chr(10)) + 1) ELSE failure_log END) AS bare, md5(array_to_string(list_transform(string_split(failure_log, chr(10)), lambda l: chr(9) || 'at ' || l), chr(10))) AS frames FROM cases", "cases"),
    "map_values": with_views(f"SELECT id, md5({JAVA_STRIP.format(c='java_code')} || '|x') AS md5, id % 2 <> 0 AS empty, true AS none FROM cases", "cases"),
    "trigger_sections": "SELECT c_custkey, i, CASE i WHEN 0 THEN 'a.B' ELSE 'a.C' END AS class, CASE i WHEN 0 THEN 'one' ELSE 'two' END AS method, CASE i WHEN 0 THEN 'log ' || c_name ELSE '' END AS log FROM customer, (SELECT unnest([0, 1]) AS i)",
    "diff_lines": "SELECT c_custkey, 'one ' || c_name || chr(10) || 'two' AS removed, 'one ' || c_name || chr(10) || 'kept' || chr(10) || 'two' AS context FROM customer",
    "record_schemas": f"""WITH r AS ({RECORDS.format(documents="documents")}), k AS (SELECT j, unnest(json_keys(j)) AS field FROM r WHERE json_type(j) = 'OBJECT'),
  t AS (SELECT field, CASE json_type(j, '$.' || field) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS what FROM k),
  c AS (SELECT field, what, count(*) AS n FROM t GROUP BY ALL), e AS (SELECT unnest(['id', 'lang', 'parts', 'gone']) AS field),
  m AS (SELECT field, 'missing' AS what, (SELECT count(*) FROM r) - coalesce((SELECT CAST(sum(n) AS BIGINT) FROM c WHERE c.field = e.field), 0) AS n FROM e)
SELECT *, CASE WHEN field IN (SELECT field FROM e) THEN 'expected' ELSE 'extra' END AS state FROM (SELECT * FROM c UNION ALL SELECT * FROM m WHERE n > 0)""",
    "schema_checks": """SELECT * FROM (VALUES ('other', 'missing'), ('is_flaky', 'extra'), ('issue_category', 'extra'), ('repo_url', 'extra'), ('lang', 'extra'), ('test_code', 'extra'), ('java_code', 'extra'), ('failure_log', 'extra'),
  ('id', 'bigint'), ('test_id', 'string'), ('is_flaky', 'boolean'), ('issue_category', 'string'), ('repo_url', 'string'), ('lang', 'string'), ('test_code', 'string'), ('java_code', 'string'), ('failure_log', 'string')) AS t("column", what)""",
    "element_by_key": with_views("SELECT id, repo_url, lang FROM cases WHERE id = 3", "cases"),
    "limit_of_open": with_views("SELECT id FROM cases WHERE trim(failure_log) = '' ORDER BY id LIMIT 50", "cases"),
    "numeric_order": with_views("SELECT CAST(id AS VARCHAR) AS id, lang FROM cases", "cases"),
    "known_folders": "SELECT c_custkey, 'Name' || c_custkey AS name, CASE c_custkey % 3 WHEN 1 THEN 'Name' ELSE 'NAME' END || c_custkey AS folder FROM customer WHERE c_custkey % 3 < 2",
}
