"""Queries over evidence, replies, prompts and traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from lintel.functions import structures as S
from lintel.functions import text as T
from lintel.operators import evidence as E
from lintel.operators import filling
from lintel.operators import prompts as P
from lintel.operators import responses as R
from lintel.operators import traces as X
from lintel.operators.metrics import CONFIG
from lintel.plans.adapters import view, with_views
from lintel.storage import table, written


def on(name, change):
    return lambda spark, sf_dir: change(view(spark, sf_dir, name))


CONTEXTS = [("zero_shot", False), ("zero_shot", True), ("few_shot_cot", True)]
WINDOWS = [("a", 700), ("b", 1500), ("c", 131072)]
TEMPLATES = {"system": "You label tests.", "task": "Say whether the test is flaky.", "categories": "Categories: four.", "output": "Answer in JSON."}
STRATEGIES = {"zero_shot": "Decide at once.", "few_shot_cot": "Follow the examples."}
EXAMPLES = {True: "Example with context.", False: "Example of code."}


def _correct():
    return F.col("actual_category") == F.col("predicted_category")


def _right(df):
    return df.filter(_correct() & F.col("context_enabled"))


def _prompts(df):
    """Prompts whose helpers are the lines of the text."""
    lines = F.split("test_code", "\n")
    helpers = F.transform(lines, lambda l, i: F.struct(F.concat(F.lit("h"), i.cast("string")).alias("name"), l.alias("body")))
    classes = F.when(F.col("id") % 3 == 0, F.array(F.struct(F.col("repo_url").alias("name"), F.array(F.struct(F.col("lang").alias("name"), F.col("test_code").alias("body"))).alias("methods"))))
    rows = P.with_configs(df, CONTEXTS, ["strategy", "context"])
    body = P.input_section(F.col("test_code"), helpers, F.col("failure_log"), classes, F.col("context"))
    return rows.select("id", "strategy", "context", P.render(TEMPLATES, STRATEGIES, EXAMPLES, F.col("strategy"), F.col("context"), body).alias("prompt"))


def _prompt_render(df):
    return _prompts(df).select("id", "strategy", "context", F.length("prompt").cast("long").alias("chars"), F.md5("prompt").alias("md5"))


def _window_fit(df):
    rows = P.with_configs(_prompts(df), WINDOWS, ["name", "size"])
    return P.window_fit(rows, S.approximate_tokens(F.col("prompt")), "size", ["name", "strategy", "context"])


def _chunks(budget, most, size):
    def run(df):
        # Texts are measured where they are read; only their sizes are dealt out.
        sizes = df.select("id", "lang", size(F.col("test_code")).alias("size"), F.octet_length("test_code").alias("bytes"))
        rows = filling.chunked(sizes, "lang", "id", F.col("size"), budget, most)
        return rows.groupBy("lang", "chunk").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.sum("bytes").alias("bytes"))

    return run


def _parsed(df):
    good = R.parse(df).filter("error is null")
    return good.select("sample_id", "output.classification", "output.category", "output.reasoning", F.array_join("output.evidence", ";").alias("evidence"))


def _rejects(df):
    return R.parse(df).filter("error is not null").select("sample_id", "error", F.md5("raw").alias("raw_md5"))


def _recovery(df):
    bad = R.recover(df).filter("recovered or error is not null")
    return bad.select("sample_id", "recovered", "error", "output.classification", "output.category", F.md5("output.reasoning").alias("reasoning_md5"))


def _retry(df):
    parsed = R.parse(df)
    failed = parsed.filter("error is not null").select("sample_id")
    return R.retry_set(df.select("sample_id", F.md5("raw").alias("request")), failed)


def _merged(df):
    # Read by several checks: written once.
    out = written(R.recover(df).select("sample_id", "recovered", "error", "output"), "recovered").filter("error is null").withColumn("predicted", F.col("output.classification"))
    base, fresh = out.filter(~F.col("recovered")).select("sample_id", "predicted"), out.filter("recovered").select("sample_id", "predicted")
    return R.merge_recovered(base, fresh, df.select("sample_id"), complete=False)


def _filled(df):
    return R.fill_missing(_merged(df), df.select("sample_id"))


def _outcome(df):
    out = R.recover(df)
    t = out.groupBy(*CONFIG).agg(F.count("*").alias("expected"), F.count_if(F.col("error").isNull() & ~F.col("recovered")).alias("base"), F.count_if(F.col("recovered")).alias("recovered"), F.count_if(F.col("error").isNotNull()).alias("unresolved"))
    return t.withColumn("status", F.when(F.col("unresolved") == 0, "complete").when(F.col("recovered") > 0, "partial").otherwise("base only"))


def _requests(df):
    out = R.request_lines(df.select("id", "lang"), "id", "lang", "m1", 2048)
    return out.select("id", "line")


def _modes(df):
    return X.failure_modes(X.failing(df), "test", "trace", "round")


def _mode_rows(df):
    return _modes(df).select("test", F.md5("key").alias("key"), "n", "first", F.md5("trace").alias("trace"))


def _top_mode(df):
    top = X.top_modes(_modes(df), "test")
    return top.select("test", "n", F.md5(T.rounds_header(F.col("n"), F.lit(10), F.col("trace"))).alias("log"))


def _stack_frames(df):
    return X.frame_targets(df, "failure_log", "id")


def _trace_keys(df):
    return df.select("id", F.md5(T.trace_key(F.col("failure_log"))).alias("key"))


def _labels(df):
    return df.select(F.explode("evidence").alias("label")).groupBy("label").agg(F.count("*").alias("n")).withColumn("artefact", T.evidence_label(F.col("label")))


LABELS = [" Test code: x", "the @Test body", "an Assertion", "TestCase setUp", "Thread.sleep(5)", "failure log line", "Stack trace", "NullPointerException", "error message", "a HELPER", "Production code", "Class: Foo", "Method: bar", "a.b.c (1)", "a.b", "misc"]


def _label_rules(spark, sf_dir):
    """Every rule, and labels that two rules would take."""
    mixed = [f"{a} {b}" for a in LABELS for b in LABELS[::3]]
    label = F.element_at(F.array(*map(F.lit, LABELS + mixed)), (F.col("c_custkey") % (len(LABELS) + len(mixed)) + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", label.alias("label")).withColumn("artefact", T.evidence_label(F.col("label")))


def _ancestors(spark, sf_dir):
    """customer k extends customer k / 2: every chain ends at 1."""
    edges = table(spark, sf_dir, "customer").filter("c_custkey > 1").select(F.col("c_custkey").alias("child"), F.floor(F.col("c_custkey") / 2).alias("parent"))
    return X.ancestors(edges).select("child", "ancestor", F.col("level").cast("long").alias("level"))


def _resolution(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select(F.col("p_partkey").alias("file"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise("").alias("package"), F.col("p_type").alias("name"))
    imports = part.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("file"), F.concat(F.lit("org.x."), "p_type").alias("import"))
    files = part.filter("p_partkey % 5 = 0").select(F.concat_ws(".", "p_brand", "p_type").alias("fqn"))
    return X.resolved_names(names, imports, files)


def _filled_groups(spark, sf_dir):
    """Groups, one of them null, in which keys repeat and some keys and sizes are null."""
    df = table(spark, sf_dir, "lineitem")
    rows = df.select(F.when(F.col("l_orderkey") % 300 < 299, F.col("l_orderkey") % 300).alias("g"), F.when(F.col("l_partkey") % 11 > 0, F.col("l_partkey") % 50).alias("k"), F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("v"))
    out = filling.chunked(rows, "g", "k", F.col("v"), 120, 9)
    return out.groupBy("g", "chunk").agg(F.count("*").alias("n"), F.sum(F.coalesce("v", F.lit(0))).cast("double").alias("size"), F.min("k").alias("first_key"), F.max("k").alias("last_key"))


FILLED_SQL = """WITH RECURSIVE r AS (SELECT CASE WHEN l_orderkey % 300 < 299 THEN l_orderkey % 300 END AS g, CASE WHEN l_partkey % 11 > 0 THEN l_partkey % 50 END AS k, CASE WHEN l_linenumber < 7 THEN CAST(l_quantity AS DOUBLE) ELSE 0 END AS v FROM lineitem),
  s AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k NULLS FIRST, v) AS i FROM r),
  f AS (SELECT g, k, i, v, 1 AS chunk, v AS total, 1 AS rows FROM s WHERE i = 1
    UNION ALL SELECT s.g, s.k, s.i, s.v, CASE WHEN total + s.v > 120 OR rows + 1 > 9 THEN chunk + 1 ELSE chunk END, CASE WHEN total + s.v > 120 OR rows + 1 > 9 THEN s.v ELSE total + s.v END,
      CASE WHEN total + s.v > 120 OR rows + 1 > 9 THEN 1 ELSE rows + 1 END FROM f JOIN s ON s.g IS NOT DISTINCT FROM f.g AND s.i = f.i + 1)
SELECT g, chunk, count(*) AS n, sum(v) AS size, min(k) AS first_key, max(k) AS last_key FROM f GROUP BY g, chunk"""

PROMPT_SQL = """p AS (SELECT id, strategy, context, concat_ws(chr(10) || chr(10), 'You label tests.', 'Say whether the test is flaky.', 'Categories: four.',
  CASE strategy WHEN 'zero_shot' THEN 'Decide at once.' ELSE 'Follow the examples.' END, CASE WHEN strategy = 'few_shot_cot' THEN CASE WHEN context THEN 'Example with context.' ELSE 'Example of code.' END END,
  '## Input', CASE WHEN test_code <> '' THEN '### 1. Test Code' || chr(10) || chr(10) || trim(test_code, ws) END,
  CASE WHEN context THEN '### 2. Helper Methods' || chr(10) || chr(10) || array_to_string(list_transform(string_split(test_code, chr(10)), lambda l, i: 'Method: h' || (i - 1) || chr(10) || chr(10) || trim(l, ws) || chr(10) || chr(10) || repeat('-', 40)), chr(10) || chr(10)) END,
  CASE WHEN context AND failure_log <> '' THEN '### 3. Failure Log' || chr(10) || chr(10) || trim(failure_log, ws) END,
  CASE WHEN context AND id % 3 = 0 THEN '### 4. Production Code' || chr(10) || chr(10) || 'Class: ' || repo_url || chr(10) || chr(10) || 'Method: ' || lang || chr(10) || chr(10) || trim(test_code, ws) || chr(10) || chr(10) || repeat('-', 40) END,
  'Answer in JSON.') AS prompt FROM (SELECT *, ' ' || chr(9) || chr(10) || chr(13) AS ws FROM cases), (VALUES ('zero_shot', false), ('zero_shot', true), ('few_shot_cot', true)) AS c(strategy, context))"""


def _chunk_sql(size: str, budget: float, most: int | None) -> str:
    limit = f" OR rows + 1 > {most}" if most else ""
    return f"""WITH RECURSIVE s AS (SELECT lang, id, {size} AS v, strlen(test_code) AS bytes, row_number() OVER (PARTITION BY lang ORDER BY id) AS i FROM cases),
  f AS (SELECT lang, id, i, v, bytes, 1 AS chunk, v AS total, 1 AS rows FROM s WHERE i = 1
    UNION ALL SELECT s.lang, s.id, s.i, s.v, s.bytes, CASE WHEN total + s.v > {budget}{limit} THEN chunk + 1 ELSE chunk END, CASE WHEN total + s.v > {budget}{limit} THEN s.v ELSE total + s.v END,
      CASE WHEN total + s.v > {budget}{limit} THEN 1 ELSE rows + 1 END FROM f JOIN s ON s.lang = f.lang AND s.i = f.i + 1)
SELECT lang, chunk, count(*) AS n, min(id) AS first_id, max(id) AS last_id, sum(bytes)::BIGINT AS bytes FROM f GROUP BY lang, chunk"""


LABEL = """CASE WHEN trim(lower(label)) LIKE 'test code%' OR regexp_matches(lower(label), '@test|assert|testcase|thread[.]sleep') THEN 'Test Code' WHEN trim(lower(label)) LIKE 'failure log%' OR regexp_matches(lower(label), 'stack trace|exception|error message') THEN 'Failure Log'
  WHEN lower(label) LIKE '%helper%' THEN 'Helper Methods' WHEN trim(lower(label)) LIKE 'production code%' OR regexp_matches(lower(label), 'class:|method:|\\w+(\\.\\w+)+\\s*\\(') THEN 'Production Code' ELSE 'Other' END"""
TEXT = "CASE WHEN raw LIKE '```%' THEN trim(replace(replace(raw, '```json', ''), '```', ''), ' ' || chr(10)) ELSE raw END"
OK = "(json_valid(t) AND coalesce(CASE WHEN json_valid(t) THEN json_type(t) END, '') = 'OBJECT')"
RECOVERED = f"""r AS (SELECT *, {TEXT} AS t FROM responses), q AS (SELECT *, {OK} AS good, nullif(regexp_extract(raw, '"classification"\\s*:\\s*"([^"]*)"', 1), '') AS said, nullif(regexp_extract(raw, '"category"\\s*:\\s*"([^"]*)"', 1), '') AS cat FROM r),
  v AS (SELECT *, CASE WHEN good THEN NULL WHEN coalesce(said, '') NOT IN ('Flaky', 'Non-Flaky') THEN 'invalid classification' WHEN coalesce(cat, '') NOT IN ('Implementation Dependent', 'Order Dependent', 'Non-Idempotent', 'Time Dependent', 'Non-Flaky') THEN 'invalid category'
    WHEN said = 'Non-Flaky' AND cat <> 'Non-Flaky' THEN 'category of a Non-Flaky reply' WHEN said = 'Flaky' AND cat = 'Non-Flaky' THEN 'category of a Flaky reply' END AS error FROM q)"""
KEY = "array_to_string(coalesce(nullif(list_filter(ls, lambda l: l LIKE 'at %' OR l LIKE 'Caused by:%' OR l LIKE '...%'), []), ls), chr(10))"
LINES = "list_filter(list_transform(string_split(replace({c}, chr(13), ''), chr(10)), lambda l: trim(l)), lambda l: l <> '')"
MODES = f"""e AS (SELECT *, {LINES.format(c='trace')} AS ls FROM rounds WHERE lower(trim(status)) IN ('failure', 'error')), m AS (SELECT test, {KEY} AS key, count(*) AS n, min(round) AS first, min_by(trace, round) AS trace FROM e GROUP BY ALL)"""


def sql(name: str, text: str) -> str:
    return with_views(text, name)


QUERIES = {
    "evidence_frequency": on("predictions", lambda df: E.frequency(_right(df))),
    "evidence_by_model": on("predictions", lambda df: E.frequency(_right(df), "model")),
    "evidence_outcome": on("predictions", lambda df: E.by_outcome(df.filter("context_enabled"), _correct())),
    "evidence_combinations": on("predictions", lambda df: E.combinations(_right(df))),
    "evidence_utilisation": on("predictions", lambda df: E.utilisation(_right(df))),
    "evidence_utilisation_by_model": on("predictions", lambda df: E.utilisation(_right(df), "model")),
    "evidence_labels": on("predictions", _labels),
    "evidence_label_rules": _label_rules,
    "evidence_unmatched": on("predictions", lambda df: E.unmatched(_right(df))),
    "reasoning_themes": on("predictions", lambda df: E.themes(df.filter(~_correct() & F.col("context_enabled")))),
    "prompt_render": on("cases", _prompt_render),
    "prompt_stats": on("cases", lambda df: P.stats(_prompts(df), "prompt", ["strategy", "context"])),
    "window_fit": on("cases", _window_fit),
    "token_chunks": on("cases", _chunks(20000, None, S.approximate_tokens)),
    "byte_chunks": on("cases", _chunks(100000, 30, S.line_bytes)),
    "filled_groups": _filled_groups,
    "request_lines": on("cases", _requests),
    "parse_responses": on("responses", _parsed),
    "rejects": on("responses", _rejects),
    "field_recovery": on("responses", _recovery),
    "retry_set": on("responses", _retry),
    "recovered_merge": on("responses", _merged),
    "heuristic_fill": on("responses", _filled),
    "recovery_outcome": on("responses", _outcome),
    "trace_modes": on("rounds", _mode_rows),
    "top_failure_mode": on("rounds", _top_mode),
    "trace_keys": on("cases", _trace_keys),
    "stack_frames": on("cases", _stack_frames),
    "class_ancestors": _ancestors,
    "import_resolution": _resolution,
}
RIGHT = "r AS (SELECT * FROM predictions WHERE context_enabled AND actual_category = predicted_category), x AS (SELECT *, " + LABEL + " AS artefact FROM (SELECT model, unnest(evidence) AS label FROM r))"
SETS = "r AS (SELECT row_number() OVER () AS k, * FROM predictions WHERE context_enabled AND actual_category = predicted_category), x AS (SELECT DISTINCT k, model, " + LABEL + " AS artefact FROM (SELECT k, model, unnest(evidence) AS label FROM r))"
SQL = {
    "evidence_frequency": sql("predictions", f"WITH {RIGHT} SELECT artefact, count(*) AS n FROM x GROUP BY 1"),
    "evidence_by_model": sql("predictions", f"WITH {RIGHT} SELECT model, artefact, count(*) AS n FROM x GROUP BY ALL"),
    "evidence_outcome": sql("predictions", f"WITH x AS (SELECT ok, {LABEL} AS artefact FROM (SELECT actual_category = predicted_category AS ok, unnest(evidence) AS label FROM predictions WHERE context_enabled)) SELECT artefact, count(*) AS n, count(*) FILTER (ok) AS correct, count(*) FILTER (NOT ok) AS incorrect, round(count(*) FILTER (ok) * 100.0 / count(*), 4) AS rate FROM x GROUP BY 1"),
    "evidence_combinations": sql("predictions", f"WITH {SETS}, s AS (SELECT k, string_agg(artefact, ' + ' ORDER BY artefact) AS combination FROM x WHERE artefact <> 'Other' GROUP BY k) SELECT combination, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share FROM s GROUP BY 1"),
    "evidence_utilisation": sql("predictions", f"WITH {SETS} SELECT artefact, count(*) AS n, (SELECT count(*) FROM r) AS rows, round(count(*) * 100.0 / (SELECT count(*) FROM r), 4) AS percent FROM x WHERE artefact <> 'Other' GROUP BY 1"),
    "evidence_utilisation_by_model": sql("predictions", f"WITH {SETS}, t AS (SELECT model, count(*) AS rows FROM r GROUP BY 1), u AS (SELECT model, artefact, count(*) AS n FROM x WHERE artefact <> 'Other' GROUP BY ALL) SELECT model, artefact, n, rows, round(n * 100.0 / rows, 4) AS percent FROM u JOIN t USING (model)"),
    "evidence_labels": sql("predictions", f"SELECT label, count(*) AS n, {LABEL} AS artefact FROM (SELECT unnest(evidence) AS label FROM predictions) GROUP BY label"),
    "evidence_label_rules": "WITH l AS (SELECT c_custkey, ([" + ", ".join(f"'{x}'" for x in LABELS + [f"{a} {b}" for a in LABELS for b in LABELS[::3]]) + f"])[c_custkey % {len(LABELS) + len(LABELS) * len(LABELS[::3])} + 1] AS label FROM customer) SELECT c_custkey, label, {LABEL} AS artefact FROM l",
    "evidence_unmatched": sql("predictions", f"WITH {RIGHT} SELECT DISTINCT label FROM x WHERE artefact = 'Other' ORDER BY label LIMIT 50"),
    "reasoning_themes": sql("predictions", "WITH w AS (SELECT lower(coalesce(reasoning, '')) AS t FROM predictions WHERE context_enabled AND actual_category <> predicted_category) " + " UNION ALL ".join(f"SELECT '{n}' AS theme, count(*) FILTER (regexp_matches(t, '{'|'.join(p)}')) AS n, round(count(*) FILTER (regexp_matches(t, '{'|'.join(p)}')) * 100.0 / count(*), 4) AS percent FROM w" for n, p in T.THEMES.items())),
    "prompt_render": sql("cases", f"WITH {PROMPT_SQL} SELECT id, strategy, context, length(prompt) AS chars, md5(prompt) AS md5 FROM p"),
    "prompt_stats": sql("cases", f"""WITH {PROMPT_SQL} SELECT strategy, context, count(*) AS n, min(length(prompt)) AS min_chars, max(length(prompt)) AS max_chars, round(avg(length(prompt)), 4) AS mean_chars, round(quantile_cont(length(prompt), 0.5), 4) AS median_chars,
  round(stddev_samp(length(prompt)), 4) AS std_chars, round(quantile_cont(length(prompt) / 4, 0.95), 4) AS p95_tokens, round(quantile_cont(length(prompt) / 4, 0.99), 4) AS p99_tokens, round(sum(length(prompt) / 4), 4) AS tokens FROM p GROUP BY ALL"""),
    "window_fit": sql("cases", f"""WITH {PROMPT_SQL} SELECT name, strategy, context, count(*) AS n, count(*) FILTER (length(prompt) / 4 <= size) AS fits, round(max(length(prompt) / 4 / size) * 100, 4) AS max_utilisation, count(*) FILTER (length(prompt) / 4 > size) AS exceeds,
  round(count(*) FILTER (length(prompt) / 4 <= size) * 100.0 / count(*), 4) AS fit_percent FROM p, (VALUES ('a', 700), ('b', 1500), ('c', 131072)) AS w(name, size) GROUP BY ALL"""),
    "token_chunks": _chunk_sql("length(test_code) / 4", 20000, None),
    "byte_chunks": _chunk_sql("strlen(test_code) + 1", 100000, 30),
    "filled_groups": FILLED_SQL,
    "request_lines": sql("cases", """SELECT id, '{"custom_id":"sample_' || id || '","method":"POST","url":"/v1/responses","body":{"model":"m1","input":"' || lang || '","max_output_tokens":2048}}' AS line FROM cases"""),
    "parse_responses": sql("responses", f"""WITH r AS (SELECT *, {TEXT} AS t FROM responses) SELECT sample_id, t ->> '$.classification' AS classification, t ->> '$.category' AS category, t ->> '$.reasoning' AS reasoning, array_to_string(t ->> '$.evidence[*]', ';') AS evidence FROM r WHERE {OK}"""),
    "rejects": sql("responses", f"WITH r AS (SELECT *, {TEXT} AS t FROM responses) SELECT sample_id, 'not a JSON object' AS error, md5(raw) AS raw_md5 FROM r WHERE NOT {OK}"),
    "field_recovery": sql("responses", f"""WITH {RECOVERED} SELECT sample_id, error IS NULL AS recovered, error, CASE WHEN error IS NULL THEN said END AS classification, CASE WHEN error IS NULL THEN cat END AS category,
  CASE WHEN error IS NULL THEN md5(CASE WHEN regexp_matches(raw, '(?s)"reasoning"\\s*:\\s*"(.*?)"\\s*,\\s*"evidence"\\s*:') THEN regexp_extract(raw, '(?s)"reasoning"\\s*:\\s*"(.*?)"\\s*,\\s*"evidence"\\s*:', 1) ELSE raw END) END AS reasoning_md5 FROM v WHERE NOT good"""),
    "retry_set": sql("responses", f"WITH r AS (SELECT *, {TEXT} AS t FROM responses) SELECT sample_id, md5(raw) AS request FROM r WHERE NOT {OK}"),
    "recovered_merge": sql("responses", f"WITH {RECOVERED} SELECT sample_id, said AS predicted FROM v WHERE error IS NULL"),
    "heuristic_fill": sql("responses", f"WITH {RECOVERED} SELECT sample_id, CASE WHEN error IS NULL THEN said ELSE 'Non-Flaky' END AS predicted, error IS NOT NULL AS is_filled FROM v"),
    "recovery_outcome": sql("responses", f"""WITH {RECOVERED}, c AS (SELECT model, prompt_type, context_enabled, count(*) AS expected, count(*) FILTER (good) AS base, count(*) FILTER (NOT good AND error IS NULL) AS recovered, count(*) FILTER (error IS NOT NULL) AS unresolved FROM v GROUP BY ALL)
SELECT *, CASE WHEN unresolved = 0 THEN 'complete' WHEN recovered > 0 THEN 'partial' ELSE 'base only' END AS status FROM c"""),
    "trace_modes": sql("rounds", f"WITH {MODES} SELECT test, md5(key) AS key, n, first, md5(trace) AS trace FROM m"),
    "top_failure_mode": sql("rounds", f"WITH {MODES} SELECT test, n, md5('Failed Rounds: ' || n || '/10' || chr(10) || trace) AS log FROM m QUALIFY row_number() OVER (PARTITION BY test ORDER BY n DESC, first, key) = 1"),
    "trace_keys": sql("cases", f"SELECT id, md5({KEY}) AS key FROM (SELECT id, {LINES.format(c='failure_log')} AS ls FROM cases)"),
    "stack_frames": sql("cases", r"""WITH x AS (SELECT DISTINCT id, unnest(regexp_extract_all(failure_log, 'at\s+[\w.$]+\.[\w$<>]+\([\w.]+[.]java:[0-9]+\)')) AS f FROM cases), y AS (SELECT id, regexp_extract(f, 'at\s+([\w.$]+)\.[\w$<>]+\(', 1) AS class, regexp_extract(f, '\.([\w$<>]+)\(', 1) AS method FROM x)
SELECT DISTINCT * FROM y WHERE method NOT IN ('<init>', '<clinit>') AND NOT regexp_matches(lower(class), '^(java|javax|sun)\.') AND NOT regexp_matches(class, '^(org\.(junit|mockito|hamcrest|easymock|jacoco|testng|assertj)|junit\.framework|com\.google\.common\.truth)\.')"""),
    "class_ancestors": """WITH RECURSIVE a AS (SELECT c_custkey AS child, c_custkey // 2 AS ancestor, 1 AS level FROM customer WHERE c_custkey > 1
  UNION ALL SELECT child, ancestor // 2, level + 1 FROM a WHERE ancestor > 1) SELECT child, ancestor, CAST(level AS BIGINT) AS level FROM a""",
    "import_resolution": """WITH f AS (SELECT DISTINCT p_brand || '.' || p_type AS fqn FROM part WHERE p_partkey % 5 = 0), n AS (SELECT p_partkey AS file, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS package, p_type AS name FROM part)
SELECT file, package, name, CASE WHEN file % 3 = 0 THEN 'org.x.' || name WHEN package <> '' AND package || '.' || name IN (SELECT fqn FROM f) THEN package || '.' || name ELSE name END AS fqn FROM n""",
}
for _name in ("token_chunks", "byte_chunks"):
    _views = with_views("SELECT 1", "cases").removesuffix(" SELECT 1").removeprefix("WITH ")
    SQL[_name] = SQL[_name].replace("WITH RECURSIVE ", f"WITH RECURSIVE {_views}, ", 1)
