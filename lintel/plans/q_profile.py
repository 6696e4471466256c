"""Queries over cases: profiling, cleaning, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lintel.functions import java as J
from lintel.functions import structures as S
from lintel.functions import text as T
from lintel.operators import profile as P
from lintel.operators import select as L
from lintel.plans.adapters import view, with_views
from lintel.storage import table


def on_cases(change):
    return lambda spark, sf_dir: change(view(spark, sf_dir, "cases"))


def sql(text: str) -> str:
    return with_views(text, "cases")


def _maps(df):
    """helpers: map of line number to line of the text; code: map of source to (map of language to text)."""
    lines = F.split("test_code", "\n")
    entries = F.transform(lines, lambda l, i: F.struct(F.concat(F.lit("h"), i.cast("string")).alias("k"), l.alias("v")))
    inner = F.map_from_arrays(F.array("lang", F.lit("blank")), F.array(F.col("java_code"), F.lit(" ")))
    return df.select("id", "is_flaky", "failure_log", F.map_from_entries(entries).alias("helpers"), F.map_from_arrays(F.array("repo_url"), F.array(inner)).alias("code"))


def _map_sizes(df):
    return _maps(df).select("id", S.map_size(F.col("helpers")).cast("long").alias("helpers"), S.nested_count(F.col("code")).cast("long").alias("methods"), S.nested_chars(F.col("code")).cast("long").alias("chars"), S.nested_blank(F.col("code")).cast("long").alias("blank"))


def _clean_maps(df):
    m = _maps(df)
    cleaned = m.withColumn("clean", S.nested_mapped(F.col("code"), T.strip_comments))
    return cleaned.select("id", S.same_keys(F.col("code"), F.col("clean")).alias("same_keys"), S.nested_chars(F.col("clean")).cast("long").alias("chars"), F.md5(F.concat_ws("|", F.flatten(F.transform(F.map_values("clean"), lambda x: F.map_values(x))))).alias("md5"))


def _exploded_maps(df):
    return _maps(df).select("id", F.explode("code").alias("class", "methods")).select("id", "class", F.explode("methods").alias("method", "body")).select("id", "class", "method", F.length("body").cast("long").alias("chars"))


#: Parts of a class around a text: a call and a comment that name the method, the method before and after the text, and another method.
JAVA = ("class T { /* old t() { */ int a = t(';'); ", "@Test public void t() { char c = '}'; /* ", " */ if (a) { x(\"{\"); } // {\n}", " int u() { return 1; } }")


def _class_of_text(df):
    return df.select("id", F.concat(F.lit(JAVA[0]), F.lit(JAVA[1]), F.replace("test_code", F.lit("*/"), F.lit("")), F.lit(JAVA[2]), F.lit(JAVA[3])).alias("code"))


def _masked_code(df):
    out = _class_of_text(df).select("id", J.mask(F.col("code")).alias("masked"))
    return out.select("id", F.length("masked").cast("long").alias("chars"), F.md5("masked").alias("md5"))


def _methods(df):
    """In code as it is, the comment's t comes first and is no declaration; in masked code the method is found."""
    code, t = F.col("code"), F.lit("t")
    return _class_of_text(df).select("id", J.method(code, t).alias("raw"), F.md5(J.method(code, t, True)).alias("masked"), J.method(code, F.lit("u")).alias("other"))


def _sizes(df):
    return df.withColumn("test_length", F.length("test_code")).withColumn("failure_length", F.length("failure_log")).withColumn("lines", F.size(F.split("test_code", "\n")))


def _characterisation(df):
    return P.describe(_sizes(df), F.col("test_length"), ("lang",))


def _correlation(df):
    s = _sizes(df)
    return P.correlations(s, {"test_length": F.col("test_length"), "failure_length": F.col("failure_length"), "lines": F.col("lines")})


def _scored(df):
    lines = F.size(F.split("test_code", "\n"))
    return L.context_score(df.filter("is_flaky is not null"), F.when(lines > 3, '{"a": 1}').otherwise("{}"), F.when(F.col("id") % 5 == 0, " ").otherwise("[1]"), F.col("failure_log"))


def _balance(df):
    kept = L.balance(_scored(df).select("id", "is_flaky", "context_score"), "is_flaky", "context_score")
    return kept.withColumn("shuffled", L.hash_order("id", 42))


def _features(df):
    s = _sizes(df.filter("is_flaky is not null"))
    return s.select("id", "is_flaky", F.col("test_length").cast("double").alias("test_length"), F.col("failure_length").cast("double").alias("failure_length"), F.col("lines").cast("double").alias("lines"), ((F.col("test_length") > 0).cast("int") + (F.col("failure_length") > 0).cast("int")).cast("long").alias("artifact_completeness"))


def _representative(df):
    return L.representative(_features(df), ["test_length", "failure_length", "lines"], "is_flaky").select("id", "is_flaky", "artifact_completeness", "distance_from_median", F.col("rank").cast("long").alias("rank"))


def _remove_demos(df):
    demos = _representative(df).filter("rank <= 2")
    return L.without(df.filter("is_flaky is not null").select("id", "test_id"), demos)


def _cleaning(df):
    return P.reduction(df.withColumn("clean", T.strip_comments(F.col("java_code"))), "java_code", "clean")


def _first_change(df):
    c = df.withColumn("clean", T.normalise_log(F.col("failure_log"))).filter(~F.col("failure_log").eqNullSafe(F.col("clean")))
    return c.groupBy("repo_url").agg(F.min_by(F.struct("id", F.md5("failure_log").alias("before"), F.md5("clean").alias("after")), "id").alias("s")).select("repo_url", "s.*")


def _modified(df):
    return df.select("id", F.md5(T.strip_comments(F.col("java_code"))).alias("code_md5"), F.length(T.strip_comments(F.col("java_code"))).cast("long").alias("chars"))


def _logs(df):
    return df.select("id", T.normalise_log(F.col("failure_log")).alias("log"))


def _strings(df):
    return df.select("id", T.slug(F.concat(F.col("issue_category"), F.lit(" x-"))).alias("slug"), F.substring("test_code", 1, 1500).alias("shown"), S.line_bytes(F.col("test_code")).cast("long").alias("bytes"), S.approximate_tokens(F.col("test_code")).alias("tokens"), F.split("test_id", "-", 2)[0].alias("head"), T.bare_method(F.concat(F.lit("m[1]:"), F.col("lang"))).alias("method"))


def _recode(df):
    """Codes from a map with a default, blank values named, two features lifted to percent if they are shares."""
    codes = F.create_map(*(F.lit(x) for pair in {"Time Dependent": "td", "Order Dependent": "od", "Non-Idempotent": "nio", "Implementation Dependent": "id"}.items() for x in pair))
    share = F.when(F.col("id") % 2 == 0, 0.25).otherwise(0.75)
    pct = F.when(F.col("_top") <= 1, share * 100).otherwise(share)
    return df.join(F.broadcast(df.agg(F.max(share).alias("_top")))).select("id", F.coalesce(F.try_element_at(codes, F.col("issue_category")), F.lit("none")).alias("code"), F.when(F.trim("failure_log") == "", "Unknown").otherwise(F.substring("failure_log", 1, 6)).alias("log"), pct.alias("percent"), F.greatest(F.col("id") % 7, F.col("id") % 5).alias("larger"))


def _merge(spark, sf_dir):
    df = view(spark, sf_dir, "cases").filter("is_flaky is not null").select(F.col("id").alias("old_id"), "test_id", "is_flaky")
    return L.renumbered([df.filter("is_flaky"), df.filter(~F.col("is_flaky"))], "old_id", "id")


def _csv_form(df):
    m = _maps(df)
    return m.select("id", F.when(F.size("helpers") == 0, "").otherwise(F.to_json("helpers")).alias("helpers_text"), S.spaced_json_length(F.create_map(F.lit("a"), F.col("id").cast("string"), F.lit("b"), F.lit("x"))).cast("long").alias("json_length")).select("id", F.length("helpers_text").cast("long").alias("chars"), "json_length")


def _commit_lookup(spark, sf_dir):
    """By supplier name, else by its nation, else blank."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    first = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select("s_name", F.struct(F.concat(F.lit("repo-"), F.col("s_name")).alias("url"), F.lit("name").alias("by")).alias("a"))
    second = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("s_nationkey"), F.struct(F.concat(F.lit("repo-"), F.col("n_name")).alias("url"), F.lit("nation").alias("by")).alias("b"))
    blank = F.struct(F.lit("").alias("url"), F.lit("none").alias("by"))
    return suppliers.join(first, "s_name", "left").join(second, "s_nationkey", "left").select("s_suppkey", F.coalesce("a", "b", blank).alias("x")).select("s_suppkey", "x.*")


def _upsert(df):
    base = df.select("id", F.lit("old").alias("state"))
    fresh = df.filter("id % 4 = 0").select((F.col("id") * 2).alias("id"), F.lit("new").alias("state"))
    return L.upsert(base, fresh)


def _composite_keys(df):
    """Index within a repository and the key with the index left off where there is one case only."""
    rows = L.numbered(df.select("id", "repo_url", "lang"), ["repo_url", "lang"], ["id"], "position", "total")
    key = F.when(F.col("total") == 1, F.concat_ws("-", "repo_url", "lang")).otherwise(F.concat_ws("-", "repo_url", "lang", F.col("position").cast("string")))
    return rows.select("id", key.alias("key"), "position", "total")


def _align(df):
    a = df.filter("is_flaky").groupBy("lang").agg(F.count("*").alias("flaky"))
    b = df.filter(~F.col("is_flaky")).groupBy("lang").agg(F.count("*").alias("stable"))
    return a.join(b, "lang", "full_outer").na.fill(0, ["flaky", "stable"])


JAVA_STRIP = r"""trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(coalesce({c}, ''), '("(?:[^"\\]|\\(?:[\s\S]|\z))*(?:"|\z)|''(?:[^''\\]|\\(?:[\s\S]|\z))*(?:''|\z))|//[^\n]*|/\*[\s\S]*?(?:\*/|\z)', '\1', 'g'), chr(13) || chr(10), chr(10)), '\r', chr(10), 'g'), '(?m)[ \t\v\f]+$', '', 'g'), '\n\s*\n+', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10))"""
LOG = r"""trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace({c}, '(?m)^Failed Rounds:\s*\d+/\d+\s*\n?', '', 'g'), chr(13) || chr(10), chr(10)), '\r', chr(10), 'g'), '(?m)[ \t\v\f]+$', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10))"""
STATS = """count(v) AS count, min(v) AS min, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS median, round(avg(v), 4) AS mean,
  round(quantile_cont(v, 0.75), 4) AS q75, round(quantile_cont(v, 0.95), 4) AS q95, max(v) AS max, round(stddev_samp(v), 4) AS std"""
SCORED = """s AS (SELECT id, is_flaky, 2 * CAST(len(string_split(test_code, chr(10))) > 3 AS INT) + 2 * CAST(id % 5 <> 0 AS INT) + CAST(trim(failure_log) <> '' AS INT) AS context_score FROM cases WHERE is_flaky IS NOT NULL)"""
FEATURES = """f AS (SELECT id, is_flaky, length(test_code) AS a, length(failure_log) AS b, len(string_split(test_code, chr(10))) AS c FROM cases WHERE is_flaky IS NOT NULL),
  m AS (SELECT median(a) AS ma, median(b) AS mb, median(c) AS mc FROM f),
  r AS (SELECT id, is_flaky, CAST(CAST(a > 0 AS INT) + CAST(b > 0 AS INT) AS BIGINT) AS artifact_completeness, round(coalesce(abs(a - ma) / nullif(ma, 0), 0) + coalesce(abs(b - mb) / nullif(mb, 0), 0) + coalesce(abs(c - mc) / nullif(mc, 0), 0), 9) AS distance_from_median FROM f, m),
  k AS (SELECT *, row_number() OVER (PARTITION BY is_flaky ORDER BY distance_from_median, id) AS rank FROM r)"""

QUERIES = {
    "missing_values": on_cases(P.null_counts),
    "duplicate_ids": on_cases(lambda df: P.duplicate_count(df, "id")),
    "duplicate_texts": on_cases(lambda df: P.duplicate_count(df, "test_code", "is_flaky")),
    "row_and_distinct_counts": on_cases(lambda df: df.agg(F.count("*").alias("n"), F.count_distinct("repo_url").alias("repos"), F.count_distinct("issue_category").alias("categories"))),
    "class_distribution": on_cases(lambda df: P.value_counts(df, "is_flaky")),
    "category_distribution": on_cases(lambda df: P.value_counts(df, "issue_category")),
    "context_availability": on_cases(lambda df: P.availability(df, {"failure_log": ~S.is_empty_text(F.col("failure_log")), "test_code": ~S.is_empty_text(F.col("test_code")), "label": F.col("is_flaky").isNotNull()})),
    "artefact_characterisation": on_cases(_characterisation),
    "size_bins": on_cases(lambda df: P.size_bins(df, F.length("test_code") * 5)),
    "size_correlation": on_cases(_correlation),
    "log_patterns": on_cases(lambda df: P.pattern_counts(df, "failure_log")),
    "strip_comments": on_cases(_modified),
    "cleaning_effect": on_cases(_cleaning),
    "normalise_logs": on_cases(_logs),
    "first_changed_log": on_cases(_first_change),
    "map_sizes": on_cases(_map_sizes),
    "clean_maps": on_cases(_clean_maps),
    "explode_maps": on_cases(_exploded_maps),
    "map_csv_form": on_cases(_csv_form),
    "masked_code": on_cases(_masked_code),
    "extracted_methods": on_cases(_methods),
    "context_score": on_cases(lambda df: _scored(df).groupBy("is_flaky", "context_score").agg(F.count("*").alias("n"))),
    "balance": on_cases(_balance),
    "seeded_sample": on_cases(lambda df: L.sample(df.select("id", "test_id"), 50, 42)),
    "representative_rank": on_cases(_representative),
    "remove_demos": on_cases(_remove_demos),
    "string_functions": on_cases(_strings),
    "recode": on_cases(_recode),
    "merge_reid": _merge,
    "commit_lookup": _commit_lookup,
    "upsert": on_cases(_upsert),
    "composite_keys": on_cases(_composite_keys),
    "align_distributions": on_cases(_align),
    "helpers_per_class": on_cases(lambda df: P.describe(_sizes(df), F.when(F.col("lines") > 1, F.col("lines")), ("is_flaky",))),
    "top_sources": on_cases(lambda df: df.groupBy("repo_url").agg(F.count("*").alias("n"), F.round(F.avg(F.length("test_code")), 4).alias("mean_chars")).orderBy(F.desc("n"), "repo_url").limit(10)),
    "largest_mean": on_cases(lambda df: df.groupBy("repo_url").agg(F.avg(F.length("test_code")).alias("m")).orderBy(F.desc("m"), "repo_url").limit(1).select("repo_url", F.round("m", 4).alias("mean_chars"))),
    "modal_source": on_cases(lambda df: df.groupBy("lang", "repo_url").agg(F.count("*").alias("n")).groupBy("lang").agg(F.min_by("repo_url", F.struct((-F.col("n")).alias("n"), "repo_url")).alias("modal"))),
}
NAMES = "id test_id is_flaky issue_category repo_url lang test_code java_code failure_log".split()
SQL = {
    "missing_values": sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, round(coalesce(count(*) FILTER ({c} IS NULL) / nullif(count(*), 0), 0) * 100, 4) AS percent FROM cases" for c in NAMES)),
    "duplicate_ids": sql("SELECT count(*) AS n, count(*) - count(DISTINCT id) AS duplicates FROM cases"),
    "duplicate_texts": sql("SELECT sum(c)::BIGINT AS n, sum(c - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS c FROM cases GROUP BY test_code, is_flaky)"),
    "row_and_distinct_counts": sql("SELECT count(*) AS n, count(DISTINCT repo_url) AS repos, count(DISTINCT issue_category) AS categories FROM cases"),
    "class_distribution": sql("SELECT is_flaky, n, round(n * 100.0 / sum(n) OVER (), 4) AS percent FROM (SELECT is_flaky, count(*) AS n FROM cases WHERE is_flaky IS NOT NULL GROUP BY 1)"),
    "category_distribution": sql("SELECT issue_category, n, round(n * 100.0 / sum(n) OVER (), 4) AS percent FROM (SELECT issue_category, count(*) AS n FROM cases GROUP BY 1)"),
    "context_availability": sql(" UNION ALL ".join(f"SELECT '{n}' AS source, count(*) FILTER ({e}) AS available, count(*) - count(*) FILTER ({e}) AS empty, round(count(*) FILTER ({e}) / count(*) * 100, 4) AS percent FROM cases" for n, e in (("failure_log", "trim(failure_log) <> ''"), ("test_code", "trim(test_code) <> ''"), ("label", "is_flaky IS NOT NULL")))),
    "artefact_characterisation": sql(f"SELECT lang, {STATS} FROM (SELECT lang, length(test_code) AS v FROM cases) GROUP BY lang"),
    "size_bins": sql("""WITH b AS (SELECT * FROM (VALUES (0, '<10K'), (1, '10K–25K'), (2, '25K–50K'), (3, '50K–100K'), (4, '100K–250K'), (5, '>250K')) AS t(bin_no, bin)),
  c AS (SELECT CASE WHEN v <= 10000 THEN 0 WHEN v <= 25000 THEN 1 WHEN v <= 50000 THEN 2 WHEN v <= 100000 THEN 3 WHEN v <= 250000 THEN 4 ELSE 5 END AS bin_no, count(*) AS n FROM (SELECT length(test_code) * 5 AS v FROM cases) GROUP BY 1)
SELECT bin_no, bin, coalesce(n, 0) AS n, round(coalesce(n, 0) / sum(n) OVER () * 100, 4) AS percent FROM b LEFT JOIN c USING (bin_no)"""),
    "size_correlation": sql("WITH v AS (SELECT length(test_code) AS test_length, length(failure_log) AS failure_length, len(string_split(test_code, chr(10))) AS lines FROM cases) " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM v" for i, a in enumerate(("test_length", "failure_length", "lines")) for b in ("test_length", "failure_length", "lines")[i:])),
    "log_patterns": sql(" UNION ALL ".join(f"SELECT '{n}' AS pattern, count(*) FILTER (regexp_matches(failure_log, '(?i){p}')) AS n, round(count(*) FILTER (regexp_matches(failure_log, '(?i){p}')) / count(*) * 100, 4) AS percent FROM cases" for n, p in T.LOG_PATTERNS.items())),
    "strip_comments": sql(f"SELECT id, md5(x) AS code_md5, length(x) AS chars FROM (SELECT id, {JAVA_STRIP.format(c='java_code')} AS x FROM cases)"),
    "cleaning_effect": sql(f"""SELECT count(*) AS n, round(avg(length(b)), 4) AS mean_before, round(avg(length(x)), 4) AS mean_after, round(avg(length(b) - length(x)), 4) AS mean_reduction,
  round(sum(length(b) - length(x)) * 100.0 / sum(length(b)), 4) AS reduction_percent, count(*) FILTER (b <> x) AS modified, round(count(*) FILTER (b <> x) * 100.0 / count(*), 4) AS modified_percent FROM (SELECT java_code AS b, {JAVA_STRIP.format(c='java_code')} AS x FROM cases)"""),
    "normalise_logs": sql(f"SELECT id, {LOG.format(c='failure_log')} AS log FROM cases"),
    "first_changed_log": sql(f"SELECT repo_url, id, md5(failure_log) AS before, md5(x) AS after FROM (SELECT *, {LOG.format(c='failure_log')} AS x FROM cases) WHERE failure_log <> x QUALIFY row_number() OVER (PARTITION BY repo_url ORDER BY id) = 1"),
    "clean_maps": sql(f"SELECT id, map_keys(MAP {{lang: java_code, 'blank': ' '}}) = map_keys(MAP {{lang: x, 'blank': ''}}) AS same_keys, length(x) AS chars, md5(x || '|') AS md5 FROM (SELECT id, lang, java_code, {JAVA_STRIP.format(c='java_code')} AS x FROM cases)"),
    "explode_maps": sql("SELECT id, repo_url AS class, lang AS method, length(java_code) AS chars FROM cases UNION ALL SELECT id, repo_url, 'blank', 1 FROM cases"),
    "map_sizes": sql("SELECT id, len(string_split(test_code, chr(10))) AS helpers, len(map_keys(MAP {lang: java_code, 'blank': ' '})) AS methods, length(java_code) + 1 AS chars, 1 + CAST(trim(java_code) = '' AS INT) AS blank FROM cases"),
    "map_csv_form": sql("""SELECT id, length('{' || array_to_string(list_transform(string_split(test_code, chr(10)), lambda l, i: '"h' || (i - 1) || '":' || CAST(to_json(l) AS VARCHAR)), ',') || '}') AS chars, length('{"a": "' || id || '", "b": "x"}') AS json_length FROM cases"""),
    "masked_code": sql(f"""SELECT id, length(m) AS chars, md5(m) AS md5 FROM (SELECT id, 'class T {{ ' || repeat(' ', 15) || ' int a = t(' || repeat(' ', 3) || '); @Test public void t() {{ char c = ' || repeat(' ', 3) || '; '
  || regexp_replace('/* ' || replace(test_code, '*/', '') || ' */', '[^\n]', ' ', 'g') || ' if (a) {{ x(' || repeat(' ', 3) || '); }} ' || repeat(' ', 4) || chr(10) || '}} int u() {{ return 1; }} }}' AS m FROM cases)"""),
    "extracted_methods": sql(f"""SELECT id, NULL AS raw, md5(m) AS masked, 'int u() {{ return 1; }}' AS other FROM (SELECT id, '@Test public void t() {{ char c = ''}}''; /* ' || replace(test_code, '*/', '') || ' */ if (a) {{ x("{{"); }} // {{' || chr(10) || '}}' AS m FROM cases)"""),
    "context_score": sql(f"WITH {SCORED} SELECT is_flaky, context_score, count(*) AS n FROM s GROUP BY ALL"),
    "balance": sql(f"""WITH {SCORED}, g AS (SELECT *, row_number() OVER (ORDER BY context_score DESC, id) AS r FROM s WHERE NOT is_flaky)
SELECT id, is_flaky, context_score, md5(id || '|42') AS shuffled FROM (SELECT id, is_flaky, context_score FROM s WHERE is_flaky UNION ALL SELECT id, is_flaky, context_score FROM g WHERE r <= (SELECT count(*) FROM s WHERE is_flaky))"""),
    "seeded_sample": sql("SELECT id, test_id FROM cases ORDER BY md5(id || '|42'), id LIMIT 50"),
    "representative_rank": sql(f"WITH {FEATURES} SELECT * FROM k"),
    "remove_demos": sql(f"WITH {FEATURES} SELECT id, test_id FROM cases WHERE is_flaky IS NOT NULL AND id NOT IN (SELECT id FROM k WHERE rank <= 2)"),
    "string_functions": sql("SELECT id, replace(replace(lower(issue_category || ' x-'), ' ', '_'), '-', '') AS slug, substr(test_code, 1, 1500) AS shown, strlen(test_code) + 1 AS bytes, length(test_code) / 4 AS tokens, split_part(test_id, '-', 1) AS head, 'm' AS method FROM cases"),
    "recode": sql("""SELECT id, CASE issue_category WHEN 'Time Dependent' THEN 'td' WHEN 'Order Dependent' THEN 'od' WHEN 'Non-Idempotent' THEN 'nio' WHEN 'Implementation Dependent' THEN 'id' ELSE 'none' END AS code,
  CASE WHEN trim(failure_log) = '' THEN 'Unknown' ELSE substr(failure_log, 1, 6) END AS log, CASE WHEN id % 2 = 0 THEN 25.0 ELSE 75.0 END AS percent, greatest(id % 7, id % 5) AS larger FROM cases"""),
    "merge_reid": sql("SELECT row_number() OVER (ORDER BY is_flaky DESC, id) AS id, id AS old_id, test_id, is_flaky FROM cases WHERE is_flaky IS NOT NULL"),
    "commit_lookup": """WITH a AS (SELECT s_name, 'repo-' || s_name AS url FROM supplier WHERE s_suppkey % 3 = 0), b AS (SELECT n_nationkey, 'repo-' || n_name AS url FROM nation WHERE n_nationkey % 2 = 0)
SELECT s_suppkey, coalesce(a.url, b.url, '') AS url, CASE WHEN a.url IS NOT NULL THEN 'name' WHEN b.url IS NOT NULL THEN 'nation' ELSE 'none' END AS "by" FROM supplier LEFT JOIN a USING (s_name) LEFT JOIN b ON s_nationkey = n_nationkey""",
    "upsert": sql("WITH f AS (SELECT id * 2 AS id, 'new' AS state FROM cases WHERE id % 4 = 0) SELECT id, 'old' AS state FROM cases WHERE id NOT IN (SELECT id FROM f) UNION ALL SELECT * FROM f"),
    "composite_keys": sql("SELECT id, CASE WHEN total = 1 THEN concat_ws('-', repo_url, lang) ELSE concat_ws('-', repo_url, lang, CAST(position AS VARCHAR)) END AS key, position, total FROM (SELECT *, row_number() OVER (PARTITION BY repo_url, lang ORDER BY id) AS position, count(*) OVER (PARTITION BY repo_url, lang) AS total FROM cases)"),
    "align_distributions": sql("SELECT lang, count(*) FILTER (is_flaky) AS flaky, count(*) FILTER (NOT is_flaky) AS stable FROM cases WHERE is_flaky IS NOT NULL GROUP BY lang"),
    "helpers_per_class": sql(f"SELECT is_flaky, {STATS} FROM (SELECT is_flaky, CASE WHEN len(string_split(test_code, chr(10))) > 1 THEN len(string_split(test_code, chr(10))) END AS v FROM cases) GROUP BY is_flaky"),
    "top_sources": sql("SELECT repo_url, count(*) AS n, round(avg(length(test_code)), 4) AS mean_chars FROM cases GROUP BY 1 ORDER BY n DESC, repo_url LIMIT 10"),
    "largest_mean": sql("SELECT repo_url, round(avg(length(test_code)), 4) AS mean_chars FROM cases GROUP BY 1 ORDER BY avg(length(test_code)) DESC, repo_url LIMIT 1"),
    "modal_source": sql("SELECT lang, repo_url AS modal FROM (SELECT lang, repo_url, count(*) AS n FROM cases GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, repo_url) = 1"),
}
