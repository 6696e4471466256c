"""Queries over Java sources and the stages that make cases, on sources written from the test tables.

The SQL reads the same fixture tables but knows only the rule by which they were made, not the operators' results.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lintel.functions import java as J
from lintel.functions import text as T
from lintel.operators import code as C
from lintel.operators import stages as G
from lintel.operators import traces as X
from lintel.plans.adapters import view, with_views
from lintel.plans.q_profile import JAVA_STRIP, LOG
from lintel.storage import table, written


def on(names, text):
    """A DataFrame of SQL over test tables, named in braces, that means the same in both engines."""
    return lambda spark, sf_dir: spark.sql(text, **{n: table(spark, sf_dir, n) for n in names.split()})


# Class k stands in package p(k % 5) of repository r(k % 3) and extends class k - 15 unless k is a multiple of 4 or has none: C17 extends C2.
PARENT = "(k > 15 AND k % 4 <> 0)"
FILES = """SELECT 'r' || CAST(k % 3 AS STRING) AS repo, 'com.acme.p' || CAST(k % 5 AS STRING) || '.C' || CAST(k AS STRING) AS fqn, k,
  'package com.acme.p' || CAST(k % 5 AS STRING) || ';' || chr(10) || 'import static org.junit.Assert.fail;' || chr(10) || 'import com.acme.p' || CAST((k + 3) % 5 AS STRING) || '.C' || CAST(k + 3 AS STRING) || ';' || chr(10)
  || '/* class Old extends Gone {{ */ public class C' || CAST(k AS STRING) || CASE WHEN PARENT THEN ' extends C' || CAST(k - 15 AS STRING) || '<T>' ELSE '' END || ' {{' || chr(10)
  || '  C' || CAST(k + 3 AS STRING) || ' v; // Bad w' || chr(10) || '  protected C' || CAST(k AS STRING) || '() {{ v = null; }}' || chr(10) || '  public static int run' || CAST(k AS STRING) || '() {{ return "}}".length(); }}' || chr(10)
  || CASE WHEN PARENT THEN '' ELSE '  void base() {{ int x = helper() + missing(); int y = ' || CAST(k AS STRING) || '; }}' || chr(10) END
  || CASE WHEN k % 2 = 0 OR NOT PARENT THEN '  int helper() {{ return ' || CAST(k AS STRING) || '; }}' || chr(10) ELSE '' END || '}}' AS code
FROM (SELECT c_custkey AS k FROM {customer}) AS t""".replace("PARENT", PARENT)
#: The same as DuckDB SQL, and where a class finds base() and helper().
SOURCES = f"""f AS ({FILES.format(customer="customer")}),
  s AS (SELECT k, fqn, repo, CASE WHEN (4 - k % 4) % 4 < (k - 1) // 15 THEN (4 - k % 4) % 4 ELSE (k - 1) // 15 END AS up FROM f), top AS (SELECT max(k) AS n FROM f)"""
NAME = "'com.acme.p' || ({0}) % 5 || '.C' || ({0})"


def _files(spark, sf_dir):
    return on("customer", FILES)(spark, sf_dir)


def _tests(spark, sf_dir):
    return _files(spark, sf_dir).select(F.col("k").alias("test_id"), "repo", F.col("fqn").alias("class"), F.lit("base[1]").alias("method"))


def _structure(spark, sf_dir):
    found = C.classes(_files(spark, sf_dir).select("repo", "fqn", "code"))
    m = F.col("masked")
    return found.select("fqn", "package", F.array_join("imports", ",").alias("imports"), F.coalesce("parent", F.lit("")).alias("parent"), F.array_join(C.declared_methods(F.col("methods")), ",").alias("declared"), F.array_join(T.helper_calls(m), ",").alias("calls"), F.col("variables")["v"].alias("type_of_v"))


#: Document k as a Java file: its whole text in comments and literals, generics, overloads, a nested class, an abstract method, and for some a brace too few or two files of one class.
AWKWARD = """SELECT k, 'a.D' || CAST(k % 997 AS STRING) AS fqn, 'z' || CAST(k AS STRING) AS path, 'package a;' || chr(10) || '/* class Old {{ ' || replace(t, '*/', '') || ' */ public class D extends Base<List<Map<String, D>>> {{' || chr(10)
  || '  // see; above {{' || chr(10) || '  @Override public Map<String, List<String>> run(int a) {{ // ' || replace(t, chr(10), ' ') || chr(10) || '    if (a > 0) {{ return one("}}{{;" + ' || CAST(length(t) AS STRING) || '); }} return null; }}' || chr(10)
  || '  protected int[] one(String s) {{ char c = chr(34) ; return new int[] {{ s.length() }}; }}' || chr(10) || '  private void one(int i) {{ while (i > 0) {{ i--; }} }}' || chr(10)
  || '  static class In {{ In() {{ }} public <T> T deep(T x) {{ String q = "' || replace(replace(replace(t, chr(92), ''), chr(34), ''), chr(10), ' ') || '"; return x; }} abstract void none(); }}' || chr(10)
  || '  void last() {{ run(1); }}' || chr(10) || CASE WHEN k % 10 = 3 THEN '' ELSE '}}' END AS code
FROM (SELECT doc_id AS k, coalesce(text, '') AS t FROM {documents}) AS d"""


def _method_index(spark, sf_dir):
    files = on("documents", AWKWARD)(spark, sf_dir).select(F.lit("r").alias("repo"), "fqn", "path", "code")
    index = C.method_index(C.classes(files, search_masked=True))
    marks = F.when(F.col("body").isNotNull(), F.size(F.regexp_extract_all(J.mask(F.col("body")), F.lit("[{};]"), F.lit(0))).cast("long"))
    place = F.row_number().over(Window.partitionBy("fqn").orderBy("at")).cast("long")
    return index.select("fqn", place.alias("place"), "name", F.col("depth").cast("long").alias("depth"), marks.alias("marks"), "first")


def _hierarchy(spark, sf_dir):
    return C.hierarchy(C.classes(_files(spark, sf_dir))).select("class", "owner", F.col("level").cast("long").alias("level"))


def _one_level(spark, sf_dir):
    return C.hierarchy(C.classes(_files(spark, sf_dir)), 1).filter("level = 1").select("class", "owner")


def _cases_with_code(spark, sf_dir, most=None):
    cases = _tests(spark, sf_dir).select("test_id", F.lit("").alias("test_code"), F.create_map().cast("map<string,string>").alias("helper_methods_json"))
    out = G.with_code(cases, _tests(spark, sf_dir), _files(spark, sf_dir), most=most)
    return out.select("test_id", "test_code", F.array_join(F.map_keys("helper_methods_json"), ",").alias("names"), F.array_join(F.map_values("helper_methods_json"), "|").alias("bodies"))


def _static(spark, sf_dir):
    found = C.classes(_files(spark, sf_dir))
    other = F.concat(F.lit("C"), (F.col("test_id") + 3).cast("string"))
    body = F.concat(other, F.lit(" u = new "), other, F.lit("(); v.go(); other(); close(); u.none(); String s = \"Zed.no()\"; // Q.no()\n"))
    bodies = _tests(spark, sf_dir).select("test_id", "repo", "class", body.alias("body"))
    return C.static_calls(bodies, C.hierarchy(found), found).select("test_id", "fqn", "method")


def _public(spark, sf_dir):
    return C.public_methods(C.classes(_files(spark, sf_dir))).select("fqn", "method", "body")


# Repository s(k) has a test class; what it imports, a class named like it, and a common class, as k % 4 goes.
CUT_FILES = """SELECT 's' || CAST(k AS STRING) AS repo, fqn, 'package x; ' || more || 'public class ' || simple || ' {{ public int go() {{ return ' || CAST(k AS STRING) || '; }} int hidden() {{ return 0; }} }}' AS code FROM (
  SELECT k, 'com.x.Foo' || CAST(k AS STRING) || 'Test' AS fqn, 'Foo' || CAST(k AS STRING) || 'Test' AS simple, 'import java.util.List; import com.x.y.Dep' || CAST(k AS STRING) || '; ' AS more FROM (SELECT s_suppkey AS k FROM {supplier}) AS t
  UNION ALL SELECT k, 'com.x.y.Dep' || CAST(k AS STRING), 'Dep' || CAST(k AS STRING), '' FROM (SELECT s_suppkey AS k FROM {supplier}) AS t WHERE k % 4 < 2
  UNION ALL SELECT k, 'com.x.MyFoo' || CAST(k AS STRING) || 'Impl', 'MyFoo' || CAST(k AS STRING) || 'Impl', '' FROM (SELECT s_suppkey AS k FROM {supplier}) AS t WHERE k % 4 = 2
  UNION ALL SELECT k, 'com.google.gson.Gson', 'Gson', '' FROM (SELECT s_suppkey AS k FROM {supplier}) AS t) AS files"""


def _code_under_test(spark, sf_dir):
    files = written(on("supplier", CUT_FILES)(spark, sf_dir), "fixture")
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    text = F.col("k").cast("string")
    tests = ids.select(F.col("k").alias("test_id"), F.concat(F.lit("s"), text).alias("repo"), F.concat(F.lit("com.x.Foo"), text, F.lit("Test")).alias("class"))
    frame = F.concat(F.lit("    at com.x.y.Dep"), text, F.lit(".go(D.java:1)\n    at com.x.Foo"), text, F.lit("Test.t(F.java:1)\n    at org.junit.Assert.fail(A.java:1)"))
    cases = ids.select(F.col("k").alias("test_id"), F.lit("").alias("test_code"), F.create_map().cast("map<string,string>").alias("helper_methods_json"), F.when(F.col("k") % 8 == 0, frame).otherwise("").alias("failure_log"))
    covered = ids.filter("k % 8 = 4").select(F.col("k").alias("test_id"), F.concat(F.lit("com.x.y.Dep"), text).alias("fqn"), F.lit("go").alias("method"))
    out = G.with_code_under_test(cases, tests, files, covered)
    return out.select("test_id", F.explode("code_under_test_json").alias("fqn", "m")).select("test_id", "fqn", F.explode("m").alias("method", "body"))


def _patches(spark, sf_dir):
    """Odd tests are taken out whole; of even ones a part stands in unchanged lines."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("test_id"))
    k = F.col("test_id").cast("string")
    mark = F.when(F.col("test_id") % 2 == 0, " ").otherwise("-")
    first = F.when(F.col("test_id") % 2 == 0, "-  int z;").otherwise("- * left over of t() {")
    lines = [F.lit("--- a/T.java\n+++ b/T.java\n@@ -1,4 +1,1 @@"), first, F.lit("-  @Test"), F.concat(mark, F.lit("  public void t() {")), F.concat(F.lit("-    int a = h("), k, F.lit(") + get();")), F.lit("-  }"), F.lit("-  int h(int i) { return i; }"), F.lit("+  // gone"), F.lit("   int get() { return 1; }")]
    patch = F.array_join(F.array(*lines), "\n")
    rows = ids.select("test_id", F.lit("t").alias("method"), X.removed_lines(patch).alias("removed"), X.removed_lines(patch, True).alias("context"))
    out = C.patch_code(written(rows, "fixture"))
    return out.select("test_id", "test_code", F.array_join(F.map_keys("helpers"), ",").alias("names"), F.array_join(F.map_values("helpers"), "|").alias("bodies"))


def _test_files(spark, sf_dir):
    """By source root and package where k % 3 = 0, else below a test folder, else anywhere."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").alias("t"))
    path = F.when(F.col("k") % 3 == 0, F.concat(F.lit("src/com/a/T"), F.col("t"), F.lit(".java"))).when(F.col("k") % 3 == 1, F.concat(F.lit("tests/T"), F.col("t"), F.lit(".java"))).otherwise(F.concat(F.lit("odd/T"), F.col("t"), F.lit(".java")))
    files = ids.select(F.lit("r").alias("repo"), path.alias("path"), F.concat(F.lit("class T"), F.col("t")).alias("code"))
    files = files.unionByName(ids.select(F.lit("r").alias("repo"), F.concat(F.lit("zz/T"), F.col("t"), F.lit(".java")).alias("path"), F.lit("").alias("code")))
    tests = ids.select(F.col("k").alias("test_id"), F.lit("r").alias("repo"), F.concat(F.lit("com.a.T"), F.col("t"), F.lit("$Inner")).alias("class"), F.lit("src").alias("source_dir"))
    return C.test_files(tests, files).select("test_id", "path", F.col("kind").cast("long").alias("kind"))


def _path_classes(spark, sf_dir):
    roots = F.element_at(F.array(*map(F.lit, ["src/main/java/", "own/", "tests/", "src/", "other/"])), (F.col("c_custkey") % 5 + 1).cast("int"))
    path = F.concat(roots, F.lit("com/a/T"), F.col("c_custkey").cast("string"), F.lit(".java"))
    return table(spark, sf_dir, "customer").select("c_custkey", C.fqn_of_path(path, F.lit("own")).alias("fqn"))


def _guesses(spark, sf_dir):
    forms = F.array(*(F.concat(F.lit(a), F.col("c_custkey").cast("string"), F.lit(b)) for a, b in (("com.x.Foo", "Test"), ("com.x.Test", "Bar"), ("Foo", "TestCase"), ("com.x.Foo", ""), ("com.x.Foo", "Tests$Inner"))))
    name = F.element_at(forms, (F.col("c_custkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.production_guess(name).alias("guess"), T.is_test_class(name, F.lit("com.x.Foo3")).alias("is_test"))


TRIGGER = "CASE WHEN k % 3 = 0 THEN '' ELSE '--- com.a.T' || CAST(k AS STRING) || '::one' || chr(10) || 'java.lang.Error: a' || chr(10) || '  at x' || chr(10) || chr(10) || CASE WHEN k % 3 = 2 THEN '--- com.a.T' || CAST(k AS STRING) || '::two' || chr(10) || 'b' || chr(10) ELSE '' END END"
TRIGGERS = f"SELECT 'P' || CAST(k % 4 AS STRING) AS project, CAST(k AS STRING) AS bug, 'b' || CAST(k AS STRING) AS buggy, 'f' || CAST(k AS STRING) AS fixed, {TRIGGER} AS text FROM (SELECT s_suppkey AS k FROM {{supplier}}) AS t"


def _stable_metadata(spark, sf_dir):
    rows = on("supplier", TRIGGERS)(spark, sf_dir)
    urls = spark.sql("SELECT 'P' || CAST(id AS STRING) AS project, 'http://x/' || CAST(id AS STRING) AS repo_url FROM range(3)")
    existing = rows.filter("bug like '%7'").select(F.concat_ws("-", "project", "bug").alias("test_id"))
    return G.stable_metadata(rows.select("project", "bug", "buggy", "fixed"), rows.select("project", "bug", "text"), urls, existing)


def _stable_logs(spark, sf_dir):
    rows = on("supplier", TRIGGERS)(spark, sf_dir)
    cases = rows.select(F.concat_ws("-", "project", "bug").alias("test_id"), F.when(F.col("bug").endswith("1"), "kept").otherwise("").alias("failure_log"))
    cases = cases.unionByName(rows.filter("cast(bug as int) % 3 = 2").select(F.concat_ws("-", "project", "bug", F.lit("2")).alias("test_id"), F.lit("").alias("failure_log")))
    return G.stable_logs(cases, rows.select("project", "bug", "text"))


def _flaky_metadata(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("t"))
    kinds = F.array(*map(F.lit, ["ID", "od", "nio", "td", "??"]))
    configs = s.select(F.col("k").alias("at"), F.concat(F.lit("Test"), "t").alias("test_id"), F.concat(F.lit("zip"), (F.col("k") % 10).cast("string")).alias("zip"), F.element_at(kinds, (F.col("k") % 5 + 1).cast("int")).alias("test_type"))
    folders = s.filter("k % 7 <> 0").select(F.when(F.col("k") % 2 == 0, F.concat(F.lit("Test"), "t")).otherwise(F.concat(F.lit("tEST"), "t")).alias("folder"))
    meta = lambda name: [name.alias("name"), F.concat(F.lit("u-"), name).alias("repo_url"), F.lit("c1").alias("flaky_commit"), F.lit("c2").alias("fixed_commit")]
    by_name = s.filter("k % 3 = 0").select(*meta(F.concat(F.lit("Test"), "t"))).unionByName(spark.sql("SELECT 'zip' || CAST(id AS STRING) AS z FROM range(0, 10, 2)").select(*meta(F.col("z"))))
    return G.flaky_metadata(configs, folders, by_name)


REPORT = "'Test set: C' || chr(10) || 'one(com.a.C)  Time elapsed: 1 s  <<< ' || CASE WHEN j % 2 = 0 THEN 'FAILURE!' ELSE 'ERROR!' END || chr(10) || 'java.lang.Error: ' || CAST(j AS STRING) || chr(10) || '  at com.a.C' || CAST(j % 3 % 2 AS STRING) || '.one(C.java:1)' || chr(10) || chr(10) || 'Tests run: 2' || chr(10)"


def _flaky_logs(spark, sf_dir):
    """Three reports of a test where k % 4 < 2; else rounds, of which those of k % 4 = 3 have no failure."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    cases = ids.select(F.col("k").alias("test_id"), F.when(F.col("k") % 10 == 0, "kept").otherwise("").alias("failure_log"))
    tests = ids.select(F.col("k").alias("test_id"), F.lit("one[x]").alias("method"))
    reports = ids.filter("k % 4 < 2").select("k", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j")).select(F.col("k").alias("test_id"), F.col("j").cast("string").alias("path"), F.expr(REPORT).alias("text"))
    rounds = ids.filter("k % 4 >= 2").select("k", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("j"))
    rounds = rounds.select(F.col("k").alias("test_id"), F.col("j").alias("round"), F.lit("com.a.C.one").alias("test"), F.when((F.col("k") % 4 == 2) & (F.col("j") > 2), "failure").otherwise("pass").alias("result"), F.lit("at com.a.C.one(C.java:2)").alias("trace"))
    return G.flaky_logs(cases, tests, reports, rounds)


def _merged(spark, sf_dir):
    cases = view(spark, sf_dir, "cases").filter("is_flaky is not null").select("test_id", F.col("is_flaky").cast("int").alias("isFlaky"), "issue_category", "repo_url")
    out, _ = G.merged([cases.filter("isFlaky = 1"), cases.filter("isFlaky = 0")])
    return out.select("id", "test_id", "isFlaky")


def _merged_counts(spark, sf_dir):
    cases = view(spark, sf_dir, "cases").filter("is_flaky is not null").select("test_id", F.col("is_flaky").cast("int").alias("isFlaky"))
    return G.merged([cases.filter("isFlaky = 1"), cases.filter("isFlaky = 0")])[1]


def _preprocessed(spark, sf_dir, checks=False):
    cases = view(spark, sf_dir, "cases").select("id", "java_code", "failure_log")
    out, found = G.preprocessed(cases, ["id", "java_code", "failure_log"], code=("java_code",))
    return found if checks else out.select("id", F.md5("java_code").alias("code"), F.md5("failure_log").alias("log"))


QUERIES = {
    "class_structure": _structure,
    "method_index": _method_index,
    "class_hierarchy": _hierarchy,
    "parent_only": _one_level,
    "cases_with_code": _cases_with_code,
    "static_calls": _static,
    "public_methods": _public,
    "code_under_test": _code_under_test,
    "patched_code": _patches,
    "test_files": _test_files,
    "path_classes": _path_classes,
    "class_guesses": _guesses,
    "stable_metadata": _stable_metadata,
    "stable_logs": _stable_logs,
    "flaky_metadata": _flaky_metadata,
    "flaky_logs": _flaky_logs,
    "merged_cases": _merged,
    "merged_counts": _merged_counts,
    "preprocessed_cases": _preprocessed,
    "preprocess_checks": lambda spark, sf_dir: _preprocessed(spark, sf_dir, True),
}
BASE = "'void base() {{ int x = helper() + missing(); int y = ' || {0} || '; }}'"
HELPER = "'int helper() { return ' || CASE WHEN k % 2 = 0 OR up = 0 THEN k ELSE k - 15 END || '; }'"
SQL = {
    "class_structure": f"""WITH {SOURCES} SELECT fqn, 'com.acme.p' || k % 5 AS package, 'org.junit.Assert.fail,' || {NAME.format("k + 3")} AS imports, CASE WHEN up > 0 THEN {NAME.format("k - 15")} ELSE '' END AS parent,
  array_to_string(list_sort(list_filter(['C' || k, CASE WHEN up = 0 THEN 'base' END, CASE WHEN up = 0 OR k % 2 = 0 THEN 'helper' END, 'run' || k], lambda x: x IS NOT NULL)), ',') AS declared,
  array_to_string(list_sort(list_filter(['C' || k, CASE WHEN up = 0 THEN 'base' END, CASE WHEN up = 0 OR k % 2 = 0 THEN 'helper' END, 'length', CASE WHEN up = 0 THEN 'missing' END, 'run' || k], lambda x: x IS NOT NULL)), ',') AS calls, 'C' || (k + 3) AS type_of_v FROM s""",
    "method_index": f"""WITH f AS ({AWKWARD.format(documents="documents")}), u AS (SELECT fqn, min_by(code, path) AS code FROM f GROUP BY fqn),
  m AS (SELECT fqn, regexp_replace(code, '"(?:[^"\\\\]|\\\\.)*"|//[^\\n]*|/\\*.*?\\*/', ' ', 'gs') AS code FROM u),
  l AS (SELECT fqn, regexp_extract_all(code, '[{{}};]|(?:[a-zA-Z0-9_$]+|[>\\]])\\s+[a-zA-Z0-9_$]+\\s*\\(') AS s FROM m),
  t AS (SELECT fqn, i, s[i] AS x FROM (SELECT fqn, s, unnest(range(1, len(s) + 1)) AS i FROM l)),
  d AS (SELECT *, sum(CASE x WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER (PARTITION BY fqn ORDER BY i) AS after, length(x) = 1 AS sign FROM t),
  n AS (SELECT *, min(CASE WHEN x IN ('{{', ';') THEN i END) OVER (PARTITION BY fqn ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM d),
  c AS (SELECT n.fqn, n.i, regexp_extract(n.x, '([a-zA-Z0-9_$]+)\\s*\\($', 1) AS name, n.after AS depth, o.x = '{{' AS opened, n.next FROM n LEFT JOIN d o ON o.fqn = n.fqn AND o.i = n.next WHERE NOT n.sign AND NOT regexp_matches(n.x, '^new\\s')),
  e AS (SELECT c.fqn, c.i, c.name, c.depth, c.next, min(d.i) AS shut FROM c LEFT JOIN d ON c.opened AND d.fqn = c.fqn AND d.i > c.next AND d.x = '}}' AND d.after = c.depth GROUP BY ALL),
  w AS (SELECT e.fqn, e.i, e.name, e.depth, e.shut, count(d.i) AS marks FROM e LEFT JOIN d ON d.fqn = e.fqn AND d.sign AND d.i BETWEEN e.next AND e.shut GROUP BY ALL)
SELECT fqn, row_number() OVER (PARTITION BY fqn ORDER BY i) AS place, name, CAST(depth AS BIGINT) AS depth, CASE WHEN shut IS NOT NULL THEN marks END AS marks, row_number() OVER (PARTITION BY fqn, name ORDER BY i) = 1 AS first FROM w""",
    "class_hierarchy": f"WITH {SOURCES} SELECT fqn AS class, {NAME.format('k - 15 * l')} AS owner, l AS level FROM (SELECT *, unnest(range(0, up + 1)) AS l FROM s)",
    "parent_only": f"WITH {SOURCES} SELECT fqn AS class, {NAME.format('k - 15')} AS owner FROM s WHERE up > 0",
    "cases_with_code": f"WITH {SOURCES} SELECT k AS test_id, {BASE.format('(k - 15 * up)')} AS test_code, 'helper' AS names, {HELPER} AS bodies FROM s",
    "static_calls": f"""WITH {SOURCES}, i AS (SELECT k, {NAME.format("k - 15 * l + 3")} AS fqn FROM (SELECT *, unnest(range(0, up + 1)) AS l FROM s), top WHERE k - 15 * l + 3 <= n)
SELECT k AS test_id, fqn, unnest(['C' || (k + 3), 'go', 'none', 'other']) AS method FROM i UNION SELECT k, {NAME.format("k + 3")}, unnest(['<init>', 'go']) FROM s""",
    "public_methods": f"""WITH {SOURCES} SELECT fqn, '<init>' AS method, '// Bad w' || chr(10) || '  protected C' || k || '() {{ v = null; }}' AS body FROM s UNION ALL SELECT fqn, 'run' || k, 'public static int run' || k || '() {{ return "}}".length(); }}' FROM s""",
    "code_under_test": """SELECT s_suppkey AS test_id, CASE WHEN s_suppkey % 4 < 2 THEN 'com.x.y.Dep' || s_suppkey WHEN s_suppkey % 4 = 2 THEN 'com.x.MyFoo' || s_suppkey || 'Impl' ELSE 'com.google.gson.Gson' END AS fqn, 'go' AS method,
  'public int go() { return ' || s_suppkey || '; }' AS body FROM supplier""",
    "patched_code": """SELECT c_custkey AS test_id, '@Test' || chr(10) || '  public void t() {' || chr(10) || '    int a = h(' || c_custkey || ') + get();' || chr(10) || '  }' AS test_code, 'h' AS names, 'int h(int i) { return i; }' AS bodies FROM customer""",
    "test_files": "SELECT c_custkey AS test_id, CASE c_custkey % 3 WHEN 0 THEN 'src/com/a/T' WHEN 1 THEN 'tests/T' ELSE 'odd/T' END || c_custkey || '.java' AS path, c_custkey % 3 + 1 AS kind FROM customer",
    "path_classes": "SELECT c_custkey, CASE WHEN c_custkey % 5 = 4 THEN 'other.' ELSE '' END || 'com.a.T' || c_custkey AS fqn FROM customer",
    "class_guesses": """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Foo' || c_custkey WHEN 1 THEN c_custkey || 'Bar' WHEN 2 THEN 'Foo' || c_custkey WHEN 3 THEN 'Foo' || c_custkey ELSE 'Foo' || c_custkey || 'Tests$Inner' END AS guess,
  c_custkey % 5 IN (0, 2) OR c_custkey = 3 AS is_test FROM customer""",
    "stable_metadata": """WITH e AS (SELECT 'P' || k % 4 AS project, CAST(k AS VARCHAR) AS bug, k, unnest(range(1, k % 3 + 1)) AS j, k % 3 AS n FROM (SELECT s_suppkey AS k FROM supplier)),
  x AS (SELECT *, project || '-' || bug || CASE WHEN n > 1 THEN '-' || j ELSE '' END AS test_id FROM e WHERE project <> 'P3')
SELECT row_number() OVER (ORDER BY project, bug, j) AS id, test_id, 0 AS "isFlaky", 'Non-Flaky' AS issue_category, 'http://x/' || k % 4 AS repo_url, 'b' || k AS issue_commit, 'f' || k AS fixed_commit, 'com.a.T' || k AS class,
  CASE j WHEN 1 THEN 'one' ELSE 'two' END AS method FROM x WHERE NOT (bug LIKE '%7' AND n = 1)""",
    "stable_logs": """WITH c AS (SELECT s_suppkey AS k, 1 AS j, 'P' || s_suppkey % 4 || '-' || s_suppkey AS test_id FROM supplier UNION ALL SELECT s_suppkey, 2, 'P' || s_suppkey % 4 || '-' || s_suppkey || '-2' FROM supplier WHERE s_suppkey % 3 = 2)
SELECT test_id, CASE WHEN j = 1 AND CAST(k AS VARCHAR) LIKE '%1' THEN 'kept' WHEN k % 3 = 0 THEN '' ELSE 'Failed Rounds: 1/1' || chr(10) || CASE j WHEN 1 THEN 'java.lang.Error: a' || chr(10) || '  at x' ELSE 'b' END END AS failure_log FROM c""",
    "flaky_metadata": """SELECT row_number() OVER (ORDER BY k) AS id, 'Test' || k AS test_id, 1 AS "isFlaky", CASE k % 5 WHEN 0 THEN 'Implementation Dependent' WHEN 1 THEN 'Order Dependent' WHEN 2 THEN 'Non-Idempotent' WHEN 3 THEN 'Time Dependent' ELSE '' END AS issue_category,
  CASE WHEN k % 3 = 0 THEN 'u-Test' || k WHEN k % 2 = 0 THEN 'u-zip' || k % 10 ELSE '' END AS repo_url, CASE WHEN k % 3 = 0 OR k % 2 = 0 THEN 'c1' ELSE '' END AS issue_commit, CASE WHEN k % 3 = 0 OR k % 2 = 0 THEN 'c2' ELSE '' END AS fixed_commit
FROM (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 7 <> 0)""",
    "flaky_logs": """SELECT s_suppkey AS test_id, CASE WHEN s_suppkey % 10 = 0 THEN 'kept' WHEN s_suppkey % 4 < 2 THEN 'Failed Rounds: 2/3' || chr(10) || 'java.lang.Error: 0' || chr(10) || '  at com.a.C0.one(C.java:1)'
  WHEN s_suppkey % 4 = 2 THEN 'Failed Rounds: 3/5' || chr(10) || 'at com.a.C.one(C.java:2)' ELSE '' END AS failure_log FROM supplier""",
    "merged_cases": with_views("""SELECT row_number() OVER (ORDER BY is_flaky DESC, test_id) AS id, test_id, CAST(is_flaky AS INT) AS "isFlaky" FROM cases WHERE is_flaky IS NOT NULL""", "cases"),
    "merged_counts": with_views("""SELECT CAST(is_flaky AS INT) AS "isFlaky", count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent FROM cases WHERE is_flaky IS NOT NULL GROUP BY 1""", "cases"),
    "preprocessed_cases": with_views(f"SELECT id, md5({JAVA_STRIP.format(c='java_code')}) AS code, md5({LOG.format(c='failure_log')}) AS log FROM cases", "cases"),
    "preprocess_checks": "SELECT unnest(['columns', 'rows', 'ids', 'same ids', 'no comments']) AS \"check\", true AS ok",
}
