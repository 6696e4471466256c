"""The stages that make cases out of raw inputs, each a composition of operators over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.functions import text as T
from lintel.operators import code as C
from lintel.operators import traces as X
from lintel.operators.select import filled_only, numbered, renumbered
from lintel.sources.git import blobs
from lintel.sources.sinks import to_csv, to_json_lines
from lintel.storage import written

# Names of categories by their short form, and the columns of a case in order.
CATEGORY_NAMES = {"id": "Implementation Dependent", "od": "Order Dependent", "nio": "Non-Idempotent", "td": "Time Dependent"}
CASE_COLUMNS = ["id", "test_id", "isFlaky", "issue_category", "repo_url", "issue_commit", "fixed_commit", "test_code", "helper_methods_json", "failure_log", "code_under_test_json"]


def known_folders(df: DataFrame, name: str, folders: DataFrame) -> DataFrame:
    """Rows for which there is a folder (column ``folder``) of that name, of the same case or else the first of another case."""
    met = df.join(folders.select("folder").distinct(), F.lower(F.col(name)) == F.lower("folder"))
    best = F.min(F.struct((F.col(name) != F.col("folder")).alias("other"), "folder"))
    found = met.groupBy(name).agg(best.alias("f")).select(name, "f.folder")
    return df.join(found, name)


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """At most ``n`` of the rows that are left to process; all without a limit."""
    return df if n is None else df.orderBy(*order).limit(n)


def flaky_metadata(configs: DataFrame, folders: DataFrame, by_name: DataFrame, limit: int | None = None) -> DataFrame:
    """Cases of configured flaky tests (at, test_id, zip, test_type) that have a result folder, numbered in their order.

    by_name: (name, repo_url, flaky_commit, fixed_commit), looked up by test, else by archive.
    """
    kept = first_rows(known_folders(configs, "test_id", folders).drop("folder"), ["at"], limit)
    of = lambda c, alias: by_name.select(F.col("name").alias(c), F.struct("repo_url", "flaky_commit", "fixed_commit").alias(alias))
    met = kept.join(of("test_id", "own"), "test_id", "left").join(of("zip", "archive"), "zip", "left")
    found = F.coalesce("own", "archive", F.struct(*(F.lit("").alias(c) for c in ("repo_url", "flaky_commit", "fixed_commit"))))
    names = F.create_map(*(F.lit(x) for pair in CATEGORY_NAMES.items() for x in pair))
    category = F.coalesce(F.try_element_at(names, F.lower("test_type")), F.lit(""))
    rows = met.select("at", "test_id", F.lit(1).alias("isFlaky"), category.alias("issue_category"), found.alias("m"))
    rows = rows.select("at", "test_id", "isFlaky", "issue_category", "m.repo_url", F.col("m.flaky_commit").alias("issue_commit"), "m.fixed_commit")
    return renumbered([rows], "at", "id").drop("at")


def stable_metadata(bugs: DataFrame, triggers: DataFrame, urls: DataFrame, existing: DataFrame | None = None, force: bool = False, limit: int | None = None) -> DataFrame:
    """Cases of failing but stable tests: one for each section of a bug's trigger file, numbered by project, bug and section.

    bugs: (project, bug, buggy, fixed); triggers: (project, bug, text); urls: (project, repo_url); tests that ``existing`` has are passed over unless forced.
    """
    sections = triggers.select("project", "bug", X.sections(F.col("text")).alias("sections")).filter(F.size("sections") > 0)
    each = C.numbered_methods(sections).join(bugs, ["project", "bug"]).join(urls, "project")
    if existing is not None and not force:
        each = each.join(existing.select("test_id"), "test_id", "left_anti")
    each = first_rows(each, ["project", "bug", "at"], limit)
    rows = each.select(F.struct("project", "bug", "at").alias("order"), "test_id", F.lit(0).alias("isFlaky"), F.lit("Non-Flaky").alias("issue_category"), "repo_url", F.col("buggy").alias("issue_commit"), F.col("fixed").alias("fixed_commit"), "class", "method")
    return renumbered([rows], "order", "id").drop("order")


def flaky_logs(cases: DataFrame, tests: DataFrame, reports: DataFrame, rounds: DataFrame, force: bool = False) -> DataFrame:
    """Cases with ``failure_log``: the most frequent failure of a test and how many of its rounds had it.

    tests: (test_id, method).  Each report (test_id, path, text) is a round; a test
    without reports is looked up in ``rounds`` (test_id, round, test, result, trace)
    and gets an empty log if none failed there.  Cases with a log stay unless forced.
    """
    todo, done = filled_only(cases, "failure_log", force)
    todo = written(todo, "logs-todo")
    asked = todo.select("test_id").join(tests, "test_id")
    met = asked.join(reports, "test_id")
    traces = met.select("test_id", "path", F.posexplode(X.report_traces(F.col("text"), F.col("method"))).alias("at", "trace"))
    traces = traces.select("test_id", F.struct("path", F.col("at").cast("long").alias("at")).alias("order"), "trace")
    totals = met.groupBy("test_id").agg(F.count("*").alias("total"))
    other = asked.join(totals, "test_id", "left_anti").join(rounds, "test_id")
    mine = T.bare_method(F.col("test")).endswith(T.bare_method(F.col("method")))
    failed = X.failing(other.filter(mine), "result").select("test_id", F.struct(F.col("round").cast("string").alias("path"), F.lit(0).cast("long").alias("at")).alias("order"), "trace")
    totals = totals.unionByName(other.groupBy("test_id").agg(F.count_distinct("round").alias("total")))
    modes = X.failure_modes(traces.unionByName(failed).filter(T.trace_key(F.col("trace")) != ""), "test_id", "trace", "order")
    top = X.top_modes(modes, "test_id").join(totals, "test_id").select("test_id", T.rounds_header(F.col("n"), F.col("total"), F.col("trace")).alias("log"))
    empty = other.select("test_id").distinct().join(top, "test_id", "left_anti").select("test_id", F.lit("").alias("log"))
    fresh = todo.join(top.unionByName(empty), "test_id", "left").withColumn("failure_log", F.coalesce("log", "failure_log")).select(*cases.columns)
    return done.unionByName(fresh)


def stable_logs(cases: DataFrame, triggers: DataFrame, force: bool = False) -> DataFrame:
    """Cases with ``failure_log``: the log of their section of the trigger file (project, bug, text), as one failed round of one."""
    todo, done = filled_only(cases, "failure_log", force)
    sections = triggers.select("project", "bug", X.sections(F.col("text")).alias("sections")).filter(F.size("sections") > 0)
    parts = F.split("test_id", "-")
    logs = C.numbered_methods(sections).select(F.col("project").alias("_p"), F.col("bug").alias("_b"), F.col("at").alias("_n"), F.col("log").alias("_log"))
    keyed = todo.withColumn("_p", parts[0]).withColumn("_b", F.get(parts, F.lit(1))).withColumn("_n", F.coalesce(F.get(parts, F.lit(2)).cast("int"), F.lit(1)))
    fresh = keyed.join(logs, ["_p", "_b", "_n"], "left")
    header = T.rounds_header(F.lit(1), F.lit(1), F.col("_log"))
    return done.unionByName(fresh.withColumn("failure_log", F.when(F.col("_log").isNotNull(), header).otherwise(F.col("failure_log"))).select(*cases.columns))


def with_code(cases: DataFrame, tests: DataFrame, files: DataFrame, patched: DataFrame | None = None, most: int | None = None, search_masked: bool = False) -> DataFrame:
    """Cases with ``test_code`` and ``helper_methods_json`` from their classes and what these extend, else from ``patched`` (test_id, test_code, helpers)."""
    found = C.classes(files, search_masked)
    code = C.tests_and_helpers(tests, C.hierarchy(found, most), found)
    if patched is not None:
        code = code.unionByName(patched.select(*code.columns).join(code.select("test_id"), "test_id", "left_anti"))
    none = F.create_map().cast("map<string,string>")
    out = cases.drop("test_code", "helper_methods_json").join(code, "test_id", "left")
    return out.select(*cases.drop("test_code", "helper_methods_json").columns, F.coalesce("test_code", F.lit("")).alias("test_code"), F.coalesce("helpers", none).alias("helper_methods_json"))


def files_of_classes(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(repo, fqn, path, code) of classes (repo, commit, source_dir, fqn) out of packs, where their package says; those that aren't there are left out."""
    outer = F.replace(F.regexp_extract("fqn", r"^[^$]*", 0), F.lit("."), F.lit("/"))
    named = asked.select("repo", "commit", "fqn", F.concat(F.concat_ws("/", F.nullif("source_dir", F.lit("")), outer), F.lit(".java")).alias("path")).distinct()
    return blobs(index, named).filter("data is not null").select("repo", "fqn", "path", F.decode("data", "UTF-8").alias("code"))


def with_code_from_packs(cases: DataFrame, tests: DataFrame, index: DataFrame, patched: DataFrame | None = None) -> DataFrame:
    """``with_code`` from commits: tests (test_id, repo, commit, source_dir, class, method), and the classes that theirs extend, one level up.

    A repository at a commit is a repository of its own; cases without code there take that of ``patched``.
    """
    at = tests.withColumn("repo", F.concat_ws("@", "repo", "commit"))
    own = written(files_of_classes(index, at.withColumnRenamed("class", "fqn")), "packs-own")
    parents = C.classes(own, search_masked=True).filter("parent is not null").select("repo", F.col("parent").alias("fqn"))
    where = at.select("repo", "commit", "source_dir").distinct()
    files = own.unionByName(files_of_classes(index, parents.join(where, "repo").join(own.select("repo", "fqn"), ["repo", "fqn"], "left_anti")))
    return with_code(cases, at, files, patched, most=1, search_masked=True)


def with_code_under_test(cases: DataFrame, tests: DataFrame, files: DataFrame, covered: DataFrame, common: list[str] | None = None) -> DataFrame:
    """Cases (test_code, helper_methods_json, failure_log) with ``code_under_test_json``: what coverage, traces and calls name, else the fallbacks."""
    found = C.classes(files)
    chain = C.hierarchy(found)
    mine = cases.join(tests.select("test_id", "repo", "class"), "test_id")
    frames = mine.select("test_id", F.explode(T.own_frames(F.col("failure_log"))).alias("f"), F.col("class").alias("test")).select("test_id", F.col("f.class").alias("fqn"), "f.method", "test")
    frames = frames.filter(~T.is_test_class(F.col("fqn"), F.col("test"))).select("test_id", "fqn", "method").distinct()
    bodies = mine.select("test_id", "repo", "class", F.explode(F.concat(F.array("test_code"), F.map_values("helper_methods_json"))).alias("body"))
    cut = C.code_under_test(tests, [covered, frames, C.static_calls(bodies, chain, found)], chain, found, common)
    return cases.join(cut.select("test_id", F.col("code_under_test").alias("code_under_test_json")), "test_id", "left")


def merged(parts: list[DataFrame], key: str = "test_id", folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(cases one part after the other with ids 1..N, rows by isFlaky with their share); with ``folder`` also written as JSON Lines and CSV."""
    named = [p.select(*(c for c in CASE_COLUMNS if c in p.columns and c != "id")) for p in parts]
    out = written(renumbered(named, key, "id"), "merged")
    counts = out.groupBy("isFlaky").agg(F.count("*").alias("n")).withColumn("percent", F.round(F.col("n") * 100.0 / out.count(), 2))
    if folder:
        to_json_lines(out, f"{folder}/cases.jsonl", CASE_COLUMNS)
        to_csv(out.select(*(c for c in CASE_COLUMNS if c in out.columns)), f"{folder}/cases.csv")
    return out, counts


def refined(cases: DataFrame, log: str = "failure_log", code: tuple[str, ...] = ("test_code",), maps: tuple[str, ...] = (), nested: tuple[str, ...] = ()) -> DataFrame:
    """Cases with comments, left-overs of doc comments and rounds headers taken out; maps and nested maps value by value."""
    clean = lambda c: T.strip_comments(T.strip_orphan_docs(F.coalesce(c, F.lit(""))))
    new: dict[str, Column] = {log: T.normalise_log(F.col(log))} | {c: clean(F.col(c)) for c in code}
    new |= {c: F.transform_values(c, lambda _, v: clean(v)) for c in maps}
    new |= {c: F.transform_values(c, lambda _, m: F.transform_values(m, lambda _, v: clean(v))) for c in nested}
    return cases.withColumns(new)


def preprocessed(cases: DataFrame, expected: list[str], **columns) -> tuple[DataFrame, DataFrame]:
    """(refined cases, checks): columns, ids and keys must be what they were before; check, ok."""
    out = written(refined(cases, **columns), "refined")
    one = out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    before = cases.agg(F.count("*").alias("n")).first()
    checks = [
        ("columns", sorted(out.columns) == sorted(expected)),
        ("rows", one.n == before.n),
        ("ids", one.n == one.ids),
        ("same ids", not cases.select("id").exceptAll(out.select("id")).head(1)),
        ("no comments", not out.filter(F.lit(False) if not columns.get("code") else F.col(columns["code"][0]).rlike(r"(?m)^\s*//")).head(1)),
    ]
    return out, cases.sparkSession.createDataFrame(checks, "check string, ok boolean")


def labelled(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows with their number in a group and the group's size."""
    return numbered(rows, by, order, "position", "total")
