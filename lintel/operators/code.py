"""Java sources as tables: classes, what they extend, their methods, and the calls between them.

A table of files has ``repo``, ``fqn`` (the class a file is named after) and ``code``.
A table of tests has ``test_id``, ``repo``, ``class`` and ``method``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.functions import java as J
from lintel.functions import text as T
from lintel.functions.structures import once
from lintel.operators.traces import ancestors
from lintel.storage import written

# Marks of test classes, calls that name no method to look for, names that are no methods, source roots, common classes.
TEST_SUFFIX = r"(Test|Tests|TestCase|Spec)$"
TOO_COMMON = T.NOT_HELPERS + [
    "get", "size", "add", "put", "contains", "isEmpty", "values", "clear", "next",
    "hasNext", "remove", "split", "length", "write", "read", "run", "start", "stop",
    "close", "flush", "format", "substring", "replace", "valueOf", "builder", "build",
    "create", "init", "newInstance", "getInstance", "getClass",
]
NOT_METHODS = ["class", "interface", "enum", "new", "throws", "return", "if", "for", "while", "switch", "catch"]
SOURCE_ROOTS = ["src/main/java/", "src/test/java/", "src/", "source/", "tests/"]
COMMON_CLASSES = ["com.alibaba.fastjson.JSON", "com.alibaba.fastjson2.JSON", "com.fasterxml.jackson.databind.ObjectMapper", "com.google.gson.Gson"]


def simple_name(fqn: Column) -> Column:
    return F.regexp_extract(fqn, r"([^.$]*)$", 1)


def declared_methods(methods: Column) -> Column:
    """Sorted names of an outline's methods."""
    return F.array_sort(F.array_distinct(F.transform(methods, lambda m: m["name"])))


def without_orphan_comments(patch: Column) -> Column:
    """Lines that begin like a part of a doc comment are blanked."""
    return F.array_join(F.transform(F.split(patch, "\n"), lambda l: F.when(F.ltrim(l).rlike(r"^(\* |\*/|/\*\*)"), "").otherwise(l)), "\n")


def fqn_of_path(path: Column, source_dir: Column) -> Column:
    """The class that a path stands for: without its source root, which is ``source_dir`` or a usual one, and its ending."""
    rest = path
    for root in reversed(SOURCE_ROOTS):
        rest = F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1))).otherwise(rest)
    own = F.concat(source_dir, F.lit("/"))
    rest = F.when((source_dir != "") & path.startswith(own), F.substr(path, F.length(own) + 1)).otherwise(rest)
    return F.replace(F.regexp_replace(rest, r"\.[^./]*$", ""), F.lit("/"), F.lit("."))


def classes(files: DataFrame, search_masked: bool = False) -> DataFrame:
    """One row for each repo and fqn, from one scan of its code: masked, package, imports, parent (full name or null), variables, types and methods.

    Of repeated files the one with the least path counts, or the least code where
    there is no path.  search_masked: whether methods are looked for in masked code.
    """
    order = [c for c in ("path",) if c in files.columns]
    # The scan is work by row, not by byte: partitions of small files aren't to be joined into few.
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = files.repartition(parts, "repo", "fqn").groupBy("repo", "fqn").agg(F.min(F.struct(*order, "code")).alias("f")).select("repo", "fqn", "f.code")
    out = one.withColumn("o", once(J.outlined(F.col("code"), search_masked))).select("repo", "fqn", "code", "o.*")
    masked, own = F.col("masked"), F.col("fqn")
    name = F.get(F.filter("types", lambda t: t["kind"] == "class"), F.lit(0))["parent"]
    parent = F.nullif(T.parent_fqn(masked, name, own), own)
    found = out.select("repo", "fqn", "code", "masked", T.package(masked).alias("package"), T.imports(masked).alias("imports"), parent.alias("parent"), T.variable_types(masked).alias("variables"), "types", "methods")
    return written(found, "classes")


def method_index(found: DataFrame) -> DataFrame:
    """(repo, fqn, name, inside, depth, at, first, first_open, constructor, body) of every declared method."""
    return found.select("repo", "fqn", F.explode("methods").alias("m")).select("repo", "fqn", "m.*")


def hierarchy(found: DataFrame, most: int | None = None) -> DataFrame:
    """(repo, class, owner, level): every class with itself at level 0 and those that it extends; ``most``: levels at most."""
    name = lambda c: F.struct("repo", F.col(c).alias("fqn"))
    edges = found.filter("parent is not null").select(name("fqn").alias("child"), name("parent").alias("parent"))
    up = edges.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("level")).distinct() if most == 1 else ancestors(edges)
    up = up if most is None else up.filter(F.col("level") <= most)
    up = up.select("child.repo", F.col("child.fqn").alias("class"), F.col("ancestor.fqn").alias("owner"), F.col("level").cast("int"))
    own = found.select("repo", F.col("fqn").alias("class"), F.col("fqn").alias("owner"), F.lit(0).alias("level"))
    return written(own.unionByName(up.join(found.select("repo", F.col("fqn").alias("owner")), ["repo", "owner"], "left_semi")), "hierarchy")


def methods(asked: DataFrame, chain: DataFrame, found: DataFrame) -> DataFrame:
    """(repo, class, method, owner, body): each asked method's body in the nearest class of the chain that has it.

    Names are looked up in the index first; bodies follow for what was found only.
    """
    index = method_index(found).filter("first and body is not null").withColumnRenamed("fqn", "owner")
    name = F.when(F.col("method") == "<init>", simple_name(F.col("class"))).otherwise(F.col("method"))
    tried = asked.select("repo", "class", "method", name.alias("name")).distinct().join(chain, ["repo", "class"]).join(index.select("repo", "owner", "name"), ["repo", "owner", "name"])
    best = tried.groupBy("repo", "class", "method", "name").agg(F.min(F.struct("level", "owner"))["owner"].alias("owner"))
    return best.join(index.select("repo", "owner", "name", "body"), ["repo", "owner", "name"]).select("repo", "class", "method", "owner", "body")


def _map_of(key: str, value: str) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))


def tests_and_helpers(tests: DataFrame, chain: DataFrame, found: DataFrame) -> DataFrame:
    """test_id, test_code and helpers (map of name to body): the test's method and what it calls of its own classes; tests without code are left out."""
    named = tests.withColumn("method", T.bare_method(F.col("method")))
    code = written(named.join(methods(named, chain, found), ["repo", "class", "method"]).select("test_id", "repo", "class", "method", F.col("body").alias("test_code")), "test-code")
    calls = code.select("test_id", "repo", "class", F.col("method").alias("own"), F.explode(T.helper_calls(J.mask(F.col("test_code")))).alias("method")).filter("method != own").drop("own")
    helpers = calls.join(methods(calls, chain, found), ["repo", "class", "method"]).groupBy("test_id").agg(_map_of("method", "body").alias("helpers"))
    none = F.create_map().cast("map<string,string>")
    return code.join(helpers, "test_id", "left").select("test_id", "test_code", F.coalesce("helpers", none).alias("helpers"))


def patch_code(patches: DataFrame) -> DataFrame:
    """test_id, test_code and helpers out of unified diffs (test_id, method, removed, context): the lines taken out alone, else with the unchanged ones."""
    # The scans are work by row, not by byte: narrow rows of one file aren't to stay in one task, nor the filter to go before the dealing.
    patches = patches.repartition(int(patches.sparkSession.conf.get("spark.sql.shuffle.partitions")), "test_id")
    clean = J.method(without_orphan_comments(F.col("removed")), F.col("method"))
    alone = F.when(clean.isNotNull(), F.coalesce(J.method(F.col("removed"), F.col("method")), clean))
    out = patches.withColumn("alone", once(alone)).withColumn("test_code", once(F.coalesce("alone", J.method(F.col("context"), F.col("method"))))).filter("test_code is not null")
    out = out.withColumn("source", F.when(F.col("alone").isNotNull(), F.col("removed")).otherwise(F.col("context")))
    called = F.array_except(T.helper_calls(J.mask(F.col("test_code"))), F.array("method", *map(F.lit, ["get", "set", "size", "add", "put", "remove", "contains", "isEmpty"])))
    out = out.withColumns({"called": once(called), "declared": once(J.outlined(F.col("source")))})
    helpers = F.filter("declared.methods", lambda m: m["first"] & m["body"].isNotNull() & F.array_contains("called", m["name"]))
    entries = F.array_sort(F.transform(helpers, lambda m: F.struct(m["name"].alias("key"), m["body"].alias("value"))))
    return out.select("test_id", "test_code", F.map_from_entries(entries).alias("helpers"))


def test_files(tests: DataFrame, files: DataFrame) -> DataFrame:
    """(test_id, path, kind): where a test's class (repo, class, source_dir) stands among files (repo, path, code).

    First (1) the path that source root and package give, then (2) a file of its
    name below a test folder that names the class, then (3) any file of its name; the
    least path of a kind.  Whole paths are looked up by themselves, and of the files
    of one name only the least of each kind go on, so a common name is no pile.
    """
    base = F.regexp_extract("class", r"^[^$]*", 0)
    asked = tests.select("test_id", "repo", F.concat(F.concat_ws("/", "source_dir", F.replace(base, F.lit("."), F.lit("/"))), F.lit(".java")).alias("at"), simple_name(base).alias("simple"))
    there = files.filter(F.col("path").endswith(".java")).select("repo", "path", F.regexp_extract("path", r"([^/]*)\.java$", 1).alias("simple"), "code")
    tested = F.lower("path").rlike("test|spec") & F.contains("code", "simple")
    named = there.groupBy("repo", "simple").agg(F.min(F.when(tested, F.col("path"))).alias("tested"), F.min("path").alias("any"))
    direct = asked.join(there.select("repo", F.col("path").alias("at")).distinct(), ["repo", "at"]).select("test_id", F.lit(1).alias("kind"), F.col("at").alias("path"))
    other = asked.join(named, ["repo", "simple"]).select("test_id", F.when(F.col("tested").isNotNull(), 2).otherwise(3).alias("kind"), F.coalesce("tested", "any").alias("path"))
    return direct.unionByName(other).groupBy("test_id").agg(F.min(F.struct("kind", "path")).alias("f")).select("test_id", "f.path", "f.kind")


def _scope(chain: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a class and those it extends make known: imports, packages and variables' types, the nearest first."""
    all_ = chain.join(found.select("repo", F.col("fqn").alias("owner"), "imports", "package", "variables"), ["repo", "owner"])
    imports = all_.select("repo", "class", "level", F.explode("imports").alias("import")).withColumn("name", simple_name(F.col("import")))
    imports = imports.groupBy("repo", "class", "name").agg(F.min(F.struct("level", "import")).alias("x")).select("repo", "class", "name", F.col("x.import").alias("fqn"))
    packages = all_.groupBy("repo", "class", "package").agg(F.min("level").alias("level"))
    types = all_.select("repo", "class", "level", F.explode("variables").alias("variable", "type"))
    types = types.groupBy("repo", "class", "variable").agg(F.min(F.struct("level", "type")).alias("x")).select("repo", "class", "variable", F.col("x.type").alias("type"))
    return imports, packages, types


def _production(fqn: Column) -> Column:
    return ~T.is_framework_class(fqn) & ~fqn.rlike(TEST_SUFFIX)


def static_calls(bodies: DataFrame, chain: DataFrame, found: DataFrame) -> DataFrame:
    """(test_id, repo, fqn, method): production methods that bodies (test_id, repo, class, body) may call, as far as names tell.

    Calls on a variable of known type or on a class; constructors; classes that
    are named; and every called name on every imported production class.
    """
    imports, packages, types = _scope(chain, found)
    known = found.select("repo", "fqn")
    rows = written(bodies.select("test_id", "repo", "class", J.mask(F.col("body")).alias("masked")), "static-bodies")
    pairs = lambda pattern, *names: F.arrays_zip(*(F.regexp_extract_all("masked", F.lit(pattern), F.lit(i)).alias(n) for i, n in enumerate(names, 1)))
    member = rows.select("test_id", "repo", "class", F.explode(pairs(r"\b(\w+)\.(\w+)\s*\(", "variable", "method")).alias("c")).select("test_id", "repo", "class", "c.*").filter(~F.col("method").isin(T.NOT_HELPERS)).distinct()
    member = member.join(types, ["repo", "class", "variable"], "left").withColumn("name", F.coalesce("type", F.when(F.col("variable").rlike("^[A-Z]"), F.col("variable")))).filter("name is not null")
    named = rows.select("test_id", "repo", "class", F.explode(F.array_distinct(F.regexp_extract_all("masked", F.lit(r"\b([A-Z]\w*)\b"), F.lit(1)))).alias("name"), F.lit("<init>").alias("method"))
    wanted = written(member.select("test_id", "repo", "class", "name", "method").unionByName(named.select("test_id", "repo", "class", "name", "method")).distinct(), "static-names")
    names = wanted.select("repo", "class", "name").distinct()
    by_import = names.join(imports, ["repo", "class", "name"]).withColumn("rank", F.lit(-1))
    in_package = names.join(packages, ["repo", "class"]).withColumn("fqn", F.concat_ws(".", F.nullif("package", F.lit("")), "name")).join(known, ["repo", "fqn"], "left_semi").select("repo", "class", "name", "fqn", F.col("level").alias("rank"))
    bare = names.join(known.withColumnRenamed("fqn", "name"), ["repo", "name"], "left_semi").select("repo", "class", "name", F.col("name").alias("fqn"), F.lit(1 << 30).alias("rank"))
    resolved = reduce(DataFrame.unionByName, [by_import, in_package, bare]).groupBy("repo", "class", "name").agg(F.min(F.struct("rank", "fqn")).alias("x")).select("repo", "class", "name", F.col("x.fqn").alias("fqn"))
    direct = wanted.join(resolved, ["repo", "class", "name"]).filter(_production(F.col("fqn"))).select("test_id", "repo", "fqn", "method")
    called = rows.select("test_id", "repo", "class", F.explode(F.array_except(F.regexp_extract_all("masked", F.lit(r"\b(\w+)\s*\("), F.lit(1)), F.array(*map(F.lit, TOO_COMMON)))).alias("method")).distinct()
    usable = imports.filter(~T.is_framework_class(F.col("fqn"))).join(known, ["repo", "fqn"], "left_semi").select("repo", "class", "fqn").distinct()
    return direct.unionByName(called.join(usable, ["repo", "class"]).select("test_id", "repo", "fqn", "method")).distinct()


def public_methods(found: DataFrame) -> DataFrame:
    """(repo, fqn, method, body): the first public or protected method of each name in every class, its constructor as <init>."""
    own = F.col("name") == simple_name(F.col("fqn"))
    each = method_index(found).filter("first_open").filter(own | ~F.col("constructor")).filter(~F.col("name").isin(NOT_METHODS))
    return each.select("repo", "fqn", F.when(own, "<init>").otherwise(F.col("name")).alias("method"), "body")


def _nested(rows: DataFrame) -> DataFrame:
    """test_id and map of class to (map of method to body)."""
    inner = rows.groupBy("test_id", "fqn").agg(_map_of("method", "body").alias("methods"))
    return inner.groupBy("test_id").agg(F.map_from_entries(F.collect_list(F.struct("fqn", "methods"))).alias("code_under_test"))


def code_under_test(tests: DataFrame, targets: list[DataFrame], chain: DataFrame, found: DataFrame, common: list[str] | None = None) -> DataFrame:
    """test_id, tier and code_under_test (class -> method -> body) of every test.

    targets: tables (test_id, fqn, method) from coverage, traces and calls; tier 0
    has their bodies.  Tests without any get the public methods of what their
    classes import (1), of a class named like the test (2), of a common class (3).
    """
    tests = tests.select("test_id", "repo", "class").distinct()
    known = found.select("repo", "fqn")
    asked = reduce(DataFrame.unionByName, [t.select("test_id", "fqn", "method") for t in targets]).distinct().join(tests.select("test_id", "repo"), "test_id")
    asked = asked.join(known, ["repo", "fqn"], "left_semi").withColumnRenamed("fqn", "class")
    tiers = [written(asked.join(methods(asked, chain, found), ["repo", "class", "method"]).select("test_id", F.col("class").alias("fqn"), "method", "body"), "cut-0")]
    open_ = written(public_methods(found), "cut-public")
    imports, _, _ = _scope(chain, found)

    def left():
        done = reduce(DataFrame.unionByName, [t.select("test_id") for t in tiers]).distinct()
        return tests.join(done, "test_id", "left_anti")

    def add(candidates: DataFrame) -> None:
        tiers.append(written(candidates.join(open_, ["repo", "fqn"]).select("test_id", "fqn", "method", "body"), f"cut-{len(tiers)}"))

    add(left().join(imports, ["repo", "class"]).filter(_production(F.col("fqn"))).select("test_id", "repo", "fqn").distinct())
    guess = left().withColumn("base", T.production_guess(simple_name(F.col("class")))).filter(F.col("base") != simple_name(F.col("class"))).withColumn("package", F.regexp_extract("class", r"^(.*)\.[^.]*$", 1))
    named = known.join(open_.select("repo", "fqn").distinct(), ["repo", "fqn"], "left_semi").withColumn("package", F.regexp_extract("fqn", r"^(.*)\.[^.]*$", 1)).filter(~F.col("fqn").rlike(TEST_SUFFIX))
    near = guess.join(named, ["repo", "package"]).filter(F.contains(F.lower(simple_name(F.col("fqn"))), F.lower("base"))).withColumn("exact", simple_name(F.col("fqn")) == F.col("base"))
    exact = near.filter("exact").select("test_id").distinct()
    add(near.filter("exact").select("test_id", "repo", "fqn").unionByName(near.filter("package != ''").join(exact, "test_id", "left_anti").select("test_id", "repo", "fqn")))
    ranks = F.array(*map(F.lit, common or COMMON_CLASSES))
    usual = open_.select("repo", "fqn").distinct().withColumn("rank", F.array_position(ranks, F.col("fqn"))).filter("rank > 0").groupBy("repo").agg(F.min_by("fqn", "rank").alias("fqn"))
    add(left().join(usual, "repo").select("test_id", "repo", "fqn"))
    rows = reduce(DataFrame.unionByName, [_nested(t).withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)])
    none = F.create_map().cast("map<string,map<string,string>>")
    return tests.select("test_id").join(rows, "test_id", "left").select("test_id", "tier", F.coalesce("code_under_test", none).alias("code_under_test"))


def numbered_methods(parts: DataFrame) -> DataFrame:
    """Sections of trigger files (project, bug, sections) one by one: test_id, class, method, log; the number is left off where there is one section only."""
    each = parts.select("project", "bug", F.size("sections").alias("n"), F.posexplode("sections").alias("i", "s"))
    key = F.concat_ws("-", "project", "bug", F.when(F.col("n") > 1, (F.col("i") + 1).cast("string")))
    return each.select("project", "bug", (F.col("i") + 1).alias("at"), "n", key.alias("test_id"), "s.*")

