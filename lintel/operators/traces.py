"""Failure traces: parsing of reports, failure modes, frames, class graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.functions.text import bare_method, own_frames, trace_key
from lintel.storage import written


def failing(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.lower(F.trim(status)).isin("failure", "error"))


def failure_modes(df: DataFrame, test: str, trace: str, order: str) -> DataFrame:
    """test, key, n, first (order) and the first raw trace of every failure mode."""
    return df.withColumn("_key", trace_key(F.col(trace))).groupBy(test, F.col("_key").alias("key")).agg(F.count("*").alias("n"), F.min(order).alias("first"), F.min_by(trace, order).alias("trace"))


def top_modes(modes: DataFrame, test: str, k: int = 1) -> DataFrame:
    """The k most frequent modes of a test; ties go to the one seen first."""
    r = F.row_number().over(Window.partitionBy(test).orderBy(F.desc("n"), "first", "key"))
    return modes.withColumn("rank", r).filter(F.col("rank") <= k)


def frame_targets(df: DataFrame, trace: str, *keys: str) -> DataFrame:
    """Distinct (class, method) targets of a trace outside of frameworks."""
    return df.select(*keys, F.explode(own_frames(F.col(trace))).alias("f")).select(*keys, "f.*").distinct()


def _cut_before(text: Column, line: str) -> Column:
    """array<string>: ``text`` cut before every line whose beginning matches ``line``; what comes before the first is the first."""
    return F.split(text, rf"(?:(?<=\n)|\A)(?={line})", -1)


#: How a line begins that ends a trace: a failure mark, a time that is no summary, a count of tests, or a rule.
TRACE_END = r"[^\n]*<<< (?:FAILURE|ERROR)!|(?![^\n]*- in)[^\n]*Time elapsed:|Tests run:|---|==="


def report_traces(report: Column, method: Column) -> Column:
    """array<string>: traces that follow a line with the method's name and a failure mark, up to the next line that ends one.

    The report is cut before such lines, in one pass; a part whose first line has
    name and mark is a trace.
    """
    parts = _cut_before(report, TRACE_END)
    first = lambda part: F.substring_index(part, "\n", 1)
    marked = lambda part: first(part).contains("<<< FAILURE!") | first(part).contains("<<< ERROR!")
    named = lambda part: F.regexp_like(first(part), F.concat(F.lit(r"\b\Q"), bare_method(method), F.lit(r"\E\b")))
    body = lambda part: F.regexp_replace(F.regexp_replace(F.regexp_replace(part, r"\A[^\n]*\n?", ""), r"\r\n", "\n"), r"\A\n+|\s+\z", "")
    return F.filter(F.transform(F.filter(parts, lambda p: marked(p) & named(p)), body), lambda t: t != "")


def sections(text: Column) -> Column:
    """array<struct<class,method,log>> of a sectioned text: ``--- Class::method`` lines, each with its log."""
    parts = F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit(r"(?s)\n--- (.*?)(?=\n--- |\z)"), F.lit(1))
    each = F.transform(
        parts,
        lambda p: F.struct(
            F.trim(F.regexp_extract(p, r"\A([^\n]*?)::", 1)).alias("class"),
            F.trim(F.regexp_extract(p, r"\A[^\n]*?::([^\n]*)", 1)).alias("method"),
            F.regexp_replace(F.regexp_replace(p, r"\A[^\n]*\n?", ""), r"\s+\z", "").alias("log"),
            p.rlike(r"\A[^\n]*::").alias("ok"),
        ),
    )
    return F.transform(F.filter(each, lambda s: s["ok"]), lambda s: F.struct(s["class"].alias("class"), s["method"].alias("method"), s["log"].alias("log")))


#: How a line begins that starts a hunk or ends one.
HUNK = "@@"
HUNK_OR_HEADER = r"@@|---|\+\+\+|Index:|==="


def removed_lines(patch: Column, context: bool = False) -> Column:
    """Lines that a unified diff takes out, in its hunks, without their mark; with ``context`` the unchanged ones too.

    The diff is cut before every hunk and header, in one pass; hunks give their lines.
    """
    hunks = F.filter(_cut_before(patch, HUNK_OR_HEADER), lambda p: p.startswith(HUNK))
    takes = lambda line: line.startswith("-") | (line.startswith(" ") & F.lit(context))
    lines = F.flatten(F.transform(hunks, lambda p: F.filter(F.split(p, "\n"), takes)))
    return F.array_join(F.transform(lines, lambda line: F.substring(line, 2, 1_000_000_000)), "\n")


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, ancestor, level) along child -> parent up to the top or around a cycle; level: the fewest steps.

    Steps are doubled: what is up to n steps away, and what is n steps beyond
    that; it ends when that adds nothing, whatever the depth.
    """
    jump = written(edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).filter("child != ancestor").distinct(), "ancestors-jump")
    found, n, steps = written(jump.withColumn("level", F.lit(1)), "ancestors"), 0, 1
    while (now := found.count()) > n:
        n = now
        ahead = jump.withColumnRenamed("ancestor", "middle")
        further = ahead.join(found.select(F.col("child").alias("middle"), "ancestor", (F.col("level") + steps).alias("level")), "middle").filter("child != ancestor").select("child", "ancestor", "level")
        found = written(found.unionByName(further).groupBy("child", "ancestor").agg(F.min("level").alias("level")), "ancestors")
        jump = written(ahead.join(jump.withColumnRenamed("child", "middle"), "middle").select("child", "ancestor").distinct(), "ancestors-jump")
        steps *= 2
    return found


def resolved_names(names: DataFrame, imports: DataFrame, files: DataFrame) -> DataFrame:
    """names (file, package, name) -> fqn: by the file's imports, else a class of the package, else the raw name."""
    by_import = imports.select("file", F.regexp_extract("import", r"([^.]*)$", 1).alias("name"), F.col("import").alias("a")).groupBy("file", "name").agg(F.min("a").alias("a"))
    known = files.select(F.col("fqn").alias("b")).distinct()
    out = names.join(by_import, ["file", "name"], "left").withColumn("b", F.concat_ws(".", F.nullif("package", F.lit("")), "name"))
    return out.join(known.withColumn("_known", F.lit(True)), "b", "left").withColumn("fqn", F.coalesce("a", F.when(F.col("_known"), F.col("b")), "name")).drop("a", "b", "_known")
