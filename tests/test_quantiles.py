"""Exact quantiles by selection against ``percentile``, and line scans on long texts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lintel.operators import quantiles as Q
from lintel.operators import traces as X

PROBABILITIES = (0.0, 0.025, 0.25, 0.5, 0.95, 0.99, 1.0)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_equal_to_percentile(spark, coalesce):
    r = random.Random(7)
    rows = [("hot", None, float(r.choice([0, 1, 1, 2, r.random()])), i) for i in range(4000)]
    rows += [(g, h, r.choice([None, -1.5, 3.0, 8.0]), None) for g in (None, "a") for h in (None, 1) for _ in range(9)] + [("lone", 1, 5.0, 1), ("none", 1, None, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double, w long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    wanted = {f"{c}{i}": (F.col(c), p) for c in "vw" for i, p in enumerate(PROBABILITIES)}
    got = Q.with_quantiles(df.groupBy("g", "h").agg(F.count("*").alias("n")), df, ["g", "h"], wanted).collect()
    want = df.groupBy("g", "h").agg(F.count("*").alias("n"), *(F.percentile(c, F.lit(p)).alias(f"{c}{i}") for c in "vw" for i, p in enumerate(PROBABILITIES))).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    form = lambda rows: sorted(repr([round(x, 9) if isinstance(x, float) else x for x in r]) for r in rows)
    assert form(got) == form(want)


def test_without_groups_or_rows(spark):
    df = spark.range(101)
    assert Q.quantiles(df, [], {"m": (F.col("id"), 0.5), "q": (F.col("id") * 2, 0.25)}).select("m", "q").collect() == [(50.0, 50.0)]
    assert Q.quantiles(df.limit(0), [], {"m": (F.col("id"), 0.5)}).count() == 0


def test_no_task_sees_all_values(spark, monkeypatch):
    kept = {}
    write = Q.written
    monkeypatch.setattr(Q, "written", lambda df, name: kept.setdefault(name, write(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert Q.quantiles(spark.range(50_000), [], {"m": (F.col("id"), 0.5)}).first().m == 24999.5
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in kept["quantile-counts"].groupBy("_range").count().collect()) < 20_000


def removed(patch, context=False):
    inside, out = False, []
    for line in patch.split("\n"):
        header = line.startswith(("---", "+++", "Index:", "==="))
        if inside and not header and (line.startswith("-") or context and line.startswith(" ")):
            out.append(line[1:])
        inside = True if line.startswith("@@") else False if header else inside
    return "\n".join(out)


def test_removed_lines_equal_a_fold(spark):
    r = random.Random(1)
    patches = ["\n".join(r.choice(["@@ -1 +1 @@", "--- a", "+++ b", "Index: x", "===", "-gone", "- x", " same", "+new", "", "-", "@@", "\r", " @@", "x--- y", "-\r@@"]) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    rows = spark.createDataFrame([(p,) for p in patches], "p string").select("p", X.removed_lines(F.col("p")).alias("a"), X.removed_lines(F.col("p"), True).alias("b")).collect()
    for row in rows:
        assert (row.a, row.b) == (removed(row.p), removed(row.p, True)), row.p


def traces(report, name):
    done, held = [], None
    for line in report.replace("\r\n", "\n").split("\n"):
        marked = "<<< FAILURE!" in line or "<<< ERROR!" in line
        stops = marked or "Time elapsed:" in line and "- in" not in line or line.startswith(("Tests run:", "---", "==="))
        if stops:
            done.append(held)
            held = [] if marked and name in line.replace("(", " ").split() else None
        elif held is not None:
            held.append(line)
    texts = ("\n".join(x).lstrip("\n").rstrip() for x in [*done, held] if x is not None)
    return [t for t in texts if t]


def test_report_traces_equal_a_fold(spark):
    r = random.Random(2)
    lines = ["one(C) <<< FAILURE!", "one(C) Time elapsed: 1 <<< ERROR!", "two(C) <<< FAILURE!", "Tests run: 1", "x Time elapsed: 2", "Time elapsed: 2 - in C", "---", "=== x", "at a", "", "  b ", "done one"]
    reports = [r.choice(["\n", "\r\n"]).join(r.choice(lines) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    rows = spark.createDataFrame([(p,) for p in reports], "p string").select("p", X.report_traces(F.col("p"), F.lit("one[x]")).alias("t")).collect()
    for row in rows:
        assert row.t == traces(row.p, "one"), row.p


def test_long_texts_take_linear_time(spark):
    """Ten times the lines take less than ten times the time."""
    def seconds(n):
        patch = spark.range(1).select(F.concat(F.lit("@@\n"), F.repeat(F.lit("-gone\n same\n@@ x\n+new\n"), n // 4)).alias("p"), F.repeat(F.lit("one <<< FAILURE!\n at a\n at b\nTests run: 1\n"), n // 4).alias("r"))
        began = time.perf_counter()
        row = patch.select(F.length(X.removed_lines(F.col("p"))).alias("n"), F.size(X.report_traces(F.col("r"), F.lit("one"))).alias("t")).first()
        assert (row.n, row.t) == (n // 4 * 5 - 1, n // 4)
        return time.perf_counter() - began

    seconds(400)
    assert seconds(400_000) < 10 * max(seconds(40_000), 0.3)
