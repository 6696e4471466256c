"""Numbers within groups, of which no task holds a hot one."""

from collections import Counter

from pyspark.sql import functions as F

from lintel.operators import select as L
from lintel.plans import q_profile
from lintel.plans.adapters import view

SF = "/root/testdata/sf0.001"


def test_numbered_equals_brute_force(spark):
    rows = [("hot", i * 7919 % 3000) for i in range(3000)] + [("b", 5), ("b", 2), (None, 9), (None, 1)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(8)
    got = sorted(map(repr, map(tuple, L.numbered(df, ["g"], ["k"], "r", "n").collect())))
    want, seen, totals = [], Counter(), Counter(g for g, _ in rows)
    for g, k in sorted(rows, key=lambda x: (x[0] or "", x[1])):
        seen[g] += 1
        want.append((g, k, seen[g], totals[g]))
    assert got == sorted(map(repr, want))


def test_ranges_share_a_hot_group(spark, monkeypatch):
    """A group of all rows is numbered in several tasks, unless Spark joins small ones."""
    from lintel import storage

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept = []
    write = storage.written
    monkeypatch.setattr(storage, "written", lambda df, name: kept.append(write(df, name)) or kept[-1])
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id").alias("k"))
    assert L.numbered(df, ["g"], ["k"], "r").filter("r = k + 1").count() == 20_000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in kept[0].groupBy("_range").count().collect()) < 10_000


def test_no_window_over_the_rows(spark):
    plan = q_profile.QUERIES["recode"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    df = view(spark, SF, "cases")
    assert L.balance(q_profile._scored(df).select("id", "is_flaky", "context_score"), "is_flaky", "context_score").count() > 0
