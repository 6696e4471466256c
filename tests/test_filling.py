"""Greedy filling by ranges against the sequential fold."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lintel.operators import filling as G


def fold(sizes, budget, most):
    out, total, rows, chunk = [], 0, 0, 0
    for s in sizes:
        if not rows or total + s > budget or most is not None and rows >= most:
            chunk, total, rows = chunk + 1, 0, 0
        total, rows = total + s, rows + 1
        out.append(chunk)
    return out


def test_a_thousand_cases_cut_anywhere():
    """What a range keeps for its first rows says how many chunks follow and what the last holds; walking from there gives the fold."""
    r = random.Random(11)
    for _ in range(1000):
        sizes = [r.choice([0, 1, 2, 5, 9, 30]) for _ in range(r.randint(1, 60))]
        budget, most = r.randint(0, 25), r.choice([None, 1, 2, 7])
        want = fold(sizes, budget, most)
        at, got, base, open_sum, open_rows = 0, [], 0, 0, 0
        while at < len(sizes):
            part = np.array(sizes[at : at + r.randint(1, 20)])
            entry = None
            for place, total, count, last_sum, last_rows in zip(*(c.tolist() for c in G.entries(part, budget, most))):
                if not open_rows or open_sum + total > budget or most is not None and open_rows + place >= most:
                    entry = place, base, last_sum, last_rows, base + count
                    break
            entry = entry or (-1, base, open_sum + int(part.sum()), open_rows + len(part), base)
            got += G.numbers(part, entry[0], base, budget, most).tolist()
            _, _, open_sum, open_rows, base = entry
            at += len(part)
        assert got == want, (sizes, budget, most)


@pytest.mark.parametrize("budget, most", [(40, None), (1e9, 13), (7.5, 5), (0, None)])
def test_groups_over_many_ranges(spark, budget, most):
    r = random.Random(2)
    rows = [("hot", i, float(r.choice([0, 0.25, 3, 12, 50]))) for i in range(6000)]
    rows += [(g, r.choice([None, 1, 2, 2, 3]), r.choice([None, -1.0, 4.5, 20.0])) for g in (None, "a", "b") for _ in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame(rows, "g string, k long, v double").withColumn("chunk", F.lit("x"))
    got = Counter(map(tuple, G.chunked(df, "g", "k", F.col("v"), budget, most).select("g", "k", "v", "chunk").collect()))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = Counter()
    for g in ("hot", None, "a", "b"):
        # A null or negative size counts as 0, so which of them comes first makes no difference to the chunks.
        mine = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, max(x[2] or 0, 0)))
        want.update((k, max(v or 0, 0), c, g) for (_, k, v), c in zip(mine, fold([max(v or 0, 0) for _, _, v in mine], budget, most)))
    assert Counter({(k, max(v or 0, 0), c, g): 0 for g, k, v, c in got}).keys() == want.keys()
    total = Counter()
    for (g, k, v, c), n in got.items():
        total[k, max(v or 0, 0), c, g] += n
    assert total == want


def test_no_task_sees_a_hot_group(spark, monkeypatch):
    kept = {}
    write = G.written
    monkeypatch.setattr(G, "written", lambda df, name: kept.setdefault(name, write(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).select(F.lit("hot").alias("g"), "id")
    out = G.chunked(df, "g", "id", F.lit(1), 10)
    assert out.filter("chunk != id div 10 + 1").count() == 0
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in kept["chunk-ranges"].groupBy("range").count().collect()) < 10_000


def test_empty(spark):
    assert G.chunked(spark.createDataFrame([], "g string, k long"), "g", "k", F.lit(1), 10).count() == 0
