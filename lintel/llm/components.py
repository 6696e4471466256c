"""Connected components by alternating large and small stars, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.storage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b); root is the component's smallest node.

    Each round is a written table, so lineage stays short; rounds go on until the
    stars are single ones.  Nodes without edges
    do not occur; self-loops and repeated edges are harmless; no edges give an
    empty table.
    """
    stars = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        stars = written(small.filter("a != b").distinct(), "edges")
        now = tuple(stars.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 24)), F.countDistinct("a")).first())
        if now == seen or now[0] == now[2] and not stars.join(stars.select(F.col("a").alias("b")), "b", "left_semi").head(1):
            break
        seen = now
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
