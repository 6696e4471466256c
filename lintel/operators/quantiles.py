"""Exact quantiles by distributed selection.

1. Equal values of a group are counted, before and after one shuffle.
2. Counted values are dealt to ranges of (group, measure, value) and kept.
3. Running counts of whole ranges, a narrow row each, show in which range the one
   or two ranks of a quantile lie.
4. Only those ranges are read again; running counts within a range give the values.

No task sees more than a range, whatever a group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.storage import written


def group_key(by: list[str]) -> Column:
    """One struct for the columns of a group, so that null groups are groups and no group at all is one."""
    return F.struct(*(F.col(f"`{c}`") for c in by)) if by else F.struct(F.lit(0).alias("all"))


def quantiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """``_by`` (``group_key``) and a column for each of ``wanted`` (name -> value, probability), interpolated between neighbours.

    Null values are left out; a quantile of no values is null; a group without any
    value of any measure has no row.
    """
    measures = list({str(v): v for v, _ in wanted.values()}.items())
    number = {name: i for i, (name, _) in enumerate(measures)}
    each = F.array(*(F.struct(F.lit(i).alias("_m"), v.cast("double").alias("_v")) for i, (_, v) in enumerate(measures)))
    values = df.select(group_key(by).alias("_by"), F.explode(each).alias("x")).select("_by", "x._m", "x._v").filter("_v is not null")
    counts = values.groupBy("_by", "_m", "_v").agg(F.count("*").alias("_n"))
    ranged = counts.repartitionByRange("_by", "_m", "_v").withColumn("_range", F.spark_partition_id())
    kept = written(ranged, "quantile-counts")

    group = Window.partitionBy("_by", "_m")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = kept.groupBy("_by", "_m", "_range").agg(F.sum("_n").alias("_n"))
    ranges = ranges.withColumns({"_start": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_total": F.sum("_n").over(group)})
    asked = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(number[str(v)]).alias("m"), F.lit(float(p)).alias("p")) for name, (v, p) in wanted.items()))
    ranks = ranges.withColumn("q", F.explode(asked)).filter("q.m = _m").withColumn("at", F.col("q.p") * (F.col("_total") - 1))
    ranks = ranks.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))).filter("rank >= _start and rank < _start + _n")
    ranks = written(ranks.select("_by", "_m", "_range", "_start", "q.name", "at", "rank"), "quantile-ranks")

    within = Window.partitionBy("_by", "_m", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = kept.join(ranks.select("_by", "_m", "_range", "_start").distinct(), ["_by", "_m", "_range"])
    met = met.withColumn("_upto", F.col("_start") + F.sum("_n").over(within)).select("_by", "_m", "_range", "_v", "_n", "_upto")
    found = met.join(ranks.drop("_start"), ["_by", "_m", "_range"]).filter("rank < _upto and rank >= _upto - _n")
    low, high = F.min_by("_v", "rank"), F.max_by("_v", "rank")
    at, floor = F.max("at"), F.min("rank")
    exact = found.groupBy("_by", "name").agg(F.when(at == floor, low).otherwise((floor + 1 - at) * low + (at - floor) * high).alias("value"))
    return exact.groupBy("_by").agg(*(F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in wanted))


def with_quantiles(plain: DataFrame, df: DataFrame, by: list[str], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """``plain``, which has one row for each group of ``df``, with the columns of ``quantiles``."""
    return plain.withColumn("_by", group_key(by)).join(quantiles(df, by, wanted), "_by", "left").drop("_by")
