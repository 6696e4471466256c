"""Scoring, balancing, sampling, representative choice, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.functions.structures import has_content, is_empty_text
from lintel.operators.quantiles import group_key, quantiles


def context_score(df: DataFrame, helpers: Column, code: Column, log: Column) -> DataFrame:
    """Flags of what a case has, and 2 for helpers, 2 for code and 1 for a log."""
    flags = df.withColumn("has_helper_methods", has_content(helpers)).withColumn("has_code_under_test", has_content(code)).withColumn("has_failure_log", has_content(log))
    i = lambda c: F.col(c).cast("int")
    return flags.withColumn("context_score", 2 * i("has_helper_methods") + 2 * i("has_code_under_test") + i("has_failure_log"))


def hash_order(key: str, seed: int) -> Column:
    """A seeded order that other engines can repeat."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed).cast("string")))


def balance(df: DataFrame, positive: str, score: str, key: str = "id") -> DataFrame:
    """All positives and as many of the best negatives; ties go to the lower id, rows without a score are not taken.

    Negatives are numbered within ranges of the order, so neither all of them nor those at the cut meet in one task.
    """
    wanted = df.agg(F.count_if(F.col(positive)).alias("_want"))
    negatives = df.filter(~F.col(positive) & F.col(score).isNotNull()).withColumn("_low", -F.col(score))
    best = numbered(negatives, [], ["_low", key], "_r").join(F.broadcast(wanted)).filter("_r <= _want")
    return df.filter(positive).unionByName(best.select(*df.columns))


def sample(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """A seeded sample of ``n`` rows, the same on every run."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def representative(df: DataFrame, features: list[str], by: str, key: str = "id") -> DataFrame:
    """distance_from_median (sum over features of |x - median| / median) and its rank within a class."""
    medians = quantiles(df, [], {f"_m_{f}": (F.col(f), 0.5) for f in features})
    # One row, or none if no feature has a value.
    out = df.withColumn("_by", group_key([])).join(F.broadcast(medians), "_by", "left").drop("_by")
    distance = sum((F.coalesce(F.try_divide(F.abs(F.col(f) - F.col(f"_m_{f}")), F.col(f"_m_{f}")), F.lit(0.0)) for f in features), F.lit(0.0))
    out = out.withColumn("distance_from_median", F.round(distance, 9)).drop(*(f"_m_{f}" for f in features))
    return numbered(out, [by], ["distance_from_median", key], "rank")


def without(df: DataFrame, other: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key the other table does not have."""
    return df.join(other.select(key), key, "left_anti")


def upsert(base: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """``fresh`` rows in place of those with their key."""
    return base.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def element(df: DataFrame, value, key: str = "id") -> DataFrame:
    """The rows of one key; there is no position to ask for in a table without an order."""
    return df.filter(F.col(key) == value)


def in_numeric_order(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows in the order of a key that is a number written as text."""
    return df.orderBy(F.col(key).cast("long"))


def numbered(df: DataFrame, by: list[str], order: list[str], out: str, total: str | None = None) -> DataFrame:
    """Rows with their number (from 1) within ``by`` in the order of ``order``, and the number of rows there as ``total``.

    Rows are numbered within ranges and a range's start is added, so no task sees
    a whole group.
    """
    from lintel.storage import written

    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    kept = written(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    starts = kept.groupBy("_range", *by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(F.col("_range").alias("_range2"), *(F.col(c).alias(f"_by_{c}") for c in by), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(group).alias("_total"))
    same = F.col("_range") == F.col("_range2")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    named = kept.join(starts, same).withColumn(out, F.col("_start") + F.col("_at") - F.col("_first") + 1)
    return named.select(*df.columns, out, *([F.col("_total").alias(total)] if total else []))


def renumbered(parts: list[DataFrame], key: str, out: str = "id") -> DataFrame:
    """Parts one after the other with ids 1..N in the order of part and key.

    Rows are counted by range of the order, and numbered within ranges: no task
    sees more than a range.
    """
    all_ = parts[0].withColumn("_part", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        all_ = all_.unionByName(part.withColumn("_part", F.lit(i)))
    ranged = all_.repartitionByRange("_part", key).sortWithinPartitions("_part", key)
    ranged = ranged.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    from lintel.storage import written

    kept = written(ranged, "renumbered")
    starts = kept.groupBy("_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    out_id = (F.col("_start") + F.col("_at") - F.col("_first") + 1).cast("long")
    return kept.join(F.broadcast(starts), "_range").withColumn(out, out_id).drop("_part", "_range", "_at", "_first", "_start")


def require_empty(df: DataFrame, message: str) -> None:
    """Stop if there is any row."""
    first = df.head(1)
    if first:
        raise ValueError(f"{message}: {first[0].asDict()}")


def filled_only(df: DataFrame, column: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows still to do, rows already filled)."""
    todo = is_empty_text(F.col(column)) | F.lit(force)
    return df.filter(todo), df.filter(~todo)
