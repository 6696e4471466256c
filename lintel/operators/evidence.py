"""Evidence artefacts and reasoning themes over predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lintel.functions.text import THEMES, evidence_label, has_theme

OTHER = "Other"


def labelled(df: DataFrame, evidence: str = "evidence") -> DataFrame:
    """``labels``: the artefact of every entry; a missing list is empty."""
    entries = F.coalesce(F.col(evidence), F.array().cast("array<string>"))
    return df.withColumn("labels", F.transform(entries, evidence_label))


def frequency(df: DataFrame, *by: str) -> DataFrame:
    """How often each artefact is named; repeats within a row count."""
    return labelled(df).select(*by, F.explode("labels").alias("artefact")).groupBy(*by, "artefact").agg(F.count("*").alias("n"))


def by_outcome(df: DataFrame, correct) -> DataFrame:
    rows = labelled(df).select(correct.alias("ok"), F.explode("labels").alias("artefact"))
    t = rows.groupBy("artefact").agg(F.count("*").alias("n"), F.count_if("ok").alias("correct"), F.count_if(~F.col("ok")).alias("incorrect"))
    return t.withColumn("rate", F.round(F.col("correct") * 100.0 / F.col("n"), 4))


def combinations(df: DataFrame) -> DataFrame:
    """Sets of named artefacts, joined by " + ", with their share; rows that name none are left out."""
    named = F.array_sort(F.array_distinct(F.filter("labels", lambda l: l != OTHER)))
    rows = labelled(df).select(named.alias("s")).filter(F.size("s") > 0).groupBy(F.array_join("s", " + ").alias("combination")).agg(F.count("*").alias("n"))
    return rows.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


def utilisation(df: DataFrame, *by: str) -> DataFrame:
    """Share of rows that name an artefact at least once; the denominator is all rows of a group."""
    rows = labelled(df)
    total = rows.groupBy(*by).agg(F.count("*").alias("rows"))
    used = rows.select(*by, F.explode(F.array_distinct(F.filter("labels", lambda l: l != OTHER))).alias("artefact")).groupBy(*by, "artefact").agg(F.count("*").alias("n"))
    joined = used.join(total, list(by)) if by else used.join(F.broadcast(total))  # one row
    return joined.withColumn("percent", F.round(F.col("n") * 100.0 / F.col("rows"), 4))


def unmatched(df: DataFrame, limit: int = 50) -> DataFrame:
    """The first raw labels, in order, that match no artefact."""
    rows = df.select(F.explode("evidence").alias("label")).filter(evidence_label(F.col("label")) == OTHER)
    return rows.distinct().orderBy("label").limit(limit)


def themes(df: DataFrame, reasoning: str = "reasoning") -> DataFrame:
    """theme, n, percent over all rows given."""
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(has_theme(F.col(reasoning), t)).alias(t) for t in THEMES))
    return one.unpivot(["_n"], list(THEMES), "theme", "n").select("theme", "n", F.round(F.coalesce(F.try_divide(F.col("n") * 100.0, F.col("_n")), F.lit(0.0)), 4).alias("percent"))
