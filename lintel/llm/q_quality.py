"""op5: a quality score of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.quality import learned, scored
from lintel.storage import table

#: Scores from here on are predicted to be good.
LEAST_SCORE = 0.3


def held_out(key: Column, parts: int) -> Column:
    """Whether the crc32 of the key as text is divisible by ``parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts == 0


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = learned(docs, labels.filter(~held_out(F.col("doc_id"), 5)))
    out = scored(docs.select("doc_id", "text"), trees)
    return out.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
SQL: dict[str, str] = {}
