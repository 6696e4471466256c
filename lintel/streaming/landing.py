"""Replies that land in a folder, followed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landed(spark: SparkSession, path: str, schema: str, files: int | None = None) -> DataFrame:
    """JSON Lines files as they arrive, at most ``files`` in a batch, with their arrival as ``landed_at``."""
    reader = spark.readStream.schema(schema)
    rows = (reader.option("maxFilesPerTrigger", files) if files else reader).json(path)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def first_replies(rows: DataFrame, key: str, time: str = "landed_at", delay: str = "1 day") -> DataFrame:
    """One reply a key; keys are forgotten once the watermark has passed them."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts(rows: DataFrame, time: str, width: str, by: list[str], delay: str = "1 hour") -> DataFrame:
    """Rows by window of ``time`` and ``by``; rows later than the watermark are left out."""
    grouped = rows.withWatermark(time, delay).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))
    return grouped.select(F.col("window.start").alias("start"), *by, "n")


def drain(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes all that has landed as Parquet; a later call with the same checkpoint goes on from there."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
