"""op6: all documents in 40 shards of near equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.shards import shard
from lintel.storage import table

SHARDS = 40


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"), SHARDS)
    return out.withColumn("grown_shard", F.lit(None).cast("int"))


QUERIES = {"op6_sharding": op6_sharding}
SQL: dict[str, str] = {}
