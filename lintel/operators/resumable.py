"""A batch stage that goes on where it stopped.

The input is written once, dealt to ranges of its key's hash.  Each range is one
job, whose output is a folder named by the range; only when that is complete does
the ledger get a row.  A new run with the same folder takes the ranges that the
ledger lacks and writes over whatever a broken run has left of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "part int, parts int, key string, rows long"


def _there(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at that place, on any file system that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``LEDGER``: the ranges that are complete."""
    found = f"{path}/ledger"
    return spark.read.schema(LEDGER).json(found) if _there(spark, found) else spark.createDataFrame([], LEDGER)


def resumable(df: DataFrame, key: str, stage: Callable[[DataFrame], DataFrame], path: str, parts: int = 16) -> DataFrame:
    """``stage`` over ``df``, a range of keys after the other; rows of one key are in one range.

    df is read only if the folder has no complete input yet, so a second run sees the
    rows of the first.  The number of ranges and the key must be those of the first
    run.  Null keys are in one range; a range without rows is run as well.
    """
    spark = df.sparkSession
    if not _there(spark, f"{path}/input/_SUCCESS"):
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        # A range goes to a few tasks, whatever its keys.
        dealt = df.withColumn("_part", part).withColumn("_deal", F.spark_partition_id() % 8).repartition("_part", "_deal").drop("_deal")
        dealt.write.mode("overwrite").partitionBy("_part").parquet(f"{path}/input")
    done = {r.part: r for r in ledger(spark, path).collect()}  # a row for each range
    if any(r.parts != parts or r.key != key for r in done.values()):
        raise ValueError(f"{path} is of a run with other ranges: {next(iter(done.values()))}")
    schema = None
    for part in range(parts):
        place = f"{path}/output/part={part}"
        if part not in done:
            there = f"{path}/input/_part={part}"
            rows = spark.read.schema(df.schema).parquet(there) if _there(spark, there) else spark.createDataFrame([], df.schema)
            out = stage(rows)
            out.write.mode("overwrite").parquet(place)
            schema = out.schema
            spark.createDataFrame([(part, parts, key, spark.read.parquet(place).count())], LEDGER).coalesce(1).write.mode("append").json(f"{path}/ledger")
    schema = schema or spark.read.parquet(f"{path}/output/part=0").schema
    return spark.read.schema(schema).parquet(*(f"{path}/output/part={part}" for part in range(parts)))
