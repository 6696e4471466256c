"""The shared folder for tables that cut lineage.

Every intermediate table is an ordinary Parquet table below the folder named by
``spark.checkpoint.dir``, so it outlives the executor that wrote it.  A folder
of our own is used only when the session names none and runs on one machine.
Tables belong to a run, which ``scratch`` names and removes when it ends.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULT = "file:///tmp/checkpoints/lintel"
_run: ContextVar[str | None] = ContextVar("run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder: ``spark.checkpoint.dir``, or on a local master our own; raises on a cluster that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or LOCAL_DEFAULT).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    run = _run.get()
    return "/".join(x for x in (shared_dir(spark), run, f"{name}-{uuid.uuid4().hex}") if x)


@contextmanager
def scratch(spark: SparkSession):
    """Whatever is written within goes at the end; results that are needed longer must be written elsewhere before."""
    name = f"run-{uuid.uuid4().hex}"
    token = _run.set(name)
    try:
        yield
    finally:
        _run.reset(token)
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
