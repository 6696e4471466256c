"""Results as files, written by Spark's own writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lintel.operators.select import require_empty


def to_json_lines(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """The named columns in order; one that ``df`` lacks is written as the empty text."""
    df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns]).write.mode(mode).option("ignoreNullFields", False).json(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, empty maps and lists as the empty text."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, MapType | ArrayType):
            column = F.when(F.size(column) > 0, F.to_json(column)).otherwise("")
        elif isinstance(field.dataType, StructType):
            column = F.coalesce(F.to_json(column), F.lit(""))
        out.append(column.alias(field.name))
    return df.select(*out)


def to_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat(df).write.mode(mode).option("escape", '"').csv(path, header=True)


def to_parts(df: DataFrame, path: str, by: tuple[str, ...] = ("model", "prompt_type", "context_enabled"), mode: str = "overwrite") -> None:
    """A folder for each value of ``by``; replaces only the parts that ``df`` has."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def to_new(df: DataFrame, path: str, skip: bool = False) -> None:
    """Never over what exists: raises, or with ``skip`` leaves it alone."""
    df.write.mode("ignore" if skip else "errorifexists").json(path)


def to_texts(df: DataFrame, path: str, name: str, text: str, mode: str = "overwrite") -> None:
    """A folder for each value of ``name`` with its text."""
    df.select(name, F.col(text).alias("value")).write.mode(mode).partitionBy(name).text(path)


def to_one(spark: SparkSession, parts: list[str], path: str) -> None:
    """The lines of several sets of files as one set."""
    spark.read.text(parts).write.text(path)


def to_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def verified(df: DataFrame, again: DataFrame) -> None:
    """Raises unless both have the same columns and the same rows, repeated ones as often."""
    if df.columns != again.columns:
        raise ValueError(f"columns differ: {df.columns} and {again.columns}")
    require_empty(df.exceptAll(again), "rows are missing")
    require_empty(again.exceptAll(df), "rows are added")
