"""Raw inputs as DataFrames: JSON Lines, CSV, archives, reports, coverage and whole texts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.functions.text import is_framework_class
from lintel.operators.select import require_empty
from lintel.sources import archives
from lintel.sources.records import csv_records
from lintel.storage import written

COVERAGE = "_name string, class array<struct<_name:string,method:array<struct<_name:string,counter:array<struct<_type:string,_covered:long>>>>>>"
ROUND_RESULTS = "struct<results:map<string,struct<result:string,stackTrace:array<string>>>>"
#: Endings of test classes, and methods that are no targets; fixed values.
TEST_ENDINGS = ("Test", "Tests", "TestCase", "Spec")
NO_TARGETS = ("<init>", "<clinit>")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON Lines; blank lines are skipped and a missing path gives an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_tree(spark: SparkSession, root: str, schema: str, levels: tuple[str, ...] = ("model", "prompt_type", "context")) -> DataFrame:
    """All JSON Lines files below ``root``, with the names of the folders right above the file as columns ``levels``."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json(root)
    folders = F.split(F.col("_metadata.file_path"), "/")
    return rows.select("*", *[F.element_at(folders, i - len(levels) - 1).alias(name) for i, name in enumerate(levels)])


def require_parts(df: DataFrame, expected: DataFrame) -> None:
    """Raises if a row of ``expected`` (the level columns) has no rows in ``df``."""
    require_empty(expected.join(df.select(*expected.columns).distinct(), expected.columns, "left_anti"), "missing parts")


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file."""
    return spark.read.schema(schema).json(path, multiLine=True)


def csv_rows(spark: SparkSession, path: str, lossy: bool = False) -> DataFrame:
    """CSV with a header; names and fields are trimmed, absent fields empty, bytes that are no UTF-8 replaced.

    lossy: such bytes are left out, and so are replacement characters.
    """
    df = spark.read.csv(path, header=True, escape='"', multiLine=True, maxCharsPerColumn=-1)
    whole = lambda c: F.replace(c, F.lit("\ufffd"), F.lit("")) if lossy else c
    return df.select(*[F.trim(whole(F.coalesce(F.col(f"`{c}`"), F.lit("")))).alias(c.strip()) for c in df.columns])


def first_fields(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The first fields of comma-separated lines without a header; lines with fewer fields than ``names`` go."""
    parts = F.split(F.trim("value"), ",")
    return spark.read.text(path).filter(F.size(parts) >= len(names)).select(*[F.trim(parts[i]).alias(name) for i, name in enumerate(names)])


def csv_fields(line: Column) -> Column:
    """array<string>: the fields of one CSV line of any length, without quotes."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',(?:"(?:[^"]++|"")*+"|[^,]*+)'), F.lit(0))
    return F.transform(fields, lambda f: F.when(f.startswith(',"'), F.replace(F.regexp_replace(f, r'\A,"|"\z', ""), F.lit('""'), F.lit('"'))).otherwise(F.substr(f, F.lit(2))))


def round_results(spark: SparkSession, path: str) -> DataFrame:
    """(round, status, test, result, trace) from ragged records, quoted line breaks and all: the first field from the fourth on that is a JSON object."""
    rows = csv_records(spark, path).select(F.col("fields").alias("f"))
    objects = F.filter("f", lambda x, i: (i >= 3) & F.trim(x).startswith("{") & F.trim(x).endswith("}"))
    found = rows.select(F.trim(F.get("f", F.lit(0))).alias("round"), F.trim(F.get("f", F.lit(1))).alias("status"), F.from_json(F.get(objects, F.lit(0)), ROUND_RESULTS).alias("o"))
    each = found.select("round", "status", F.explode("o.results").alias("test", "r"))
    return each.select("round", "status", "test", "r.result", F.array_join("r.stackTrace", "\n").alias("trace"))


def zip_entries(spark: SparkSession, path: str, named: str = "*.zip") -> DataFrame:
    """(archive, entry, content) of all archives below ``path``; what is no archive gives no rows.

    Members of one archive are read by as many tasks as they make ranges.
    """
    return archives.with_content(archives.members(spark, path, named))


def found_sources(wanted: DataFrame, entries: DataFrame) -> DataFrame:
    """``wanted`` (archive, version, class) with the entries of its outer class in that version's folder."""
    outer = F.translate(F.regexp_replace("class", r"\$.*", ""), ".", "/")
    met = archives.matched(wanted.withColumn("file", outer), entries.filter(F.col("entry").rlike(r"\.(?:java|groovy)\z")))
    return met.filter(F.expr("contains(entry, concat('/', version, '/'))")).drop("file")


def wanted_sources(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``found_sources`` of the archives below ``path``, whose other members aren't read."""
    found = written(found_sources(wanted, archives.members(spark, path)), "sources-found")
    content = archives.with_content(found.select(*(c.split()[0] for c in archives.MEMBERS.split(", "))))
    return found.select(*wanted.columns, "entry").join(content, ["archive", "entry"])


def whole_texts(spark: SparkSession, path: str | list[str], named: str = "*.txt") -> DataFrame:
    """(path, text) of all files below ``path``.  Spark passes over folders whose names start with a dot; name those as paths."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", named).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def reports(texts: DataFrame, simple_class: str) -> DataFrame:
    """Report files of a class, from ``whole_texts``: in report folders, without the output files."""
    path = F.col("path")
    return texts.filter(path.rlike(r"/(surefire-reports|\.nondex)/") & path.endswith(f"{simple_class}.txt") & ~path.endswith("-output.txt"))


def covered_methods(spark: SparkSession, path: str, test_class: str) -> DataFrame:
    """(class, method) that a coverage report marks as run, without tests, frameworks and initialisers."""
    packages = spark.read.format("xml").schema(COVERAGE).option("rowTag", "package").load(path)
    classes = packages.select(F.explode("class").alias("c")).select(F.translate("c._name", "/", ".").alias("class"), F.explode("c.method").alias("m"))
    ran = F.exists("m.counter", lambda c: c["_type"].isin("METHOD", "INSTRUCTION") & (c["_covered"] > 0))
    name = F.col("class")
    test = (name == test_class) | name.startswith(f"{test_class}$")
    for ending in TEST_ENDINGS:
        test = test | name.endswith(ending)
    rows = classes.filter(ran & ~test & ~is_framework_class(name)).select("class", F.col("m._name").alias("method"))
    return rows.filter(~F.col("method").isin(*NO_TARGETS)).distinct()
