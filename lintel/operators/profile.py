"""Profiling and cleaning of case tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.functions.structures import percent
from lintel.functions.text import LOG_PATTERNS
from lintel.operators.quantiles import with_quantiles

#: Upper ends of the size bins, each included; fixed values.
BINS = [("<10K", 10_000), ("10K–25K", 25_000), ("25K–50K", 50_000), ("50K–100K", 100_000), ("100K–250K", 250_000), (">250K", None)]


def _long(one: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    return one.unpivot([], names, key, value)


def null_counts(df: DataFrame) -> DataFrame:
    """column, nulls, percent for every column, in one pass."""
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return one.unpivot(["_n"], df.columns, "column", "nulls").select("column", "nulls", percent(F.col("nulls"), F.col("_n"), 4).alias("percent"))


def duplicate_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that repeat an earlier row's keys; nulls are equal."""
    named = [F.coalesce(F.col(k).cast("string"), F.lit("\0null")) for k in keys]
    return df.agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct(*named)).alias("duplicates"))


def value_counts(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), digits))


def availability(df: DataFrame, sources: dict[str, Column]) -> DataFrame:
    """source, available, empty, percent; sources: name -> whether a row has it."""
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(has).alias(name) for name, has in sources.items()))
    out = one.unpivot(["_n"], list(sources), "source", "available")
    return out.select("source", "available", (F.col("_n") - F.col("available")).alias("empty"), percent(F.col("available"), F.col("_n"), 4).alias("percent"))


def describe(df: DataFrame, value: Column, by=(), digits: int = 4) -> DataFrame:
    """count, min, quartiles, 95 %, mean, max and sample standard deviation, all exact."""
    rows, v = df.withColumn("_v", value), F.col("_v")
    plain = rows.groupBy(*by).agg(F.count("_v").alias("count"), F.min("_v").alias("min"), F.avg("_v").alias("mean"), F.max("_v").alias("max"), F.stddev_samp("_v").alias("std"))
    out = with_quantiles(plain, rows, list(by), {"q25": (v, 0.25), "median": (v, 0.5), "q75": (v, 0.75), "q95": (v, 0.95)})
    r = lambda name: F.round(name, digits).alias(name)
    return out.select(*by, "count", "min", r("q25"), r("median"), r("mean"), r("q75"), r("q95"), "max", r("std"))


def size_bins(df: DataFrame, size: Column) -> DataFrame:
    """bin_no, bin, n, percent; right-closed bins, empty ones kept."""
    ladder = F
    for i, (_, top) in enumerate(BINS):
        ladder = ladder.when(size <= top, i) if top else ladder.otherwise(i)
    counts = df.select(ladder.alias("bin_no")).groupBy("bin_no").agg(F.count("*").alias("n"))
    names = df.sparkSession.range(len(BINS)).select(F.col("id").cast("int").alias("bin_no"), F.element_at(F.array(*(F.lit(b) for b, _ in BINS)), (F.col("id") + 1).cast("int")).alias("bin"))
    out = names.join(counts, "bin_no", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("percent", percent(F.col("n"), F.sum("n").over(Window.partitionBy()), 4))


def pattern_counts(df: DataFrame, log: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """pattern, n, percent: rows whose log has the pattern in any case."""
    patterns = patterns or LOG_PATTERNS
    text = F.coalesce(F.col(log), F.lit(""))
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(text.rlike(f"(?i){p}")).alias(name) for name, p in patterns.items()))
    return one.unpivot(["_n"], list(patterns), "pattern", "n").select("pattern", "n", percent(F.col("n"), F.col("_n"), 4).alias("percent"))


def correlations(df: DataFrame, columns: dict[str, Column], digits: int = 6) -> DataFrame:
    """a, b, r for every two of the columns."""
    names = list(columns)
    wide = df.select(*(c.cast("double").alias(n) for n, c in columns.items()))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    one = wide.agg(*(F.round(F.corr(a, b), digits).alias(f"{a}|{b}") for a, b in pairs))
    out = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    return out.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "r")


def reduction(df: DataFrame, before: str, after: str, digits: int = 4) -> DataFrame:
    """What a cleaning step took off: mean sizes, share of all characters, modified rows."""
    b, a = F.length(before), F.length(after)
    changed = ~F.col(before).eqNullSafe(F.col(after))
    return df.agg(
        F.count("*").alias("n"),
        F.round(F.avg(b), digits).alias("mean_before"),
        F.round(F.avg(a), digits).alias("mean_after"),
        F.round(F.avg(b - a), digits).alias("mean_reduction"),
        F.round(F.coalesce(F.try_divide(F.sum(b - a) * 100.0, F.sum(b)), F.lit(0.0)), digits).alias("reduction_percent"),
        F.count_if(changed).alias("modified"),
        F.round(F.count_if(changed) * 100.0 / F.count("*"), digits).alias("modified_percent"),
    )


def scaled(df: DataFrame, parts: tuple[str, ...], by: float = 100.0) -> DataFrame:
    """``df`` with every column times ``by`` whose name holds one of ``parts``."""
    return df.select(*((F.col(f"`{c}`") * by).alias(c) if any(p in c for p in parts) else F.col(f"`{c}`") for c in df.columns))


def split_column(df: DataFrame, column: str, first: str, rest: str) -> DataFrame:
    """The first word of a column and what follows it, as two columns in its place."""
    parts = F.split(column, " ", 2)
    return df.select(*(c for c in df.columns if c != column), parts[0].alias(first), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias(rest))


def schema_difference(df: DataFrame, expected: list[str]) -> DataFrame:
    """column, state (missing or extra)."""
    rows = [(c, "missing") for c in expected if c not in df.columns] + [(c, "extra") for c in df.columns if c not in expected]
    return df.sparkSession.createDataFrame(rows, "column string, state string")


def schema_listing(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def record_schema(df: DataFrame, json: str, expected: list[str]) -> DataFrame:
    """field, what, n: over the JSON objects of a column, the rows in which a field has a type, and in which an expected one is missing.

    Types are number, string, boolean, list, object and null; fields that aren't
    expected are marked ``extra`` in ``state``.  Rows that hold no object count as
    rows without any field.
    """
    objects = df.select(F.try_parse_json(json).alias("v"))
    # A field's type is that of its value, so it is looked up row by row and not assumed from a first row.
    fields = objects.select(F.map_entries(F.try_variant_get("v", "$", "map<string,variant>")).alias("e")).select(F.explode("e").alias("e"))
    kind = F.schema_of_variant("e.value")
    type_ = F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "object").otherwise("number")
    counts = fields.select(F.col("e.key").alias("field"), type_.alias("what")).groupBy("field", "what").agg(F.count("*").alias("n"))
    # One row for each expected field.
    names = df.sparkSession.createDataFrame([(c,) for c in expected], "field string")
    rows = df.agg(F.count("*").alias("rows"))
    there = counts.groupBy("field").agg(F.sum("n").alias("there"))
    missing = names.withColumn("_one", F.lit(1)).join(F.broadcast(rows.withColumn("_one", F.lit(1))), "_one").join(there, "field", "left")
    missing = missing.select("field", F.lit("missing").alias("what"), (F.col("rows") - F.coalesce("there", F.lit(0))).alias("n")).filter("n > 0")
    state = F.when(F.col("field").isin(expected), "expected").otherwise("extra")
    return counts.unionByName(missing).withColumn("state", state)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows, as often."""
    return not a.exceptAll(b).head(1) and not b.exceptAll(a).head(1)
