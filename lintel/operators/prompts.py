"""Prompt rendering from templates, and prompt statistics."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.functions.structures import approximate_tokens
from lintel.functions.text import stripped
from lintel.operators.quantiles import with_quantiles
from lintel.storage import written

RULE = "-" * 40
#: What a prompt is made of, in order; ``strategy`` and ``examples`` depend on the configuration.
PARTS = ("system", "task", "categories", "strategy", "examples", "input", "output")


def entry_block(entry: Column) -> Column:
    """A method's block from struct<name,body>."""
    return F.concat(F.lit("Method: "), entry["name"], F.lit("\n\n"), stripped(entry["body"]), F.lit(f"\n\n{RULE}"))


def helpers_section(entries: Column) -> Column:
    """Section 2 from array<struct<name,body>>; null when there is none."""
    body = F.array_join(F.transform(entries, entry_block), "\n\n")
    return F.when(F.size(entries) > 0, F.concat(F.lit("### 2. Helper Methods\n\n"), body))


def production_section(classes: Column) -> Column:
    """Section 4 from array<struct<name,methods>>; null when there is none."""
    one = lambda c: F.concat(F.lit("Class: "), c["name"], F.lit("\n\n"), F.array_join(F.transform(c["methods"], entry_block), "\n\n"))
    return F.when(F.size(classes) > 0, F.concat(F.lit("### 4. Production Code\n\n"), F.array_join(F.transform(classes, one), "\n\n")))


def text_section(title: str, text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit(f"{title}\n\n"), stripped(text)))


def input_section(code: Column, helpers: Column, log: Column, classes: Column, context: Column) -> Column:
    """Numbered sections; without context only the first; empty ones leave a gap in the numbers."""
    only = lambda c: F.when(context, c)
    return F.concat_ws("\n\n", F.lit("## Input"), text_section("### 1. Test Code", code), only(helpers_section(helpers)), only(text_section("### 3. Failure Log", log)), only(production_section(classes)))


def render(templates: dict[str, str], strategies: dict[str, str], examples: dict[bool, str], strategy: Column, context: Column, body: Column) -> Column:
    """The prompt; examples are part of the few-shot strategy alone."""
    pick = F.lit(None).cast("string")
    for name, text in strategies.items():
        pick = F.when(strategy == name, text).otherwise(pick)
    shown = F.when(strategy == "few_shot_cot", F.when(context, examples[True]).otherwise(examples[False]))
    return F.concat_ws("\n\n", F.lit(templates["system"]), F.lit(templates["task"]), F.lit(templates["categories"]), pick, shown, body, F.lit(templates["output"]))


def with_configs(df: DataFrame, configs: list[tuple], names: list[str]) -> DataFrame:
    """Every row with every configuration; the list of configurations is a literal of the caller's."""
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(c, names))) for c in configs))
    return df.withColumn("_c", F.explode(rows)).select(*df.columns, "_c.*")


def counted_tokens(df: DataFrame, prompt: str, count: Callable[[str], int] | None = None) -> DataFrame:
    """``tokens`` of every prompt: by the caller's tokenizer, which runs in Arrow batches, or without one by the length."""
    if count is None:
        return df.withColumn("tokens", approximate_tokens(F.col(prompt)))

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else float(count(t)) for t in texts.to_pylist()], pa.float64())

    return df.withColumn("tokens", run(F.col(prompt)))


def stats(df: DataFrame, prompt: str, by: list[str]) -> DataFrame:
    """Sizes of prompts by group, in characters and tokens; quantiles are exact."""
    rows = written(df.select(*by, F.length(prompt).alias("_s"), approximate_tokens(F.col(prompt)).alias("_t")), "prompt-sizes")
    plain = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("_s").alias("min_chars"), F.max("_s").alias("max_chars"), F.avg("_s").alias("mean_chars"), F.stddev_samp("_s").alias("std_chars"), F.sum("_t").alias("tokens"))
    s, t = F.col("_s"), F.col("_t")
    out = with_quantiles(plain, rows, by, {"median_chars": (s, 0.5), "p95_tokens": (t, 0.95), "p99_tokens": (t, 0.99)})
    r = lambda name: F.round(name, 4).alias(name)
    return out.select(*by, "n", "min_chars", "max_chars", r("mean_chars"), r("median_chars"), r("std_chars"), r("p95_tokens"), r("p99_tokens"), r("tokens"))


def window_fit(df: DataFrame, tokens: Column, window: str, by: list[str]) -> DataFrame:
    """How many prompts fit into a model's window."""
    fits = tokens <= F.col(window)
    t = df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(fits).alias("fits"), F.round(F.max(tokens / F.col(window)) * 100, 4).alias("max_utilisation"))
    return t.withColumn("exceeds", F.col("n") - F.col("fits")).withColumn("fit_percent", F.round(F.col("fits") * 100.0 / F.col("n"), 4))
