"""Maps, arrays, JSON and numbers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODEL_OUTPUT = "struct<classification:string,category:string,reasoning:string,evidence:array<string>>"


def map_size(m: Column) -> Column:
    return F.coalesce(F.size(m), F.lit(0))


def nested_count(m: Column) -> Column:
    """Entries over all inner maps."""
    return F.coalesce(F.aggregate(F.map_values(m), F.lit(0), lambda n, x: n + F.size(x)), F.lit(0))


def nested_chars(m: Column) -> Column:
    """Characters over all inner maps' values."""
    inner = lambda x: F.aggregate(F.map_values(x), F.lit(0), lambda n, t: n + F.coalesce(F.length(t), F.lit(0)))
    return F.coalesce(F.aggregate(F.map_values(m), F.lit(0), lambda n, x: n + inner(x)), F.lit(0))


def nested_blank(m: Column) -> Column:
    """Inner values that are null or blank."""
    inner = lambda x: F.size(F.filter(F.map_values(x), lambda t: F.trim(F.coalesce(t, F.lit(""))) == ""))
    return F.coalesce(F.aggregate(F.map_values(m), F.lit(0), lambda n, x: n + inner(x)), F.lit(0))


def mapped(m: Column, change) -> Column:
    return F.transform_values(m, lambda _, v: change(v))


def nested_mapped(m: Column, change) -> Column:
    return F.transform_values(m, lambda _, x: F.transform_values(x, lambda _, v: change(v)))


def same_keys(a: Column, b: Column) -> Column:
    return F.sort_array(F.map_keys(a)).eqNullSafe(F.sort_array(F.map_keys(b)))


def spaced_json_length(m: Column) -> Column:
    """Length of a flat map as JSON with a blank after each comma and colon."""
    return F.length(F.to_json(m)) + F.when(F.size(m) > 0, 2 * F.size(m) - 1).otherwise(0)


def has_content(value: Column) -> Column:
    """Whether a text holds more than blanks or an empty JSON list or object; null does not."""
    t = F.coalesce(value, F.lit(""))
    return t.rlike(r"\S") & ~t.rlike(r"\A\s*(\[\s*\]|\{\s*\})\s*\z")


def is_empty_map(m: Column) -> Column:
    """Whether a typed map is null or has no entries."""
    return F.coalesce(F.size(m), F.lit(0)) <= 0


def is_empty_text(value: Column) -> Column:
    return ~F.coalesce(value, F.lit("")).rlike(r"\S")


def once(value: Column) -> Column:
    """``value``, which the optimizer may neither repeat nor move: to it, the partition's number is not deterministic."""
    return F.when(F.spark_partition_id() >= 0, value)


def parsed_object(text: Column, schema: str = MODEL_OUTPUT) -> Column:
    """The struct of a text that is exactly one JSON object, else null."""
    found = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{schema}>", {"allowSingleQuotes": "false"})
    only = F.transform(F.array(found), lambda f: F.when(F.size(f) == 1, F.get(f, F.lit(0))))
    return F.when(text.rlike(r"(?s)\A\s*\{.*\}\s*\z"), F.get(only, F.lit(0)))


def recovered_fields(text: Column, categories: list[str]) -> Column:
    """struct<classification,category,reasoning,evidence,error> pulled out of a broken JSON reply by field."""
    field = lambda name: F.nullif(F.regexp_extract(text, rf'"{name}"\s*:\s*"([^"]*)"', 1), F.lit(""))
    said, category = field("classification"), field("category")
    reason = r'(?s)"reasoning"\s*:\s*"(.*?)"\s*,\s*"evidence"\s*:'
    reasoning = F.when(text.rlike(reason), F.regexp_extract(text, reason, 1)).otherwise(text)
    error = (
        F.when(~F.coalesce(said, F.lit("")).isin("Flaky", "Non-Flaky"), "invalid classification")
        .when(~F.coalesce(category, F.lit("")).isin(categories), "invalid category")
        .when((said == "Non-Flaky") & (category != "Non-Flaky"), "category of a Non-Flaky reply")
        .when((said == "Flaky") & (category == "Non-Flaky"), "category of a Flaky reply")
    )
    return F.struct(said.alias("classification"), category.alias("category"), reasoning.alias("reasoning"), F.array().cast("array<string>").alias("evidence"), error.alias("error"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def percent(a: Column, b: Column, digits: int = 2) -> Column:
    return F.round(ratio(a, b) * 100, digits)


def wald_half_width(p: Column, n: Column) -> Column:
    """Half of a 95 % interval, in the unit of ``p`` (0 to 1)."""
    return 1.96 * F.sqrt(F.try_divide(p * (1 - p), n))


def approximate_tokens(text: Column) -> Column:
    return F.length(text) / 4


def line_bytes(text: Column) -> Column:
    return F.octet_length(text) + 1
