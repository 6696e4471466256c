"""Requests, replies, and recovery of missing or broken replies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.functions.structures import once, parsed_object, recovered_fields
from lintel.functions.text import CATEGORIES, unfenced
from lintel.operators.select import require_empty
from lintel.storage import written

FIELDS = ("classification", "category", "reasoning", "evidence")


def parse(df: DataFrame, raw: str = "raw") -> DataFrame:
    """``output`` (struct or null) and ``error`` of each reply: it must be one JSON object, fences aside."""
    out = df.withColumn("output", once(parsed_object(unfenced(F.col(raw)))))
    return out.withColumn("error", F.when(F.col("output").isNull(), "not a JSON object"))


def recover(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Like ``parse``; a reply that fails is read field by field, and its error is that of the fields."""
    out = parse(df, raw).withColumn("_f", once(F.when(F.col("output").isNull(), recovered_fields(F.col(raw), CATEGORIES)))).withColumn("recovered", F.col("output").isNull() & F.col("_f.error").isNull())
    fields = F.struct(*(F.col(f"_f.{f}").alias(f) for f in FIELDS))
    return out.withColumn("error", F.when(F.col("output").isNull(), F.col("_f.error"))).withColumn("output", F.coalesce("output", F.when(F.col("recovered"), fields))).drop("_f")


def retry_set(requests: DataFrame, failed: DataFrame, key: str = "sample_id") -> DataFrame:
    """The requests of failed replies; stops if one has no request."""
    require_empty(failed.join(requests, key, "left_anti").select(key), "failed replies without a request")
    return requests.join(failed.select(key), key, "left_semi")


def merge_recovered(base: DataFrame, fresh: DataFrame, expected: DataFrame, key: str = "sample_id", complete: bool = True) -> DataFrame:
    """Good replies and recovered ones; stops on overlap, repeats, strangers, and, if ``complete``, gaps.

    Keys grow with the replies, so the joins deal both sides: none goes through the driver.
    """
    require_empty(base.join(fresh.select(key).hint("merge"), key, "left_semi").select(key), "recovered although present")
    both = base.unionByName(fresh)
    require_empty(both.groupBy(key).count().filter("count > 1"), "repeated replies")
    require_empty(both.join(expected.select(key).hint("merge"), key, "left_anti").select(key), "replies to nothing")
    if complete:
        require_empty(expected.join(both.select(key).hint("merge"), key, "left_anti").select(key), "replies still missing")
    return both


def fill_missing(predictions: DataFrame, cases: DataFrame, key: str = "sample_id") -> DataFrame:
    """Non-Flaky rows, marked ``is_filled``, for cases without a prediction."""
    filled = cases.join(predictions, key, "left_anti").select(key, F.lit("Non-Flaky").alias("predicted"), F.lit(True).alias("is_filled"))
    return predictions.select(key, "predicted", F.lit(False).alias("is_filled")).unionByName(filled)


def joined_parts(parts: Column, kind: str = "output_text") -> Column:
    """The texts of a reply's parts of one kind, put together."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == kind), lambda p: p["text"]), "")


def error_text(error: Column) -> Column:
    """code: message (param) of a struct<code,message,param>; missing parts left out."""
    return F.concat_ws("", F.concat_ws(": ", error["code"], error["message"]), F.when(error["param"].isNotNull(), F.concat(F.lit(" ("), error["param"], F.lit(")"))))


def sample_name(key: Column) -> Column:
    text = key.cast("string")
    return F.when(text.startswith("sample_"), text).otherwise(F.concat(F.lit("sample_"), text))


def request_lines(df: DataFrame, key: str, prompt: str, model: str, max_tokens: int) -> DataFrame:
    """``line``: one JSON request for each row."""
    body = F.struct(F.lit(model).alias("model"), F.col(prompt).alias("input"), F.lit(max_tokens).alias("max_output_tokens"))
    return df.withColumn("line", F.to_json(F.struct(sample_name(F.col(key)).alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), body.alias("body"))))


def submit_by_halves(requests: DataFrame, submit: Callable[[DataFrame], bool], key: str = "sample_id") -> list:
    """Submit all; what fails is halved by the hash of the key and tried again, down to single requests, whose keys are returned.

    Requests are written once with their hash; every part is a range of hashes, so no plan grows.
    """
    rows = written(requests.withColumn("_h", F.xxhash64(key)), "halves")
    skipped, waiting = [], [(-(1 << 63), (1 << 63) - 1)]
    while waiting:
        low, high = waiting.pop()
        part = rows.filter(F.col("_h").between(low, high))
        n, first, last = part.agg(F.count("*"), F.min("_h"), F.max("_h")).first()
        if not n or submit(part.drop("_h")):
            continue
        if first == last:
            skipped += [r[0] for r in part.select(key).toLocalIterator()]
            continue
        # The percentile is a rounded one; either half must have a row.
        middle = max(first, min(part.agg(F.percentile_approx("_h", 0.5)).first()[0], last - 1))
        waiting += [(middle + 1, last), (first, middle)]
    return sorted(skipped)


def passes(todo: DataFrame, attempt: Callable[[DataFrame], DataFrame], key: str = "sample_id", most: int = 3) -> tuple[list[DataFrame], DataFrame]:
    """Try what is left again, until nothing is, a pass brings nothing, or ``most`` passes are over: (parts, rest)."""
    parts, left = [], todo.count()
    for _ in range(most):
        if not left:
            break
        done = written(attempt(todo), "pass")
        todo = written(todo.join(done.select(key), key, "left_anti"), "pass-rest")
        now = todo.count()
        parts.append(done)
        if now == left:
            break
        left = now
    return parts, todo
