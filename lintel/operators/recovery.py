"""Runs of experiments and their recovery: what failed is asked again, read leniently, merged under guards, and filled at last."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lintel.functions.text import unfenced
from lintel.operators.responses import FIELDS, merge_recovered, parse, recover
from lintel.operators.select import require_empty
from lintel.storage import written

OUTPUT = "struct<classification:string,category:string,reasoning:string,evidence:array<string>>"
# What is put behind a prompt that is asked again.
STRICT_SUFFIX = (
    "\n\nIMPORTANT OUTPUT RULES:\n"
    "- Return ONLY one valid JSON object.\n"
    "- Do NOT use markdown fences.\n"
    "- Keys required: classification, category, reasoning, evidence.\n"
    "- classification must be exactly 'Flaky' or 'Non-Flaky'.\n"
    "- category must be one of: Implementation Dependent, Order Dependent, "
    "Non-Idempotent, Time Dependent, Non-Flaky.\n"
    "- If classification is 'Non-Flaky', category must be 'Non-Flaky'.\n"
    "- If classification is 'Flaky', category must NOT be 'Non-Flaky'.\n"
    "- evidence must be a JSON array of strings (empty array allowed).\n"
)


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys for a join that deals both sides: they grow with the replies, and their small files would send them through the driver."""
    return df.select(key).distinct().hint("merge")


def numbered_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines of files with the line's number in its file, from 1; lines stand in the order in which Spark reads a file."""
    placed = written(lines.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")).withColumn("at", F.monotonically_increasing_id()), "lines")
    blocks = placed.groupBy("path", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(starts, ["path", "start"]).select("path", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), value)


def parsed_with_rejects(replies: DataFrame, raw: str = "raw", key: str = "sample_id", line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(good replies with ``output``, rejects: line, key, error, raw_response), from one reading of the replies."""
    out = written(parse(replies, raw), "parsed")
    return out.filter("error is null").drop("error"), out.filter("error is not null").select(line, key, "error", F.col(raw).alias("raw_response"))


def retry_manifest(requests: DataFrame, failed: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """(requests to ask again, manifest: their keys, a row each, in order); stops if a failed reply has no request."""
    require_empty(failed.join(keys_of(requests, key), key, "left_anti").select(key), "failed replies without a request")
    again = written(requests.join(keys_of(failed, key), key, "left_semi"), "retry")
    return again, again.select(key).orderBy(key)


def prepared_retry(requests: DataFrame, failed: DataFrame, path: str, key: str = "sample_id", overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """``retry_manifest`` in a folder: what a run has prepared there is used again by the next, whatever failed since.

    The manifest is written after the requests, so requests without one are those
    of a run that broke off: they are refused.  overwrite: prepare anew.
    """
    spark = requests.sparkSession
    there = {name: _exists(spark, f"{path}/{name}") for name in ("requests", "manifest")}
    if overwrite or not there["requests"]:
        again, keys = retry_manifest(requests, failed, key)
        mode = "overwrite" if overwrite else "errorifexists"
        again.write.mode(mode).parquet(f"{path}/requests")
        keys.write.mode(mode).parquet(f"{path}/manifest")
    elif not there["manifest"]:
        raise FileExistsError(f"{path}/requests exists but its manifest is missing")
    return tuple(spark.read.parquet(f"{path}/{name}") for name in ("requests", "manifest"))


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a writer has finished there, on any file system that Spark reads."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def retry_parsed(replies: DataFrame, expected: DataFrame, strict: bool = True, raw: str = "raw", key: str = "sample_id", error: str | None = None, order: str | None = None, line: str | None = None) -> dict[str, DataFrame]:
    """Replies to asked keys, read as JSON or else by field.

    ``parsed`` (key, output, recovered), ``failures`` (key, error), ``unresolved``
    keys, and ``recoveries``: which replies were read by field and why (key,
    json_error).  line: a column that failures and recoveries take along.

    Replies to other keys are passed over.  strict: stops at any failure, repeated
    key or missing key.  Otherwise equal good replies of a key count once and
    different ones stop, unless ``order`` names a column, whose last good reply
    then counts; a well-formed reply goes before one read by field that is equal.
    error: a column whose text marks a reply as failed.
    """
    mine = replies.join(keys_of(expected, key), key, "left_semi")
    read = recover(mine, raw)
    if error:
        read = read.withColumn("error", F.when(F.col(error).isNotNull(), F.concat(F.lit("reported: "), F.col(error))).otherwise(F.col("error")))
        read = read.withColumn("output", F.when(F.col(error).isNull(), F.col("output")))
    read = written(read, "retry-read")
    along = [line] if line else []
    good, bad = read.filter("error is null"), read.filter("error is not null").select(key, *along, "error")
    recoveries = good.filter("recovered").select(key, *along, F.lit("not a JSON object").alias("json_error"))
    if strict:
        require_empty(bad, "malformed replies")
        require_empty(good.groupBy(key).count().filter("count > 1"), "repeated replies")
        good = good.select(key, "output", "recovered")
    elif order:
        good = good.groupBy(key).agg(F.max_by(F.struct("output", "recovered"), F.struct(order, ~F.col("recovered"), F.to_json("output"))).alias("g")).select(key, "g.*")
    else:
        good = written(good.groupBy(key, "output").agg(F.min("recovered").alias("recovered")), "retry-good")
        require_empty(good.groupBy(key).count().filter("count > 1"), "different replies to one key")
    unresolved = expected.select(key).distinct().join(keys_of(good, key), key, "left_anti")
    if strict:
        require_empty(unresolved, "replies still missing")
    return {"parsed": good, "failures": bad, "unresolved": unresolved, "recoveries": recoveries}


def run_pending(experiments: dict[str, tuple[DataFrame, DataFrame]], run_one: Callable[[str, DataFrame], DataFrame], path: str, key: str = "sample_id", pending_only: bool = True, overwrite: bool = False) -> dict[str, DataFrame | None]:
    """One run for each experiment (its requests, its failed replies), out of ``path``/name; None where nothing failed.

    pending_only: experiments without a failed reply are passed over; otherwise
    they are run as well, with no requests.  Each is one job of the caller's.
    """
    out: dict[str, DataFrame | None] = {}
    for name, (requests, failed) in experiments.items():
        again, keys = prepared_retry(requests, failed, f"{path}/{name}", key, overwrite)
        out[name] = None if pending_only and not keys.head(1) else run_one(name, again)
    return out


def strict_requests(requests: DataFrame, unresolved: DataFrame, prompt: str = "input", key: str = "sample_id") -> DataFrame:
    """The requests of unresolved keys with stricter output rules behind their prompts; stops if one has no request."""
    require_empty(unresolved.join(keys_of(requests, key), key, "left_anti").select(key), "unresolved keys without a request")
    return requests.join(keys_of(unresolved, key), key, "left_semi").withColumn(prompt, F.concat(F.col(prompt), F.lit(STRICT_SUFFIX)))


def scored(prompts: DataFrame, score: Callable[[str], str], prompt: str = "prompt") -> DataFrame:
    """``prompts`` with ``raw``, ``latency_ms`` and ``failure``: every prompt by itself through ``score``, a client of the caller's that runs in the tasks.

    An exception of the client is that row's failure and ends nothing else.
    """

    @F.arrow_udf("struct<raw:string,latency_ms:double,failure:string>")
    def run(texts: pa.Array) -> pa.Array:
        import time

        rows = []
        for text in texts.to_pylist():
            began = time.perf_counter()
            try:
                rows.append({"raw": score(text), "latency_ms": round((time.perf_counter() - began) * 1000, 2), "failure": None})
            except Exception as e:  # whatever the client raises is the row's result
                rows.append({"raw": None, "latency_ms": None, "failure": str(e)})
        return pa.array(rows, pa.struct([("raw", pa.string()), ("latency_ms", pa.float64()), ("failure", pa.string())]))

    return prompts.withColumn("_s", run(F.col(prompt))).select(*prompts.columns, "_s.*")


def with_error_rows(replies: DataFrame, raw: str = "raw", failure: str = "failure") -> DataFrame:
    """``output`` of every reply; one that failed or can't be read has ERROR as classification and category and the reason as reasoning."""
    out = parse(replies, raw)
    why = F.coalesce(F.col(failure), "error")
    wrong = F.struct(F.lit("ERROR").alias("classification"), F.lit("ERROR").alias("category"), why.alias("reasoning"), F.array().cast("array<string>").alias("evidence"))
    return out.withColumn("output", F.when(why.isNull(), F.col("output")).otherwise(wrong)).drop("error")


def predictions(replies: DataFrame, cases: DataFrame, model: Column, prompt_type: Column, context: Column, latency: Column | None = None, key: str = "id") -> DataFrame:
    """The twelve fields of a prediction, from replies (key, output) and their cases (id, test_id, isFlaky, issue_category)."""
    truth = cases.select(F.col("id").alias(key), "test_id", F.when(F.col("isFlaky").cast("boolean"), "Flaky").otherwise("Non-Flaky").alias("ground_truth_classification"), F.col("issue_category").alias("ground_truth_category"))
    named = replies.join(truth, key)
    return named.select(
        F.col(key).alias("id"), "test_id", "ground_truth_classification", "ground_truth_category", F.col("output.classification").alias("predicted_classification"),
        F.col("output.category").alias("predicted_category"), F.col("output.reasoning").alias("reasoning"), F.col("output.evidence").alias("evidence"),
        model.alias("model"), prompt_type.alias("prompt_type"), context.alias("context_enabled"), (latency if latency is not None else F.lit(None).cast("double")).alias("latency_ms"),
    )


def experiment_folder(context: Column) -> Column:
    """The folder's name for a run with or without context."""
    return F.when(context, "with_context").otherwise("without_context")


def run(requests: DataFrame, score: Callable[[DataFrame], DataFrame], key: str = "sample_id", chunk: str | None = None) -> DataFrame:
    """Replies of all requests: one call of ``score``, or one for each value of ``chunk``, whose replies are put together."""
    if chunk is None:
        return score(requests)
    # One value for each call; the caller's chunks are few, as each is a job of its own.
    parts = [score(requests.filter(F.col(chunk) == r[0])) for r in requests.select(chunk).distinct().orderBy(chunk).toLocalIterator()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def strict_pass(requests: DataFrame, base: DataFrame, unresolved: DataFrame, score: Callable[[DataFrame], DataFrame], key: str = "sample_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """One more try with stricter prompts: (base and what came, what is still unresolved, counts before and after)."""
    got = retry_parsed(written(score(strict_requests(requests, unresolved, key=key)), "strict"), unresolved, strict=False, key=key)
    both = written(merge_recovered(base, got["parsed"].select(*base.columns), requests.select(key), key, complete=False), "strict-merged")
    left = written(got["unresolved"], "strict-left")
    counts = base.sparkSession.createDataFrame([(unresolved.count(), left.count(), both.count())], "before long, after long, rows long")
    return both, left, counts


def recovered(requests: DataFrame, replies: DataFrame, retried: DataFrame | None, score: Callable[[DataFrame], DataFrame], passes: int = 3, fill: bool = True, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """(an output for every request with how it came about, counts of each way).

    Replies are parsed; failed or missing ones are read from ``retried`` if there
    is one, else asked again; then come strict passes until nothing is left, one
    brings nothing, or all are done; ``fill`` puts a Non-Flaky placeholder for the rest.
    """
    first = written(parse(replies).filter("error is null").select(key, "output"), "recovered-base")
    failed = requests.select(key).join(keys_of(first, key), key, "left_anti")
    again = requests.join(keys_of(failed, key), key, "left_semi")
    got = retry_parsed(written(score(again), "recovered-again") if retried is None else retried, failed, strict=False, key=key)
    fresh = got["parsed"].select(key, "output")
    base = written(merge_recovered(first, fresh, requests.select(key), key, complete=False), "recovered-merged")
    parts = [first.select(key, "output", F.lit("reply").alias("via")), fresh.select(key, "output", F.lit("retry").alias("via"))]
    left = written(got["unresolved"], "recovered-left")
    n = left.count()
    for _ in range(passes):
        if not n:
            break
        now, left, _ = strict_pass(requests, base, left, score, key)
        parts.append(now.join(keys_of(base, key), key, "left_anti").select(key, "output", F.lit("strict").alias("via")))
        base, m = now, left.count()
        if m == n:
            break
        n = m
    if fill:
        blank = F.struct(F.lit("Non-Flaky").alias("classification"), F.lit("Non-Flaky").alias("category"), F.lit("filled without a reply").alias("reasoning"), F.array().cast("array<string>").alias("evidence"))
        parts.append(left.select(key, blank.alias("output"), F.lit("filled").alias("via")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = written(out, "recovered")
    return out, out.groupBy("via").agg(F.count("*").alias("n"))


def policy(filled: DataFrame, experiment: str, key: str = "sample_id") -> DataFrame:
    """What the placeholders of a run were: experiment, filled, classification, category, and the first and last key."""
    return filled.agg(F.lit(experiment).alias("experiment"), F.count("*").alias("filled"), F.lit("Non-Flaky").alias("classification"), F.lit("Non-Flaky").alias("category"), F.min(key).alias("first"), F.max(key).alias("last"))


def fields(output: Column) -> list[Column]:
    return [output[f].alias(f) for f in FIELDS]


def reply_text(response: Column) -> Column:
    """The reply out of a response's JSON: the texts of all its output_text parts, fences taken off."""
    kind = "struct<output:array<struct<type:string,content:array<struct<type:string,text:string>>>>>"
    parts = F.flatten(F.transform(F.from_json(response, kind)["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    return unfenced(F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "output_text"), lambda p: p["text"]), ""))
