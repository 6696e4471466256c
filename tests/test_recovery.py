"""Guards of the recovery flow, lines of files, and runs that end at different points."""

import pytest
from pyspark.sql import functions as F

from lintel.operators import recovery as V
from lintel.operators import responses as A

GOOD = '{"classification": "Flaky", "category": "Time Dependent", "reasoning": "r", "evidence": []}'
FIELDS = '{"classification": "Non-Flaky", "category": "Non-Flaky", "reasoning": "a "b"'


def replies(spark, *rows):
    return spark.createDataFrame(list(rows), "sample_id string, raw string")


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "sample_id string")


def test_strict_parse_guards(spark):
    asked = keys(spark, "a", "b")
    good = V.retry_parsed(replies(spark, ("a", GOOD), ("b", FIELDS), ("stranger", "x")), asked)
    assert sorted((r.sample_id, r.recovered) for r in good["parsed"].collect()) == [("a", False), ("b", True)]
    for rows, why in (([("a", GOOD), ("b", "no")], "malformed"), ([("a", GOOD), ("a", GOOD), ("b", GOOD)], "repeated"), ([("a", GOOD)], "missing")):
        with pytest.raises(ValueError, match=why):
            V.retry_parsed(replies(spark, *rows), asked)


def test_best_effort_has_three_outputs(spark):
    asked = keys(spark, "a", "b", "c")
    got = V.retry_parsed(replies(spark, ("a", GOOD), ("a", GOOD), ("b", "no")), asked, strict=False)
    assert [r.sample_id for r in got["parsed"].collect()] == ["a"]
    assert [r.sample_id for r in got["failures"].collect()] == ["b"]
    assert sorted(r.sample_id for r in got["unresolved"].collect()) == ["b", "c"]


def test_reported_errors_count_as_failures(spark):
    rows = spark.createDataFrame([("a", GOOD, "too long"), ("b", GOOD, None)], "sample_id string, raw string, why string")
    got = V.retry_parsed(rows, keys(spark, "a", "b"), strict=False, error="why")
    assert [(r.sample_id, r.error) for r in got["failures"].collect()] == [("a", "reported: too long")]


def test_requests_must_exist(spark):
    requests = spark.createDataFrame([("a", "p")], "sample_id string, input string")
    for call in (V.retry_manifest, V.strict_requests, A.retry_set):
        with pytest.raises(ValueError, match="without a request"):
            call(requests, keys(spark, "a", "b"))
    assert V.strict_requests(requests, keys(spark, "a")).first().input == "p" + V.STRICT_SUFFIX


def test_merge_guards(spark):
    of = lambda *names: spark.createDataFrame([(n, n) for n in names], "sample_id string, predicted string")
    asked = keys(spark, "a", "b", "c")
    for base, fresh, why in ((("a",), ("a",), "although present"), (("a",), ("b", "b"), "repeated"), (("a",), ("z",), "to nothing"), (("a",), ("b",), "missing")):
        with pytest.raises(ValueError, match=why):
            A.merge_recovered(of(*base), of(*fresh), asked, complete=True)
    assert A.merge_recovered(of("a"), of("b", "c"), asked, complete=True).count() == 3


@pytest.mark.parametrize("given,via", [([("a", GOOD), ("b", GOOD)], {"reply": 2}), ([("a", GOOD)], {"reply": 1, "strict": 1}), ([], {"strict": 1, "filled": 1})])
def test_recovered_runs(spark, given, via):
    """The client answers b only under strict rules, and a never."""
    requests = spark.createDataFrame([("a", "p"), ("b", "p")], "sample_id string, input string")

    def score(some):
        good = (F.col("sample_id") == "b") & F.contains("input", F.lit("IMPORTANT"))
        return some.select("sample_id", F.when(good, GOOD).otherwise("no").alias("raw"))

    out, counts = V.recovered(requests, replies(spark, *given), None, score)
    assert {r.via: r.n for r in counts.collect()} == via
    assert sorted(r.sample_id for r in out.collect()) == ["a", "b"]


def test_passes_and_halves(spark):
    todo = keys(spark, *"abcdefg")
    parts, rest = A.passes(todo, lambda left: left.orderBy("sample_id").limit(3))
    assert [p.count() for p in parts] == [3, 3, 1] and rest.count() == 0
    _, rest = A.passes(todo, lambda left: left.filter("sample_id = 'a'"))
    assert rest.count() == 6
    assert A.submit_by_halves(todo, lambda part: not part.filter("sample_id in ('b', 'f')").head(1)) == ["b", "f"]


def test_lines_of_files_are_numbered(spark, tmp_path):
    for name, n in (("x", 400), ("y", 3)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} {i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    got = V.numbered_lines(spark.read.text(str(tmp_path))).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 403 and all(r.value.split()[1] == str(r.line) for r in got)


def test_scoring_one_by_one(spark):
    def client(text):
        if text == "bad":
            raise RuntimeError("down")
        return GOOD

    rows = spark.createDataFrame([("good",), ("bad",)], "prompt string")
    got = {r.prompt: r for r in V.with_error_rows(V.scored(rows, client)).collect()}
    assert got["good"].output.category == "Time Dependent" and got["good"].latency_ms is not None
    assert tuple(got["bad"].output)[:3] == ("ERROR", "ERROR", "down")


def test_repeated_keys_in_best_effort(spark):
    """Equal replies count once, the well-formed one first; different ones stop, unless an order says which came last."""
    asked = keys(spark, "a")
    same = V.retry_parsed(replies(spark, ("a", GOOD), ("a", GOOD), ("a", "no")), asked, strict=False)
    assert [tuple(r)[2] for r in same["parsed"].collect()] == [False]
    with pytest.raises(ValueError, match="different replies"):
        V.retry_parsed(replies(spark, ("a", GOOD), ("a", FIELDS)), asked, strict=False)
    for last, recovered in ((GOOD, False), (FIELDS, True)):
        first = FIELDS if last == GOOD else GOOD
        rows = spark.createDataFrame([("a", first, 1), ("a", last, 2), ("a", "no", 3)], "sample_id string, raw string, at int")
        got = V.retry_parsed(rows, asked, strict=False, order="at", line="at")
        assert [r.recovered for r in got["parsed"].collect()] == [recovered]
        assert [tuple(r) for r in got["failures"].select("sample_id", "at").collect()] == [("a", 3)]
        assert [tuple(r) for r in got["recoveries"].collect()] == [("a", 2 if recovered else 1, "not a JSON object")]


def test_prepared_retries_are_used_again(spark, tmp_path):
    requests = spark.createDataFrame([("a", "p"), ("b", "q")], "sample_id string, input string")
    first = V.prepared_retry(requests, keys(spark, "b"), f"{tmp_path}/r")
    again = V.prepared_retry(requests, keys(spark, "a", "b"), f"{tmp_path}/r")
    for got in (first, again):
        assert [tuple(r) for r in got[0].collect()] == [("b", "q")] and [r.sample_id for r in got[1].collect()] == ["b"]
    assert V.prepared_retry(requests, keys(spark, "a", "b"), f"{tmp_path}/r", overwrite=True)[1].count() == 2
    requests.write.parquet(f"{tmp_path}/broken/requests")
    with pytest.raises(FileExistsError, match="manifest"):
        V.prepared_retry(requests, keys(spark, "a"), f"{tmp_path}/broken")


@pytest.mark.parametrize("pending", [True, False])
def test_pending_runs(spark, tmp_path, pending):
    requests = spark.createDataFrame([("a", "p"), ("b", "q")], "sample_id string, input string")
    some = {"x": (requests, keys(spark, "b")), "y": (requests, keys(spark, "z").limit(0))}
    out = V.run_pending(some, lambda name, again: again, f"{tmp_path}/{pending}", pending_only=pending)
    assert out["x"].count() == 1 and (out["y"] is None if pending else out["y"].count() == 0)
