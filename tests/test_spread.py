"""Work that is heavy in narrow rows is spread over tasks, however few bytes it has."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from lintel.functions import java as J
from lintel.operators import code as C
from lintel.operators import recovery as R
from lintel.operators import significance as G
from lintel.plans import q_git as W
from lintel.sources import git as S
from lintel.sources.records import RECORDS, csv_records


def most_tasks(spark, run) -> int:
    """Tasks of the widest stage that ``run`` starts."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "spread")
    run()
    tracker = context.statusTracker()
    context.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max(s.numTasks for s in stages if s)


def test_bootstrap_draws_are_spread(spark):
    df = spark.range(400, numPartitions=1).selectExpr("'x' AS c", "if(id % 2 = 0, 'Flaky', 'Non-Flaky') AS actual", "if(id % 5 < 2, 'Flaky', 'Non-Flaky') AS predicted")
    assert most_tasks(spark, lambda: G.bootstrap_f1(df, ("c",)).collect()) == 8


def test_patches_are_spread(spark):
    removed = "  public void t() {\n    int a = h(1);\n  }\n  int h(int i) { return i; }"
    df = spark.range(64, numPartitions=1).select(F.col("id").alias("test_id"), F.lit("t").alias("method"), F.lit(removed).alias("removed"), F.lit("").alias("context"))
    out = C.patch_code(df)
    assert most_tasks(spark, out.collect) == 8
    before = out._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(before) == 2 and "run(" in before[0] and "run(" not in before[1]


def test_packs_are_spread_and_small_indexes_opened_once(spark, tmp_path):
    texts = [f"text {i}".encode() for i in range(40)]
    for i in range(20):
        pack, index = W.packed([(S.BLOB, t, None, False) for t in texts[2 * i : 2 * i + 2]])
        (tmp_path / f"p{i}.pack").write_bytes(pack)
        (tmp_path / f"p{i}.idx").write_bytes(index)
    rows = [(f"{tmp_path}/p{i}.idx", (tmp_path / f"p{i}.idx").stat().st_size) for i in range(20)]
    indexes = spark.createDataFrame(rows, "path string, length long").coalesce(1)
    assert {(r.first, r.last) for r in S.slices(indexes).collect()} == {(0, 255)}
    assert most_tasks(spark, lambda: S.objects_of(indexes)) == 8
    assert {r.oid for r in S.objects_of(indexes).collect()} == {W.oid(S.BLOB, t).hex() for t in texts}


def test_slices_of_a_large_index_cover_it(spark):
    found = sorted((r.first, r.last) for r in S.slices(spark.createDataFrame([("p", 7 * S.SLICE + 1)], "path string, length long")).collect())
    assert len(found) == 8 and [b for f, l in found for b in range(f, l + 1)] == list(range(256))


def test_java_scans_pass_over_blanks_and_comments_once():
    """A long comment with many names in it, which was gone through again for each of them."""
    code = "class T { /* " + "word call ( " * 30_000 + "*/ public void t() { x(); } }"
    began = time.perf_counter()
    types, methods = J.outline(code, None, False)
    assert time.perf_counter() - began < 5
    assert [t.name for t in types] == ["T"] and len(methods) == 30_001
    assert methods[-1].name == "t" and methods[-1].head == ("public", "void") and methods[0].head == ()
    assert J.masked_code("a /* b\n*** c */ '\\'' \"x\\\"\" // y\nz") == "a     \n         " + " " * 4 + " " + " " * 5 + "     \nz"


def test_keys_of_a_recovery_are_dealt(spark):
    """No key column, which grows with the replies, goes through the driver."""
    good = spark.range(50).selectExpr("cast(id as string) AS sample_id", "'{\"classification\": \"Flaky\", \"category\": \"Time Dependent\", \"reasoning\": \"x\", \"evidence\": []}' AS raw")
    expected = good.select("sample_id")
    got = R.retry_parsed(good, expected, strict=False)
    for df in (got["unresolved"], good.join(R.keys_of(expected, "sample_id"), "sample_id", "left_semi")):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert got["unresolved"].count() == 0 and got["parsed"].count() == 50


def test_records_are_split_few_at_once(spark, tmp_path):
    """No function over whole batches: a batch of whole texts and all their fields was held by each worker."""
    n = 2 * RECORDS + 3
    (tmp_path / "a.csv").write_text("".join(f'{i},"x\n{i}"\n' for i in range(n)))
    found = csv_records(spark, str(tmp_path))
    assert sorted((int(r.fields[0]), r.fields[1]) for r in found.collect()) == [(i, f"x\n{i}") for i in range(n)]
    assert "ArrowEvalPython" not in found._jdf.queryExecution().optimizedPlan().toString()
