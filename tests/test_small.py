"""Small operators that no query reaches."""

import json

from pyspark.sql import functions as F

from lintel.operators import profile as P
from lintel.operators import responses as A
from lintel.operators import select as L
from lintel.sources import files, sinks


def test_parts_of_one_kind_are_joined(spark):
    kind = "array<struct<type:string,text:string>>"
    df = spark.createDataFrame([([("output_text", "a"), ("other", "b"), ("output_text", "c")],), ([],), (None,)], f"parts {kind}")
    assert [r[0] for r in df.select(A.joined_parts(F.col("parts"))).collect()] == ["ac", "", None]


def test_same_rows_counts_repeats(spark):
    one, two = spark.createDataFrame([(1,), (1,), (2,)], "a int"), spark.createDataFrame([(1,), (2,), (2,)], "a int")
    assert P.same_rows(one, one.orderBy("a")) and not P.same_rows(one, two) and not P.same_rows(one, one.distinct())


def test_filled_rows_stay_unless_forced(spark):
    df = spark.createDataFrame([(1, "x"), (2, " "), (3, None)], "id int, log string")
    todo, done = L.filled_only(df, "log")
    assert ([r.id for r in todo.collect()], [r.id for r in done.collect()]) == ([2, 3], [1])
    todo, done = L.filled_only(df, "log", force=True)
    assert (todo.count(), done.count()) == (3, 0)


def test_json_documents_and_logs(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"total": 2, "ids": ["a", "b"]}, indent=1))
    assert files.json_document(spark, str(tmp_path / "m.json"), "total int, ids array<string>").collect() == [(2, ["a", "b"])]
    for i in range(2):
        sinks.to_log(spark.createDataFrame([(i,)], "n int"), f"{tmp_path}/log")
    assert sorted(r.n for r in spark.read.json(f"{tmp_path}/log").collect()) == [0, 1]


def test_numbers_over_a_whole_table(spark):
    df = spark.createDataFrame([(5,), (3,), (9,)], "id int")
    assert sorted(map(tuple, L.numbered(df, [], ["id"], "r", "n").collect())) == [(3, 1, 3), (5, 2, 3), (9, 3, 3)]
