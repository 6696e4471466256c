"""Class graphs of any depth, with cycles, and what the class operators do with awkward sources."""

import pytest
from pyspark.sql import functions as F

from lintel import storage
from lintel.operators import code as C
from lintel.operators import stages as G
from lintel.operators.traces import ancestors
from lintel.sources import sinks
from lintel.sources.files import json_lines


def test_a_chain_of_a_thousand(spark):
    edges = spark.range(1, 1000).select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent"))
    got = ancestors(edges)
    assert got.count() == 999 * 1000 // 2 and got.filter("level = child - ancestor").count() == got.count()


def test_cycles_and_several_parents(spark):
    rows = [(1, 2), (2, 3), (3, 1), (4, 1), (4, 3), (5, 5), (6, 5)]
    got = {(r.child, r.ancestor): r.level for r in ancestors(spark.createDataFrame(rows, "child int, parent int")).collect()}
    graph = {}
    for a, b in rows:
        if a != b:
            graph.setdefault(a, set()).add(b)
    want = {}
    for start in graph:
        seen, layer, level = {start}, {start}, 0
        while layer:
            layer, level = {b for a in layer for b in graph.get(a, ())} - seen, level + 1
            seen |= layer
            want |= {(start, b): level for b in layer}
    assert got == want
    assert ancestors(spark.createDataFrame([], "child int, parent int")).count() == 0


def test_classes_without_anything(spark):
    files = spark.createDataFrame([("r", "a.B", ""), ("r", "C", "class C extends C { void m() { n(); } void n() { } }"), ("r", "D", None)], "repo string, fqn string, code string")
    found = C.classes(files)
    assert {r.fqn: r.parent for r in found.collect()} == {"a.B": None, "C": None, "D": None}
    tests = spark.createDataFrame([(1, "r", "C", "m"), (2, "r", "a.B", "m"), (3, "r", "gone", "m")], "test_id int, repo string, class string, method string")
    got = C.tests_and_helpers(tests, C.hierarchy(found), found).collect()
    assert [(r.test_id, r.test_code, r.helpers) for r in got] == [(1, "void m() { n(); }", {"n": "void n() { }"})]
    cut = C.code_under_test(tests, [spark.createDataFrame([], "test_id int, fqn string, method string")], C.hierarchy(found), found).collect()
    assert sorted((r.test_id, r.tier, r.code_under_test) for r in cut) == [(1, None, {}), (2, None, {}), (3, None, {})]


def test_patches_come_second(spark):
    files = spark.createDataFrame([("r", "C", "class C { void m() { } }")], "repo string, fqn string, code string")
    cases = spark.createDataFrame([(1,), (2,)], "test_id int")
    cases = cases.select("test_id", F.lit("").alias("test_code"), F.create_map().cast("map<string,string>").alias("helper_methods_json"))
    tests = spark.createDataFrame([(1, "r", "C", "m"), (2, "r", "C", "x")], "test_id int, repo string, class string, method string")
    patched = spark.createDataFrame([(1, "no", {}), (2, "void x() { }", {"h": "b"})], "test_id int, test_code string, helpers map<string,string>")
    got = {r.test_id: (r.test_code, r.helper_methods_json) for r in G.with_code(cases, tests, files, patched).collect()}
    assert got == {1: ("void m() { }", {}), 2: ("void x() { }", {"h": "b"})}


def test_merged_files(spark, tmp_path):
    part = lambda flaky, *names: spark.createDataFrame([(n, flaky, {"h": "b"}) for n in names], "test_id string, isFlaky int, helper_methods_json map<string,string>")
    out, counts = G.merged([part(1, "b", "a"), part(0, "z", "y")], folder=str(tmp_path))
    assert [(r.id, r.test_id) for r in out.orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "y"), (4, "z")]
    assert {r.isFlaky: r.percent for r in counts.collect()} == {1: 50.0, 0: 50.0}
    lines = json_lines(spark, f"{tmp_path}/cases.jsonl", "id int, test_id string, repo_url string, helper_methods_json map<string,string>").collect()
    assert {(r.id, r.repo_url) for r in lines} == {(i, "") for i in range(1, 5)} and lines[0].helper_methods_json == {"h": "b"}
    assert spark.read.csv(f"{tmp_path}/cases.csv", header=True, escape='"').first().helper_methods_json == '{"h":"b"}'


def test_texts_and_parts(spark, tmp_path):
    rows = spark.createDataFrame([("p1", "a\nb"), ("p2", "c")], "name string, text string")
    sinks.to_texts(rows, f"{tmp_path}/texts", "name", "text")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/texts/name=p1").collect()) == ["a", "b"]
    sinks.to_one(spark, [f"{tmp_path}/texts/name=p1", f"{tmp_path}/texts/name=p2"], f"{tmp_path}/one")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/one").collect()) == ["a", "b", "c"]
    sinks.to_parts(rows, f"{tmp_path}/parts", ("name",))
    sinks.to_parts(rows.filter("name = 'p1'").withColumn("text", F.lit("new")), f"{tmp_path}/parts", ("name",))
    assert sorted((r.name, r.text) for r in spark.read.json(f"{tmp_path}/parts").collect()) == [("p1", "new"), ("p2", "c")]


def test_scratch_goes_and_clusters_need_a_folder(spark, monkeypatch):
    with storage.scratch(spark):
        path = storage.fresh_path(spark, "x")
        assert storage.written(spark.range(3), "x").count() == 3
    assert "/run-" in path
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    assert not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    if not spark.conf.get("spark.checkpoint.dir", None):
        fake = type("S", (), {"conf": spark.conf, "sparkContext": type("C", (), {"master": "spark://x", "getConf": spark.sparkContext.getConf})()})()
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.shared_dir(fake)
