"""Files read and written, the landing stream, p-values and intervals, on small hand-made inputs."""

import json
import zipfile

import pytest

from lintel.operators import significance as G
from lintel.sources import files, sinks
from lintel.streaming import landing


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2, "t": "x"}\n')
    assert rows(files.json_lines(spark, str(tmp_path / "a.jsonl"), "id long, t string").na.fill("")) == [(1, ""), (2, "x")]
    assert files.json_lines(spark, str(tmp_path / "none.jsonl"), "id long").count() == 0


def test_json_tree(spark, tmp_path):
    for model, context in (("m1", "with"), ("m2", "without")):
        (tmp_path / model / "zs" / context).mkdir(parents=True)
        (tmp_path / model / "zs" / context / "p.jsonl").write_text('{"id": 1}\n')
    tree = files.json_tree(spark, str(tmp_path), "id long")
    assert rows(tree) == [(1, "m1", "zs", "with"), (1, "m2", "zs", "without")]
    files.require_parts(tree, spark.createDataFrame([("m1", "with")], "model string, context string"))
    with pytest.raises(Exception, match="missing parts"):
        files.require_parts(tree, spark.createDataFrame([("m3",)], "model string"))


def test_csv(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes(b'a , b\n 1 ,"x, ""y"""\n2,\xff\n3,\n')
    assert rows(files.csv_rows(spark, str(tmp_path / "h.csv"))) == [("1", 'x, "y"'), ("2", "�"), ("3", "")]
    assert rows(files.csv_rows(spark, str(tmp_path / "h.csv"), lossy=True)) == [("1", 'x, "y"'), ("2", ""), ("3", "")]
    (tmp_path / "l.csv").write_text("c,src,test,more\nd,src\n")
    assert rows(files.first_fields(spark, str(tmp_path / "l.csv"), ["sha", "src", "test"])) == [("c", "src", "test")]


def test_round_results(spark, tmp_path):
    found = json.dumps({"results": {"a.B#c": {"result": "FAIL", "stackTrace": ["at x", 'say "no"']}}}).replace('"', '""')
    (tmp_path / "r.csv").write_text(f'1,fail,,x,"{found}"\n2,pass\n3,pass,a,b,c,not json\n')
    assert rows(files.round_results(spark, str(tmp_path / "r.csv"))) == [("1", "fail", "a.B#c", "FAIL", 'at x\nsay "no"')]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("p/Flaky/src/a/b/C.java", "one")
        z.writestr("p/Fixed/src/a/b/C.java", "two")
        z.writestr("p/Flaky/src/a/b/CC.java", "three")
    (tmp_path / "bad.zip").write_text("no archive")
    entries = files.zip_entries(spark, str(tmp_path)).selectExpr("'a' AS archive", "entry", "cast(content AS string) AS text")
    assert entries.count() == 3
    wanted = spark.createDataFrame([("a", "Flaky", "a.b.C$D"), ("a", "Flaky", "a.b.X")], "archive string, version string, class string")
    assert rows(files.found_sources(wanted, entries).select("class", "text")) == [("a.b.C$D", "one")]


def test_reports(spark, tmp_path):
    for folder, name in (("surefire-reports", "a.T.txt"), ("surefire-reports", "a.T-output.txt"), ("other", "a.T.txt"), (".nondex", "T.txt")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text("x\ny\n")
    texts = files.whole_texts(spark, [str(tmp_path), str(tmp_path / ".nondex")])
    assert [r[0].rsplit("/", 2)[1:] for r in rows(files.reports(texts, "T"))] == [[".nondex", "T.txt"], ["surefire-reports", "a.T.txt"]]


def test_coverage(spark, tmp_path):
    def method(name, kind, covered):
        return f'<method name="{name}"><counter type="LINE" missed="1" covered="5"/><counter type="{kind}" missed="1" covered="{covered}"/></method>'

    inside = method("run", "METHOD", 1) + method("idle", "METHOD", 0) + method("part", "INSTRUCTION", 3) + method("&lt;init&gt;", "METHOD", 1)
    (tmp_path / "c.xml").write_text(f'<report><package name="a/b"><class name="a/b/C">{inside}</class><class name="a/b/CTest">{inside}</class></package></report>')
    assert rows(files.covered_methods(spark, str(tmp_path / "c.xml"), "a.b.CTest")) == [("a.b.C", "part"), ("a.b.C", "run")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, {"k": "v"}, None), (2, {}, "x")], "id long, m map<string,string>, t string")
    sinks.to_json_lines(df, str(tmp_path / "j"), ["t", "id", "gone"])
    back = spark.read.schema("t string, id long, gone string").json(str(tmp_path / "j"))
    assert rows(back.select("id", "t", "gone")) == [(1, None, ""), (2, "x", "")]
    sinks.verified(df.selectExpr("t", "id", "'' AS gone"), back)
    with pytest.raises(Exception, match="missing"):
        sinks.verified(df.selectExpr("t", "id", "'' AS gone"), back.filter("id = 1"))
    sinks.to_csv(df, str(tmp_path / "c"))
    assert rows(files.csv_rows(spark, str(tmp_path / "c"))) == [("1", '{"k":"v"}', ""), ("2", "", "x")]
    sinks.to_new(df, str(tmp_path / "n"))
    sinks.to_new(df.limit(0), str(tmp_path / "n"), skip=True)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.to_new(df, str(tmp_path / "n"))
    sinks.to_log(df, str(tmp_path / "n"))
    assert spark.read.schema("id long").json(str(tmp_path / "n")).count() == 4


def test_landing(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i, text in enumerate(('{"id": 1}\n{"id": 2}\n', '{"id": 2}\n{"id": 3}\n')):
        (source / f"{i}.json").write_text(text)
        stream = landing.first_replies(landing.landed(spark, str(source), "id long"), "id").select("id")
        landing.drain(stream, out, str(tmp_path / "state")).awaitTermination(120)
    assert rows(spark.read.parquet(out)) == [(1,), (2,), (3,)]


def test_significance(spark):
    p = [r[0] for r in spark.createDataFrame([(3.841458820694124,), (0.0,), (None,)], "x double").select(G.chi_square_p("x")).collect()]
    assert p[0] == pytest.approx(0.05) and p[1] == 1.0 and p[2] is None
    tests = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03)], "t string, p_value double")
    assert [(t, round(c, 6), s, sc) for t, _, c, s, sc in rows(G.holm(tests))] == [("a", 0.03, True, True), ("b", 0.06, True, False), ("c", 0.06, True, False)]


def test_bootstrap(spark):
    said = [("x", "Flaky", "Flaky")] * 80 + [("x", "Non-Flaky", "Flaky")] * 20 + [("x", "Flaky", "Non-Flaky")] * 20 + [("x", "Non-Flaky", "Non-Flaky")] * 80
    df = spark.createDataFrame(said, "c string, actual string, predicted string")
    (_, low, high), = rows(G.bootstrap_f1(df, ("c",)))
    assert 0.7 < low < 0.8 < high < 0.88
    assert rows(G.bootstrap_f1(df, ("c",))) == [("x", low, high)]
