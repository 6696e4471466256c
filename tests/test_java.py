"""The mask and the method extractor on awkward code."""

import pytest
from pyspark.sql import functions as F

from lintel.functions import java as J


@pytest.mark.parametrize("code,want", [
    ("", ""), ('a("x{") // }\n}', 'a(    )     \n}'), ("/* {\n } */ b", "    \n      b"), ('"// no" c', "        c"), (r"""'\'' d "\\" e""", "     d      e"),
    ('"open\n{', "       "), ("/*/ { */ f", "         f"), ("a / b", "a / b"), ("// x /*\n{", "       \n{"),
])
def test_mask(code, want):
    assert J.masked_code(code) == want


CODE = """class T {
  // void one() { is old
  int x = other.one(1);
  @Test
  public void one() { String s = "}"; if (a) { b(); } }
  abstract void two();
  List<String> three(int a) { return new four(); }
  void open() { {
"""


@pytest.mark.parametrize("name,masked,want", [
    ("one", True, '@Test\n  public void one() { String s = "}"; if (a) { b(); } }'), ("one", False, None), ("two", True, None), ("three", True, "List<String> three(int a) { return new four(); }"),
    ("four", True, None), ("open", True, None), ("none", False, None),
])
def test_method(name, masked, want):
    assert J.method_body(CODE, name, masked) == want


def test_columns(spark):
    df = spark.createDataFrame([(CODE, "three"), (None, "one"), (CODE, None)], "code string, name string")
    got = [tuple(r) for r in df.select(J.mask(F.col("code")), J.method(F.col("code"), F.col("name"), True)).collect()]
    assert got == [(J.masked_code(CODE), "List<String> three(int a) { return new four(); }"), (None, None), (J.masked_code(CODE), None)]


AWKWARD = """package a.b;
import static x.y.Base.make;
import q.Base;
/* class Not extends Gone { */
public class Outer<T extends Comparable<List<T>>> extends Base<Map<String, T>> implements Runnable {
  // see; above }
  public Map<String, List<T>> many(int a) { /* } */ return make("{;"); }
  private void many(String s) { }
  public Class<?> kind() { return null; }
  int[] row() { return new int[] { 1 }; }
  interface Shape { double area(); default double twice() { return 2 * area(); } }
  static class In { protected In() { } void deep() { Runnable r = new Runnable() { public void run() { deep(); } }; } }
  enum Level { LOW { int n() { return 0; } }; abstract int n(); }
  protected Outer() { super(); }
}
"""


def test_outline_of_an_awkward_file():
    types, methods = J.outline(AWKWARD)
    assert [(t.name, t.kind, t.parent, t.inside) for t in types] == [("Outer", "class", "Base", ""), ("Shape", "interface", None, "Outer"), ("In", "class", None, "Outer"), ("Level", "enum", None, "Outer")]
    found = [(m.name, m.inside, m.depth, m.end is not None) for m in methods]
    assert found == [
        ("many", "Outer", 1, True), ("make", "Outer", 2, False), ("many", "Outer", 1, True), ("kind", "Outer", 1, True), ("row", "Outer", 1, True), ("area", "Outer$Shape", 2, False), ("twice", "Outer$Shape", 2, True),
        ("In", "Outer$In", 2, True), ("deep", "Outer$In", 2, True), ("run", "Outer$In", 4, True), ("n", "Outer$Level", 3, True), ("n", "Outer$Level", 2, False), ("Outer", "Outer", 1, True),
    ]
    assert J.body(AWKWARD, methods[0]) == '// see; above }\n  public Map<String, List<T>> many(int a) { /* } */ return make("{;"); }'
    assert J.body(AWKWARD, methods[8]).endswith("deep(); } }; }")


@pytest.mark.parametrize("code, ends", [("class A { void m() { ", [None]), ("void m() { } }", [12]), ("} void m() { }", [14]), ("", []), ("class A extends", []), ("void m(", [None]), ("class " * 9, [])])
def test_outline_of_broken_code(code, ends):
    assert [m.end for m in J.outline(code)[1]] == ends


def test_long_files_take_linear_time():
    many = "class A { " + "".join(f"void m{i}() {{ if (x) {{ y(); }} }}\n" for i in range(20_000)) + "}"
    assert len(J.outline(many)[1]) == 20_000
    for code in ("{" * 200_000, "a " * 200_000, "a(" * 200_000, "f" * 200_000 + "(", " " * 200_000 + "(", "class A<" + "<" * 200_000):
        J.outline(code)


def test_repeated_files_and_parents(spark):
    """Of repeated files the least path counts; static imports name no class; nothing multiplies."""
    from lintel.operators import code as C
    from lintel.operators import stages as G

    rows = [("r", "a.b.Outer", "2", "class Outer { void m() { old(); } }"), ("r", "a.b.Outer", "1", AWKWARD), ("r", "a.b.Outer", "3", None), ("r", "q.Base", "4", "class Base { public void m() { } }"), (None, "n", "5", "class n { }")]
    files = spark.createDataFrame(rows, "repo string, fqn string, path string, code string")
    found = C.classes(files, search_masked=True)
    assert sorted((r.fqn, r.parent) for r in found.collect()) == [("a.b.Outer", "q.Base"), ("n", None), ("q.Base", None)]
    assert [r.method for r in C.public_methods(found).filter("fqn = 'a.b.Outer'").orderBy("method").collect()] == ["<init>", "kind", "many", "run"]
    tests = spark.createDataFrame([(1, "r", "a.b.Outer", "m")], "test_id int, repo string, class string, method string")
    cases = spark.createDataFrame([(1, "m();", {"h": "Base b;"}, "at q.Base.m(Base.java:1)\nat q.Base.n(Native Method)")], "test_id int, test_code string, helper_methods_json map<string,string>, failure_log string")
    covered = spark.createDataFrame([], "test_id int, fqn string, method string")
    out = G.with_code_under_test(cases, tests, files, covered).collect()
    assert [r.code_under_test_json for r in out] == [{"q.Base": {"m": "public void m() { }"}}]


def test_frames_need_file_and_line(spark):
    from lintel.functions import text as T

    trace = "at a.B.c(B.java:1)\n at a.B$C.d(Native Method)\nat a.B.e(Unknown Source)\nat a.B.<init>(B.java)\nat a.F.g(F.kt:3)\nat a.B.lambda$h(B.java:22)"
    row = spark.range(1).select(T.frames(F.lit(trace)).alias("f")).first()
    assert [tuple(f) for f in row.f] == [("a.B", "c"), ("a.B", "lambda$h")]


def test_variable_types(spark):
    from lintel.functions import text as T

    code = "Foo a; Map<String, List<Foo>> b = x; Bar a; return New c; x.Foo d; int e; Foo[] f; Foo F;"
    row = spark.range(1).select(T.variable_types(F.lit(code)).alias("v"), T.variable_types(F.lit("")).alias("none")).first()
    assert row.v == {"a": "Bar", "b": "Map", "d": "Foo"} and row.none == {}
