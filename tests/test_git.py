"""Packs that the tests write, read by offset; nothing here runs a git program."""

import random

import pytest
from pyspark.sql import functions as F

from lintel.operators import stages
from lintel.plans import q_git as W
from lintel.sources import git as G
from lintel.sources.ranges import Ranges


def save(folder, things, name="pack-x"):
    pack, index = W.packed(things)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.pack").write_bytes(pack)
    (folder / f"{name}.idx").write_bytes(index)
    return str(folder)


def test_deltas_give_the_text():
    r = random.Random(1)
    for _ in range(300):
        base = bytes(r.choices(b"abc", k=r.choice([0, 1, 300, 70_000])))
        data = base[: r.randint(0, len(base))] + bytes(r.choices(b"xyz", k=r.choice([0, 1, 126, 127, 128, 400])))
        assert G.patched(base, W.delta(base, data)) == data
    with pytest.raises(ValueError, match="another base"):
        G.patched(b"abc", W.delta(b"ab", b"abcd"))


@pytest.mark.parametrize("kept", [G.KEPT, 0])
def test_chains_of_any_depth(tmp_path, monkeypatch, kept):
    """Five hundred deltas on one another, with bases by offset and by name, and a store that keeps next to nothing."""
    monkeypatch.setattr(G, "KEPT", kept)
    texts = [f"{'line ' * 50}{i}".encode() for i in range(500)]
    save(tmp_path, [(G.BLOB, t, i - 1 if i else None, i % 3 == 0) for i, t in enumerate(texts)])
    index, pack = G.Index(str(tmp_path / "pack-x.idx")), G.Pack(str(tmp_path / "pack-x.pack"))
    rows = dict(x for first in range(256) for x in index.slice(first))
    assert len(rows) == 500
    for t in texts[::-37] + texts[:3]:
        name = W.oid(G.BLOB, t)
        assert index.find(name) == rows[name.hex()] and pack.at(rows[name.hex()]) == (G.BLOB, t)
    with pytest.raises(KeyError):
        index.find(b"\0" * 20)


def test_an_object_larger_than_a_block(tmp_path):
    text = random.Random(2).randbytes(3 << 20)
    save(tmp_path, [(G.BLOB, text, None, False), (G.BLOB, text + b"x", 0, False)])
    pack = G.Pack(str(tmp_path / "pack-x.pack"))
    for first in range(256):
        for name, offset in G.Index(str(tmp_path / "pack-x.idx")).slice(first):
            data = pack.at(offset)[1]
            assert W.oid(G.BLOB, data).hex() == name


def test_ranges(tmp_path):
    data = bytes(range(256)) * 10_000
    (tmp_path / "f").write_bytes(data)
    f = Ranges(f"file:{tmp_path}/f")
    for at, n in ((0, 5), (100, 0), (2_000_000, 99), (3, 4), (len(data) - 2, 50), (len(data) + 5, 3)):
        assert f.read(at, n) == data[at : at + n]


def test_files_of_commits(spark, tmp_path):
    things = []
    blob = lambda t: things.append((G.BLOB, t, None, False)) or W.oid(G.BLOB, t)
    files = {"a/b/c.txt": blob(b"deep"), "top": blob(b""), "a/é.txt": blob("ü".encode())}
    data = b"tree " + W.tree(files, things).hex().encode() + b"\nauthor x\n"
    things.append((G.COMMIT, data, None, False))
    commit = W.oid(G.COMMIT, data).hex()
    folder = save(tmp_path / "one", things)
    save(tmp_path / "two", things, "pack-copy")
    index = G.objects(spark, str(tmp_path))
    assert index.count() == len({W.oid(k, d) for k, d, _, _ in things})
    asked = [(commit, "a/b/c.txt", 1), (commit, "a/b/c.txt", 2), (commit, "top", 3), (commit, "a/é.txt", 4), (commit, "a/b", 5), (commit, "a/b/c.txt/d", 6), ("0" * 40, "top", 7), (commit, "", 8), (commit, None, 9), (None, "top", 10), (commit, "a//b", 11)]
    got = {r.n: None if r.data is None else bytes(r.data) for r in G.blobs(index, spark.createDataFrame(asked, "commit string, path string, n int")).collect()}
    assert got == {1: b"deep", 2: b"deep", 3: b"", 4: "ü".encode()} | {n: None for n in range(5, 12)}
    listed = G.tree_files(index, spark.createDataFrame([(commit,), (commit,), ("f" * 40,)], "commit string")).collect()
    assert sorted((r.path, r.mode) for r in listed) == [("a/b/c.txt", "100644"), ("a/é.txt", "100644"), ("top", "100644")]
    assert folder and G.blobs(index, spark.createDataFrame([], "commit string, path string")).count() == 0


def test_code_of_tests_out_of_packs(spark, tmp_path):
    """The parent's method is found one level up; a test that no commit has takes its patch."""
    things = []
    blob = lambda t: things.append((G.BLOB, t.encode(), None, False)) or W.oid(G.BLOB, t.encode())
    files = {"src/a/T.java": blob("package a; class T extends Base { /* void m() { */ void m() { h(); } }"), "src/a/Base.java": blob("package a; class Base { void h() { } void up() { } }")}
    data = b"tree " + W.tree(files, things).hex().encode() + b"\n"
    things.append((G.COMMIT, data, None, False))
    commit = W.oid(G.COMMIT, data).hex()
    index = G.objects(spark, save(tmp_path, things))
    tests = [(1, "r", commit, "src", "a.T", "m"), (2, "r", commit, "src", "a.T", "up"), (3, "r", commit, "src", "a.Gone", "m")]
    tests = spark.createDataFrame(tests, "test_id int, repo string, commit string, source_dir string, class string, method string")
    cases = tests.select("test_id", F.lit("").alias("test_code"), F.create_map().cast("map<string,string>").alias("helper_methods_json"))
    patched = spark.createDataFrame([(3, "void m() { p(); }", {"p": "b"}), (1, "no", {})], "test_id int, test_code string, helpers map<string,string>")
    got = {r.test_id: (r.test_code, r.helper_methods_json) for r in stages.with_code_from_packs(cases, tests, index, patched).collect()}
    assert got == {1: ("/* void m() { */ void m() { h(); }", {"h": "void h() { }"}), 2: ("void up() { }", {}), 3: ("void m() { p(); }", {"p": "b"})}
