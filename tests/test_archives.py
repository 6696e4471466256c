"""Archives by offset against Python's zipfile."""

import io
import random
import zipfile

import pytest

from lintel.sources import archives as A
from lintel.sources import files
from lintel.sources.ranges import Ranges


def saved(path, names, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in names.items():
            z.writestr(name, data)
    return path


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_members_and_contents(spark, tmp_path, method):
    r = random.Random(method)
    names = {f"{i % 5}/é{i}.txt": r.randbytes(r.choice([0, 1, 5000, 200_000])) for i in range(60)} | {"dir/": b""}
    saved(tmp_path / "a.zip", names, method)
    saved(tmp_path / "empty.zip", {})
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    (tmp_path / "none.zip").write_bytes(b"")
    got = {r.entry: bytes(r.content) for r in files.zip_entries(spark, str(tmp_path)).collect()}
    assert got == {n: d for n, d in names.items() if not n.endswith("/")}


def test_an_archive_beyond_two_gigabytes(spark, tmp_path):
    """Places beyond 2^31 and 2^32, and bytes before the archive; the file has a hole, so it takes no room."""
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a/X.java", b"class X { }")
        z.writestr("b/Y.java", b"class Y { }" * 1000, zipfile.ZIP_DEFLATED)
    for gap in (2_200_000_000, 4_400_000_000):
        with open(tmp_path / f"{gap}.zip", "wb") as f:
            f.seek(gap)
            f.write(inner.getvalue())
    members = A.members(spark, str(tmp_path))
    assert members.filter("place > 2147483648").count() == 4
    got = A.with_content(members.filter("entry like '%Y.java'")).collect()
    assert [bytes(r.content) for r in got] == [b"class Y { }" * 1000] * 2


def test_wide_places(tmp_path):
    """Sizes and places that only fit into the extra field of a large archive."""
    path = tmp_path / "w.zip"
    with open(path, "wb") as f, zipfile.ZipFile(f, "w") as z:
        z.writestr("first", b"1")
        f.seek(4_400_000_000)
        z.start_dir = f.tell()
        z.writestr("second", b"22" * 9)
    f = Ranges(str(path))
    found = list(A._entries(f, *A._directory(f)))
    assert [(n, A.content(f, *rest)) for n, *rest in found] == [("first", b"1"), ("second", b"22" * 9)]


def test_reads_follow_what_is_asked_for(tmp_path):
    saved(tmp_path / "a.zip", {f"{i}": random.Random(i).randbytes(20_000) for i in range(100)})
    f = Ranges(str(tmp_path / "a.zip"), A.DIRECTORY_BLOCK)
    entries = list(A._entries(f, *A._directory(f)))
    counted = Ranges(str(tmp_path / "a.zip"), A.HEADER_BLOCK)
    read, inner = [], counted._file

    class File:
        def read_at(self, n, at):
            read.append(n)
            return inner.read_at(n, at)

    counted._file = File()
    for _, *rest in entries[::10]:
        assert len(A.content(counted, *rest)) == 20_000
    assert sum(read) < 10 * 22_000


def test_damage_is_told(tmp_path):
    data = bytearray(saved(tmp_path / "a.zip", {"x": b"y" * 500}, zipfile.ZIP_STORED).read_bytes())
    data[100] ^= 1
    (tmp_path / "a.zip").write_bytes(data)
    f = Ranges(str(tmp_path / "a.zip"))
    (_, *rest), = A._entries(f, *A._directory(f))
    with pytest.raises(ValueError, match="damaged"):
        A.content(f, *rest)


def test_paths_meet_in_their_last_parts(spark):
    entries = [("z", "r/F/src/a/b/Utils.java"), ("z", "r/F/xa/b/Utils.java"), ("z", "r/F/c/Utils.java"), ("z", "Utils.groovy"), ("y", "r/F/a/b/Utils.java"), ("z", "r/F/MyUtils.java")]
    rows = spark.createDataFrame(entries, "archive string, entry string")
    wanted = spark.createDataFrame([("z", "a/b/Utils", 1), ("z", "Utils", 2), ("z", "b/Utils", 3), ("z", "q/Utils", 4), (None, "a", 5), ("z", None, 6)], "archive string, file string, n int")
    got = sorted((r.n, r.entry) for r in A.matched(wanted, rows).collect())
    want = sorted((n, e) for a, f, n in [("z", "a/b/Utils", 1), ("z", "Utils", 2), ("z", "b/Utils", 3)] for x, e in entries if x == a and e.rsplit(".", 1)[0].endswith(f) and e.rsplit("/", 1)[-1].split(".")[0] == "Utils")
    assert got == want


def test_a_common_name_is_spread(spark):
    """A million files of one simple name: no key of the join has more than a few of them."""
    from pyspark.sql import functions as F

    rows = spark.range(1_000_000).select(F.lit("z").alias("archive"), F.format_string("r/F/src/com/p%d/d%d/Utils.java", F.col("id") % 1000, "id").alias("entry"))
    keys = rows.select(F.explode(A.suffix_keys("entry", [2])).alias("k"))
    assert keys.groupBy("k").count().agg(F.max("count")).first()[0] == 1
    wanted = spark.range(0, 1_000_000, 999).select(F.lit("z").alias("archive"), F.format_string("com/p%d/d%d/Utils", F.col("id") % 1000, "id").alias("file"))
    assert A.matched(wanted, rows).count() == wanted.count()
