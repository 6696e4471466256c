"""CSV records over blocks of any size against Python's csv module."""

import csv
import io
import random

import pytest

from lintel.sources import files
from lintel.sources import records as R


def brute(data: bytes):
    return [r for r in csv.reader(io.StringIO(data.decode("utf-8", "replace"), newline="")) if r]


def test_states_equal_the_reader():
    """Lines end a record where the csv module ends one."""
    r = random.Random(5)
    for _ in range(20_000):
        lines = ["".join(r.choices('",ab ', k=r.randint(0, 8))) for _ in range(r.randint(1, 4))]
        state, ends = R.OUTSIDE, []
        for i, line in enumerate(lines):
            state = R.state_after(line, state)
            if state == R.OUTSIDE:
                ends.append(i)
        reader = csv.reader(iter(line + "\n" for line in lines))
        want = []
        for _ in reader:
            want.append(reader.line_num - 1)
        if state == R.INSIDE and want:  # the module ends an open record with the file
            want.pop()
        assert ends == want, lines


@pytest.mark.parametrize("block", [40, 400, 1 << 20])
def test_blocks(spark, tmp_path, block):
    r = random.Random(block)
    wanted = []
    for name in "abc":
        rows = [[str(i), "".join(r.choices(['"', ",", "\n", "\r\n", "x", "é", " "], k=r.choice([0, 3, 40]))), "end"] for i in range(60 if block > 40 else 8)]
        text = io.StringIO()
        csv.writer(text, lineterminator=r.choice(["\n", "\r\n"])).writerows(rows)
        data = text.getvalue().encode() + (b'ragged,5" disk\n\nq,"open' if name == "c" else b"\xff,bad\n")
        (tmp_path / f"{name}.csv").write_bytes(data)
        wanted += [(name, *f) for f in brute(data)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    found = R.csv_records(spark, str(tmp_path)).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    got = [(x.path[-5], *x.fields) for x in sorted(found, key=lambda x: (x.path, x.start, x.at))]
    assert got == wanted


def test_joined_state_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_BLOCKS", -1)
    (tmp_path / "a.csv").write_text('1,"a\nb"\n2,c\n')
    assert sorted(x.fields for x in R.csv_records(spark, str(tmp_path)).collect()) == [["1", "a\nb"], ["2", "c"]]


def test_rounds_with_line_breaks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('1,fail,x,"{""results"": {""a.T.m"": {""result"": ""failure"",\n ""stackTrace"": [""at a"", ""at b""]}}}"\n2,pass,y,z\n')
    got = [tuple(x) for x in files.round_results(spark, str(tmp_path)).collect()]
    assert got == [("1", "fail", "a.T.m", "failure", "at a\nat b")]


def test_empty(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert R.csv_records(spark, str(tmp_path)).count() == 0
