"""A stage that breaks off between two ranges, or within one, and goes on."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lintel.operators.resumable import ledger, resumable


class Stop(Exception):
    pass


@pytest.mark.parametrize("within", [False, True])
def test_a_broken_run_goes_on(spark, tmp_path, within):
    rows = [(None if i % 9 == 0 else i % 40, f"t{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k long, t string")
    path, calls = str(tmp_path / "run"), []

    def stage(part):
        calls.append(1)
        if len(calls) == 4:
            if within:  # what a broken job leaves of a range is written over
                part.limit(1).withColumn("n", F.lit(-1)).write.parquet(f"{path}/output/part=3")
            raise Stop
        return part.withColumn("n", F.length("t"))

    with pytest.raises(Stop):
        resumable(df, "k", stage, path, 8)
    assert sorted(r.part for r in ledger(spark, path).collect()) == [0, 1, 2]
    # A second run reads the input of the first.
    out = resumable(df.limit(3), "k", stage, path, 8)
    assert Counter((r.k, r.t, r.n) for r in out.collect()) == Counter((k, t, len(t)) for k, t in rows)
    assert len(calls) == 9 and sorted(r.part for r in ledger(spark, path).collect()) == list(range(8))
    assert resumable(df, "k", stage, path, 8).count() == 500 and len(calls) == 9
    assert sum(r.rows for r in ledger(spark, path).collect()) == 500
    with pytest.raises(ValueError, match="other ranges"):
        resumable(df, "k", stage, path, 4)


def test_empty(spark, tmp_path):
    out = resumable(spark.createDataFrame([], "k long"), "k", lambda d: d.withColumn("x", F.lit(1)), str(tmp_path / "e"), 3)
    assert out.columns == ["k", "x"] and out.count() == 0
