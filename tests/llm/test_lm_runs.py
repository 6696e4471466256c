"""op1 without a broadcast: what is moved is in proportion to the texts, and runs of texts score as the whole model does."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from lintel.llm import lm

TEXTS = [None, "", " \t\n ", "Word", "word two", "a b a b a b", "Größe \x00 Ω", *(" ".join(random.Random(k).choices("the a data Spark row ÉÉ été x".split(), k=3 * k)) for k in range(40))]


def test_what_is_moved_follows_the_texts(spark, monkeypatch):
    """Tables in the shared folder and shuffles together take less than the texts themselves, where one row for each gram of a text took many times as much."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    model = lm.learn(docs)
    tables = []
    written = lm.written
    monkeypatch.setattr(lm, "written", lambda df, name: tables.append(written(df, name)) or tables[-1])
    shuffled = lambda: sum(x.totalShuffleWrite() for x in _listed(spark))
    before = shuffled()
    assert lm.score(docs, model, broadcast_bytes=0).select("doc_id", "score").filter("score < 0").count() == docs.count()
    tables = sum(pa.fs.FileSystem.from_uri(x)[0].get_file_info(pa.fs.FileSystem.from_uri(x)[1]).size for t in tables for x in t.inputFiles())
    assert tables < 0.6 * size
    assert tables + shuffled() - before < 2.2 * size


def _listed(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("order", [1, 2, 4])
def test_runs_score_as_the_model_does(monkeypatch, order):
    """Runs and chunks of a few texts; half of the texts were not learned, so their grams meet segments without them, or none."""
    monkeypatch.setattr(lm, "RUN_BYTES", 200)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 60)
    monkeypatch.setattr(lm, "RUN_TOKENS", 30)
    monkeypatch.setattr(lm, "LOOKED_UP", 7)
    bits = 6
    counted = pa.Table.from_batches(lm._runs(bits, order)([pa.RecordBatch.from_arrays([pa.array(TEXTS[::2], pa.string())], ["text"])]))
    of = lambda table, kind, seg: table.filter(pc.and_(pc.equal(table["kind"], kind), pc.equal(table["seg"], seg)))
    segments = pa.concat_tables([lm._summed(bits)(of(counted, kind, seg)) for kind in range(order) for seg in range(1 << bits) if len(of(counted, kind, seg))])
    n, v = (sum(x for x, kind in zip(segments[c].to_pylist(), segments["kind"].to_pylist()) if kind == 0) for c in ("n", "v"))

    filters = []
    for kind in range(order):
        rows = {r["seg"]: r["bits"] for r in segments.to_pylist() if r["kind"] == kind}
        words = [np.frombuffer(rows.get(seg, b""), np.uint64) for seg in range(1 << bits)]
        filters.append(lm.Filter(bits, np.concatenate(words), np.concatenate([[0], np.cumsum([len(w) for w in words])]), 64 - bits - lm.name_bits(kind, bits)))
    learned = [t for t in TEXTS[::2]]
    grams, counts = np.unique(np.concatenate([lm.tokens([(t or "").encode()])[0] for t in learned]), return_counts=True)
    assert (n, v) == (counts.sum(), len(grams))
    want = lm.Model(filters, grams, counts, n, v).score(TEXTS)

    ids = pa.array(range(len(TEXTS)), pa.int64())
    packed = list(lm._packed([pa.RecordBatch.from_arrays([ids, pc.negate(ids), pa.array(TEXTS, pa.string())], ["a", "b", "text"])]))
    assert len(packed) > 5
    packed = [pa.Table.from_batches([b]).append_column("run", pa.array([i], pa.int64())) for i, b in enumerate(packed)]
    asked = pa.Table.from_batches(lm._asked(bits, order)([b for t in packed for b in t.to_batches()]))
    answers = pa.concat_tables([lm._answered(bits)(of(asked, kind, seg), of(segments, kind, seg)) for kind in range(order) for seg in range(1 << bits)])
    got = pa.concat_tables([lm._finished(order, n, v)(t, answers.filter(pc.equal(answers["run"], i))) for i, t in enumerate(packed)])
    assert got["a"].to_pylist() == ids.to_pylist() and got["b"].to_pylist() == pc.negate(ids).to_pylist()
    for name, column in zip(lm.OUTPUTS, want):
        assert np.allclose(got[name].to_numpy(), column, rtol=1e-12, atol=0), name


def test_numbers_come_back():
    for values in ([], [0], [0] * 9, [255, 256], [2**64 - 1, 0, 5], list(range(70_000))):
        values = np.array(values, np.uint64)
        assert (lm.unblob(lm.blob(values), len(values)) == values).all()
