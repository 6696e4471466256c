"""Each stage of the pipeline on what the one before it kept, against SQL or a brute-force version."""

import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from lintel.llm import registry
from lintel.storage import table, written
from tests.compare import duck

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    sql = registry.oracle_sql()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_duplicates", "decontamination", "encoding"]
    docs = table(spark, SF, "documents")
    scores = {r.doc_id: r.score for r in registry.queries()["op5_quality_classifier"](spark, SF).collect()}

    good = written(stages["quality"](spark, docs, SF), "test")
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {k for k, s in scores.items() if s >= 0.3}

    con = duck(SF, documents=good.toArrow())
    want = {r[0]: r[1] for r in con.execute(f"select doc_id, text_sha256 from ({sql['op4_line_dedup']}) where kept > 0 or n_lines = 0").fetchall()}
    cut = written(stages["lines"](spark, good, SF), "test")
    assert {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)

    con = duck(SF, documents=cut.toArrow())
    want = {r[0] for r in con.execute(f"select doc_id from ({sql['op7_ngram_jaccard']}) where doc_id = component_id").fetchall()}
    apart = written(stages["near_duplicates"](spark, cut, SF), "test")
    assert {r.doc_id for r in apart.collect()} == want

    con = duck(SF, documents=apart.toArrow())
    want = {r[0] for r in con.execute(f"select doc_id from ({sql['op8_decontamination']}) where not contaminated").fetchall()}
    clean = written(stages["decontamination"](spark, apart, SF), "test")
    assert {r.doc_id for r in clean.collect()} == want

    import base64

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in stages["encoding"](spark, clean, SF).collect():
        ids = library.encode_ordinary(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_one_row_of_each_component(spark):
    """Repeated rows, rows without an id, one id with two texts, and texts without words."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (5, a), (3, a), (None, a), (None, b), (None, b), (7, c), (8, d), (8, c), (9, ""), (9, ""), (None, None)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), "test")
    got = [tuple(r) for r in corpus_pipeline.near_copies(spark, docs, SF).collect()]
    want = [(3, a), (None, b), (7, c), (8, d), (9, ""), (9, ""), (None, None)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def _documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with an operator's names."""
    body = " ".join(f"word{i} stands here" for i in range(30))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, body), (4, body), (5, body + " end"), (None, "one line\nanother line"), (None, None), (6, "long " * 30_000), (7, "x\n\nx")]
    names = ["kept", "items", "hits", "_rid", "_score", "_row", "n_lines", "contaminated", "component_id", "key", "rid"]
    rows = [(k, t, None, "src", -1, *(f"{n} {i}" for n in names)) for i, (k, t) in enumerate(texts)]
    return names, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))


def test_stages_leave_other_columns_alone(spark):
    names, docs = _documents(spark)
    docs = written(docs, "test")
    before = {r.kept: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert rows and len({r.kept for r in rows}) == len(rows), name
        for r in rows:
            was = before[r.kept]
            assert [r[c] for c in ("doc_id", "source", *names)] == [was[c] for c in ("doc_id", "source", *names)], name
            assert r.text == was.text or name == "lines"
            assert r.n_chars == was.n_chars or name == "lines" and r.n_chars == (None if r.text is None else len(r.text))
    last = corpus_pipeline.encoding(spark, docs, SF).collect()
    assert len(last) == len(before) and all(r.hits == before[r.kept].hits for r in last)


def test_stages_of_an_empty_table(spark):
    _, docs = _documents(spark)
    empty = written(docs.filter("false"), "test")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_hits_are_computed_once(spark):
    """The filter on the decision does not repeat the verification, which alone asks for the partition's number."""
    plan = corpus_pipeline.decontamination(spark, table(spark, SF, "documents"), SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("SPARK_PARTITION_ID()") == 1
