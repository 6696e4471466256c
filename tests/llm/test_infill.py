"""Fill-in-middle at several chunk sizes against one scan of the text, and its SQL."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lintel.llm import infill, registry
from tests.compare import duck, spark_rows, sql_rows
from tests.llm.test_operators import SCHEMA, SF, TEXTS

MORE = [(30, " lead"), (31, "trail  "), (32, "a<P>b c d e"), (33, "x 　 y z\n\n\tw"), (34, "\U0001f600 \U0001f600\U0001f600 " * 9), (35, "<P <S M> P>"), (36, "word " * 3000), (37, " " * 500), (38, "x" * 500)]


def brute(key, text):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or any(m in text for m in infill.MARKS) or h[2] % 100 >= 50:
        return n, "plain", None, None, text, text
    low, high = sorted(x % (n + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text


@pytest.mark.parametrize("chunk, block", [(1, 3), (7, 256), (64, 2), (infill.CHUNK, 256)])
def test_equals_one_scan(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    # A tenth key for each text, so that all forms are met with most texts.
    rows = [(k, t) for k, t in TEXTS + MORE if chunk > 7 or len(t or "") < 600]
    rows += [(100 * k + i, t) for k, t in rows if k for i in range(1, 4) if len(t or "") < 2000]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], SCHEMA).withColumnRenamed("source", "n").withColumnRenamed("lang", "rid")
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in infill.infilled(docs, chunk=chunk).collect())
    assert got == Counter((k, *brute(k, t)) for k, t in rows)


def test_composition_is_associative(spark):
    """All ways to bracket the functions of three chunks give the same, and the unit changes nothing."""
    pieces = ["a", " ", " b", "c ", " d e ", "fg"]
    rows = spark.createDataFrame([(a, b, c) for a in pieces for b in pieces for c in pieces], "a string, b string, c string")
    f = {c: infill.chunk_function(F.col(c)) for c in "abc"}
    left, right = infill.composed(infill.composed(f["a"], f["b"]), f["c"]), infill.composed(f["a"], infill.composed(f["b"], f["c"]))
    whole = infill.chunk_function(F.concat("a", "b", "c"))
    same = lambda x, y: (x["ends"] == y["ends"]) & (x["starts"] == y["starts"])
    unit = same(infill.composed(infill.identity(), f["a"]), f["a"]) & same(infill.composed(f["a"], infill.identity()), f["a"])
    assert rows.filter(~(same(left, right) & same(left, whole) & unit)).count() == 0


def test_empty(spark):
    assert infill.infilled(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql(spark):
    name = "op12_fill_in_middle"
    assert spark_rows(registry.queries()[name](spark, SF)) == sql_rows(duck(SF), registry.oracle_sql()[name])
