"""Personal data: base spans against the plain patterns, message passing against sums over all labellings, and what the field adds."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lintel.llm import private as P
from lintel.llm import registry
from tests.compare import duck
from tests.llm.test_operators import SCHEMA, SF, TEXTS

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": 8 <= len(digits) <= 15}
            if good[kind]:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    pieces = [*"@.+-() 0129aZ_%é\U0001f600\n", "4871316720949013", "255", "256", "10.0.0.1", "+1 499", "mail.example", "4539 1488 0343 6467"]
    for _ in range(20_000):
        text = "".join(r.choices(pieces, k=r.randint(0, 24)))
        assert P.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    n = 300_000
    for text in ("a" * n, "1" * n, "1." * n, "a" * n + "@", "@" * n, "+1" + " " * n, "1 " * n, "a@" + "b" * n, "a" + "%" * n, "中" * n + "1"):
        assert all(0 <= a < b <= len(text) for _, a, b in P.base_spans(text))
        P.Graph(text, [])


def test_messages_equal_sums_over_labellings():
    """On a tree, where message passing is exact, and close to exact where there is a loop."""
    r = np.random.default_rng(1)
    pair = r.normal(size=(3, P.LABELS, P.LABELS)) / 2
    model = P.Model(r.normal(size=(P.FEATURES, P.LABELS)) / 2, (pair + pair.transpose(0, 2, 1)) / 2)
    for text, bound in (("call 123456 then 12345 77 and 123456 now", 1e-3), ("12345 99999 x 12345 99999", 0.1)):
        g = P.Graph(text, [])
        own = P.one_hot(np.array(g.features)) @ model.unary
        total = np.zeros((len(g.tokens), P.LABELS))
        for labels in itertools.product(range(P.LABELS), repeat=len(g.tokens)):
            p = np.exp(sum(own[i, y] for i, y in enumerate(labels)) + sum(model.pair[s, labels[a], labels[b]] for a, b, s in g.edges))
            for i, y in enumerate(labels):
                total[i, y] += p
        assert np.abs(model.marginals([g]) - total / total.sum(1, keepdims=True)).max() < bound


@pytest.fixture(scope="module")
def model(spark):
    return P.learned(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def added(model, text):
    base = P.base_spans(text)
    return [(k, text[a:b]) for k, a, b in model.added([text], [base])[0]]


def test_repeated_mentions_get_the_kind(model):
    text = "call +1 (499) 555-6503 today. " + "some words in between. " * 50 + "Again 499-555-6503, or 5556503, or 555-6504 in 2019."
    assert added(model, text) == [("phone", "499-555-6503"), ("phone", "5556503")]


def test_nothing_to_repeat_adds_nothing(model):
    for text in ("", "in 2019 there were 12345678 of 555-6503", "pay 4871316720949014 to 10.0.0.999", "at +1 (499) 555-6503 in 2019"):
        assert added(model, text) == []


def test_batches_do_not_matter(model):
    texts = ["call +1 (499) 555-6503 or 5556503", "mail a.b09@mail5.example.com or a.b09", "+44 20 7946 0958 and 79460958"]
    base = [P.base_spans(t) for t in texts]
    assert model.added(texts, base) == [model.added([t], [b])[0] for t, b in zip(texts, base)]


def test_awkward_rows(spark, model):
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in TEXTS], SCHEMA).withColumnRenamed("source", "base").withColumn("private_0", F.lit(1))
    got = P.tagged(docs, model).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(TEXTS)
    for r in got:
        assert [tuple(s) for s in r.base] == brute(r.text or "")
        assert set(r.base) <= set(r.spans)
    nothing = P.learned(docs.limit(0))
    assert not nothing.unary.any() and P.tagged(docs.limit(0), nothing).count() == 0


def test_query(spark):
    texts = dict(duck(SF).execute("select doc_id, coalesce(text, '') from documents").fetchall())
    got = registry.queries()["op11_personal_data"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    import hashlib

    for r in got:
        base = [":".join(map(str, s)) for s in brute(texts[r.doc_id])]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert set(base) <= set(r.spans.split(",")) or not base
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in PATTERNS]
