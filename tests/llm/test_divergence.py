"""The audit of sources in tiles of every size against exact integers, and its SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lintel.llm import divergence as D
from lintel.llm import registry
from tests.compare import duck, spark_rows, sql_rows
from tests.llm.test_operators import SCHEMA, SF, TEXTS


def brute(rows, least=3, ranks=200):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in held[lang].items() if n >= least}
        one = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        share = lambda c: {t: 1 + 10**9 * (n + 1) // (sum(c.values()) + len(kept)) for t, n in c.items()}
        p, q = {s: share(one[s]) for s in sources}, share({t: sum(one[s][t] for s in sources) for t in kept})
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if one[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def fixture():
    r = np.random.default_rng(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)] + ["Größe", "ÉTÉ", "niño", "\U0001f600"]
    rows = []
    for i in range(400):
        source = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{int(r.zipf(1.5)) % 40}"
        text = None if i % 31 == 0 else " ".join(r.choice(words, size=int(r.integers(0, 60)), p=None if i % 2 else np.arange(1, 205) / 20910))
        rows.append((text, [None, "", "en", "de"][i % 4], source))
    return rows + [("lone terms only here", "xx", "one"), ("", "xx", "two"), ("42 !!", "yy", "alone")] + [(t, "mix", f"m{i % 3}") for i, (_, t) in enumerate(TEXTS)]


@pytest.mark.parametrize("chunk, block, stripe, gathered", [(8192, 16, 32, 500_000), (7, 2, 3, 20), (1, 1, 1, 1), (50, 5, 1, 100)])
def test_equals_exact_integers(spark, monkeypatch, chunk, block, stripe, gathered):
    for name, value in (("CHUNK", chunk), ("BLOCK", block), ("STRIPE", stripe), ("GATHERED", gathered)):
        monkeypatch.setattr(D, name, value)
    rows = fixture()
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], SCHEMA).withColumnRenamed("n_chars", "value")
    assert sorted(map(tuple, D.audited(docs, ranks=20).collect())) == brute(rows, ranks=20)


def test_shares_of_large_counts():
    """Beyond where a product with SCALE leaves 64 bits."""
    n = np.array([0, 1, 10**10, 3 * 10**14, 9 * 10**14])
    total = 9 * 10**14 + 12_345
    assert D.shares(n, total).tolist() == [1 + 10**9 * (int(x) + 1) // total for x in n]


def test_empty(spark):
    assert D.audited(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql(spark):
    name = "op13_source_divergence"
    assert spark_rows(registry.queries()[name](spark, SF)) == sql_rows(duck(SF), registry.oracle_sql()[name])
