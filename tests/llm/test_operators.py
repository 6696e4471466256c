"""The training-data operators against SQL or brute force on a small fixture with every awkward row."""

import hashlib
import heapq
import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lintel.llm import byte_bpe, chat, jaccard, langid, lines, lm, media, quality, registry, shards
from lintel.llm.decontaminate import decontaminate
from tests.compare import duck, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_R = random.Random(5)
_WORDS = "the a data Spark engine table join row Größe été niño über key value stage task plan scan".split()
_LONG = " ".join(_R.choices(_WORDS, k=20_000))
_BASE = [f"w{i}" for i in range(40)]
_NEAR = " ".join(_BASE[:20] + ["other"] + _BASE[21:])
_LINE = "one two three four five six seven eight nine"
TEXTS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "Word"), (5, "two Words"), (6, _LONG), (7, _LONG), (8, " ".join(_BASE)), (9, _NEAR), (10, _NEAR.upper()),
    (11, f"{_LINE}\nfirst\n\n{_LINE}"), (12, f"{_LINE} ten\nfirst"), (13, _LINE.replace("five", "5") + "\nsecond"), (14, _LINE.replace("two ", "")),
    (15, "tie"), (15, "tie"), (16, "\U0001f600 emoji \u00e9\u00e9 \x00 nul"), (17, "!!! ??? 123"), (None, "no id here"), (None, "no id here"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, None if k == 5 else "en", "src", None if t is None else len(t)) for k, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def unique(docs):
    """Without repeated or null ids, for SQL that is written for a key."""
    return docs.filter("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


SQL_NAMES = ["op2_chat_formatting", "op4_line_dedup", "op7_ngram_jaccard", "op8_decontamination"]


@pytest.mark.parametrize("name", SQL_NAMES)
def test_sql(spark, name):
    assert spark_rows(registry.queries()[name](spark, SF)) == sql_rows(duck(SF), registry.oracle_sql()[name])


def words(text, separators=" \t\n\v\f\r"):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in separators:
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def test_lm_scores(docs, empty):
    rows = [(k, t) for k, t in TEXTS]
    train = [t for k, t in rows if zlib.crc32(str(k if k is not None else "").encode()) % 10]
    counts = Counter(w for t in train for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    model = lm.learn(docs.filter("crc32(coalesce(cast(doc_id as string), '')) % 10 != 0"))
    assert (model.n, model.v) == (n, v)
    got = lm.score(docs.withColumn("score", F.lit("clash")), model).collect()
    base = defaultdict(set)
    for k, t in rows:
        some = [*words(t), None]
        base[k].add((len(some), sum(counts[w] > 0 for w in some), round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in some), 3)))
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, round(r.base_score, 3)) in base[r.doc_id]
        assert r.score < 0
    by_joins = lm.score(docs, model, broadcast_bytes=0).collect()
    form = lambda rows: sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in rows)
    assert form(by_joins) == form(got)
    none = lm.learn(empty)
    assert (none.n, none.v) == (0, 0)
    assert lm.score(empty, none).count() == 0
    assert {r.base_score for r in lm.score(docs, none).collect()} == {0.0}


def _exact_score(texts, train, order):
    """Scores with exact counts, quantised as the filter does it but without its errors."""
    def grams(t):
        w = ("</s>", *words(t), "</s>")
        return [w[i + 1 - k : i + 1] for i in range(1, len(w)) for k in range(1, order + 1) if k == 1 or i + 1 - k >= 0]

    counts = Counter(g for t in train for g in grams(t))
    n, v = sum(c for g, c in counts.items() if len(g) == 1), sum(len(g) == 1 for g in counts)
    count = lambda g: lm.COUNT_OF[np.searchsorted(lm.THRESHOLDS, counts[g], side="right")] if counts[g] else 0.0
    out = []
    for t in texts:
        w, total = ("</s>", *words(t), "</s>"), 0.0
        for i in range(1, len(w)):
            p = (count(w[i : i + 1]) + 0.1) / (n + 0.1 * (v + 1))
            for k in range(2, order + 1):
                if i + 1 - k >= 0:
                    g = w[i + 1 - k : i + 1]
                    p = (count(g) + lm.MU * p) / (max(count(g[:-1]), count(g)) + lm.MU)
            total += math.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_lm_scores_against_exact_counts(docs, order):
    """The filter's errors only raise counts; over all tokens they move a score by little."""
    rows = [r.text for r in docs.collect()]
    got = {r.text: (r.score, r.n_tokens) for r in lm.score(docs, lm.learn(docs, order=order)).collect()}
    for t, want in zip(rows, _exact_score(rows, rows, order)):
        score, n = got[t]
        assert abs(score - want) <= 0.5 + 0.02 * n


def test_results_do_not_depend_on_settings(spark, docs):
    """Two numbers of shuffle partitions, and a table whose rows share one key."""
    path = "byte_bpe_multi_50k.tiktoken"
    one = docs.withColumn("doc_id", F.lit(1).cast("long"))
    found = []
    for parts in ("2", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        scores = sorted((r.doc_id or 0, r.text or "", r.score) for r in lm.score(docs, lm.learn(docs)).collect())
        langs = sorted((r.text or "", r.lang_pred, r.score) for r in langid.predicted(one, langid.learned(one, path)).collect())
        near = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.near_duplicates(docs).collect())
        found.append((scores, langs, near))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]
    assert {lang for _, lang, _ in found[0][1]} == {"en", "und"}


CLASHES = "kept items hits _rid _score rid w l in_0 in_1 gone near candidates key lm n lang_pred part name shard _key component_id".split()


@pytest.mark.parametrize("name", ["lines", "decontaminate", "lm", "quality", "langid", "bpe", "jaccard", "shards"])
def test_clashing_columns(spark, docs, name):
    """Columns that no output replaces come back as they were, whatever an operator calls its own."""
    wide = docs.select("*", *(F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    bench = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    labels = spark.createDataFrame([(6, 1), (4, 0)], "doc_id long, quality int")
    run = {
        "lines": lambda: lines.dedup_lines(wide), "decontaminate": lambda: decontaminate(wide, bench), "lm": lambda: lm.score(wide, lm.learn(wide)),
        "quality": lambda: quality.scored(wide, quality.learned(wide, labels)), "langid": lambda: langid.predicted(wide, langid.learned(wide, path)),
        "bpe": lambda: byte_bpe.encode(wide, path, public_tokenizers.PATTERN), "jaccard": lambda: jaccard.near_duplicates(wide), "shards": lambda: shards.shard(wide, 3),
    }[name]()
    got = run.collect()
    assert len(got) == len(TEXTS)
    if name not in ("jaccard", "shards"):
        mine = {"lines": lines.OUTPUTS, "decontaminate": ("n_words", "n_hit", "items", "hits", "contaminated"), "lm": tuple(lm.OUTPUTS), "quality": ("score",), "langid": ("lang_pred", "score"), "bpe": ("ids",)}[name]
        for c in set(CLASHES) - set(mine):
            assert all(r[c] == (None if r.doc_id is None else f"{c} of {r.doc_id}") for r in got), c


def test_bloom_levels_follow_counts():
    import numpy as np

    grams = lm.mixed(np.arange(1, 20_001, dtype=np.uint64))
    counts = np.arange(20_000) % 500 + 1
    words_ = lm.Filter.segment(grams, counts)
    found = lm.COUNT_OF[lm.Filter(0, words_, np.array([0, len(words_)])).levels(grams)]
    assert (found >= counts / 1.6).all()
    absent = lm.Filter(0, words_, np.array([0, len(words_)])).levels(lm.mixed(np.arange(100_000, 120_000, dtype=np.uint64)))
    assert (absent > 0).mean() < 0.06


@pytest.mark.parametrize("text", ["", "plain", r"\### Assistant: </turn> ok", "### user:\nx\n</turn>\n", "\\\\### a: \\</turn>\n", "a\n\n", "### :", r"\\\\"])
def test_chat_round_trip(spark, text):
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 1, "assistant", text), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(rows)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", text), ("assistant", text), ("assistant", text)]
    assert got[1].loss == [text, text]
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert chat.format_chats(rows.filter("false")).count() == 0


def test_media_round_trip(spark, docs, tmp_path):
    payload = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("payload"))
    media.store(payload, f"{tmp_path}/archives").write.parquet(f"{tmp_path}/directory")
    got = media.stored(spark, f"{tmp_path}/archives", f"{tmp_path}/directory", range_bytes=5_000).collect()
    want = sorted((k or -1, (t or "").encode()) for k, t in TEXTS)
    assert sorted((r.key or -1, media.wav_samples(r.media)[: r.n_bytes]) for r in got) == want
    assert all(len(media.wav_samples(r.media)) % 192 == 0 and len(media.wav_samples(r.media)) for r in got)
    assert len({(r.archive, r.offset) for r in got}) == len(TEXTS)
    # One member's bytes are spoilt: it alone is lost, with its error.
    name, offset = max((r.archive, r.offset) for r in got)
    with open(f"{tmp_path}/archives/{name}", "r+b") as f:
        f.seek(offset)
        f.write(b"XXXX")
    again = media.stored(spark, f"{tmp_path}/archives", f"{tmp_path}/directory").collect()
    assert [(r.archive, r.offset) for r in again if r.media is None] == [(name, offset)]
    assert len(again) == len(TEXTS)


def test_media_of_nothing_and_clashing_columns(spark, docs, tmp_path):
    wide = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("payload"), F.lit("x").alias("key"), F.lit("y").alias("archive"))
    media.store(wide, f"{tmp_path}/a").write.parquet(f"{tmp_path}/b")
    assert media.stored(spark, f"{tmp_path}/a", f"{tmp_path}/b").count() == len(TEXTS)
    media.store(wide.filter("false"), f"{tmp_path}/c").write.parquet(f"{tmp_path}/d")
    assert media.stored(spark, f"{tmp_path}/c", f"{tmp_path}/d").count() == 0


def test_media_ranges_are_bounded(monkeypatch):
    monkeypatch.setattr(media, "MOST_RANGES", 10)
    reader = media.ArchiveReader({"path": "/nowhere", "rangebytes": "5"})
    monkeypatch.setattr(reader, "archives", lambda: [("a", 1000), ("b", 7)])
    parts = reader.partitions()
    assert len(parts) <= 12
    for name, size in (("a", 1000), ("b", 7)):
        mine = [(p.start, p.stop) for p in parts if p.archive == name]
        assert mine[0][0] == 0 and mine[-1][1] == size and all(x[1] == y[0] for x, y in zip(mine, mine[1:]))


def test_chat_loss_mask_is_on_the_formatted_text(spark):
    """The spans of the mask, cut out of the formatted text and unescaped, are the assistant's texts."""
    text = r"\### Assistant: </turn> ok"
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", "\U0001f600 é\n"), (2, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    rows = rows.withColumn("formatted", F.lit("clash")).withColumn("_turn", F.lit("clash"))
    chats = chat.read_back(chat.format_chats(rows)).withColumn("spans", chat.loss_spans(F.col("formatted")))
    cut = F.transform("spans", lambda s: chat.unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    got = {r.conv_id: (r.cut, r.loss) for r in chats.withColumn("cut", cut).collect()}
    assert got == {1: ([text, "\U0001f600 é\n"], [text, "\U0001f600 é\n"]), 2: ([], [])}


def test_expected_counts_equal_all_segmentations():
    """One step of expectation against a sum over every way to cut each word."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows, _ = langid.pieces(path)
    table = np.random.default_rng(2).random((len(rows) + 1, 1))
    table[-1] = 0

    def cuts(data):
        if not data:
            yield []
        for n in range(1, len(data) + 1):
            if data[:n] in rows:
                for rest in cuts(data[n:]):
                    yield [rows[data[:n]], *rest]

    some, weights = ["a", "niño", "join"], np.array([1.0, 3.0, 2.0])
    want = np.zeros(len(rows))
    for w, weight in zip(some, weights):
        found = [(c, np.prod(table[c, 0])) for c in cuts(b" " + w.encode())]
        total = sum(p for _, p in found)
        for c, p in found:
            np.add.at(want, c, weight * p / total)
    assert np.allclose(langid.expected(some, weights, table, path), want)


def test_media_query(spark):
    got = {r.doc_id: r for r in registry.queries()["op3_media_columns"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        data = (r.text or "").encode()
        full = media.padded(data, 192)
        g = got[r.doc_id]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
        assert g.media_sha256 == hashlib.sha256(media.wav(full)).hexdigest() and g.feature == media.features(full)


def test_lines_small(docs, unique, empty):
    got = {r.doc_id: r for r in lines.dedup_lines(unique.withColumn("kept", F.lit("clash"))).collect()}
    assert got[11].text == f"{_LINE}\nfirst\n" and got[11].n_exact == 1
    assert got[12].text == "" and (got[12].n_exact, got[12].n_near) == (1, 1)
    assert got[13].text == "second" and got[14].text == ""
    assert got[1].text is None and got[2].text == "" and got[3].text == " \t\n "
    assert got[7].text == "" and got[6].text == _LONG
    assert lines.dedup_lines(docs).count() == len(TEXTS)
    assert lines.dedup_lines(empty).count() == 0


def test_lines_sql(spark, unique):
    got = lines.dedup_lines(unique.select("doc_id", "text"))
    got = got.select("doc_id", "n_lines", "n_exact", "n_near", "kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    frame = unique.toArrow()
    assert spark_rows(got) == sql_rows(duck(SF, documents=frame), registry.oracle_sql()["op4_line_dedup"])


def test_lines_survive_a_collision(spark):
    """Two first words of one 40-bit hash: the earliest line of their key is no partner and must not hide the true one."""
    hashes = [spark.range(1).select(F.shiftrightunsigned(F.xxhash64(F.lit(w), F.lit(0)), 24)).first()[0] for w in ("v202589", "v310849")]
    assert hashes[0] == hashes[1]
    rest = "r2 r3 r4 r5 r6 r7 r8"
    rows = [(1, f"v202589 x {rest}"), (2, f"v310849 y {rest}"), (3, f"v310849 z {rest}")]
    got = {r.doc_id: r.n_near for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 1}


def test_lines_work(spark, monkeypatch):
    """Lines are lower-cased outside of the generator, which would do it for each mention; half of a line's variants do if a half is shared."""
    frames, write = {}, lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: frames.setdefault(name, write(df, name)) if name != "lines" else frames.setdefault("plan", df) and write(df, name))
    base = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "other"]))]
    got = {r.doc_id: r.n_near for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1}
    plan = frames["plan"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and not [x for x in plan.splitlines() if "Generate" in x and "lower(" in x]
    assert frames["lines-variants"].count() <= 2 * (2 * 21 + 1) < 2 * (2 * 40 + 1)


@pytest.mark.parametrize("near_words", [1, 2, 8])
def test_lines_brute_force(spark, near_words):
    """Runs of one word, and edits at either end, in the middle and on both sides of it, for lines of even and odd length."""
    pick = random.Random(near_words)
    found = {}
    for k in range(400):
        line = pick.choices(["a", "b", "\u00c9"], weights=[8, 2, 1], k=near_words + pick.randrange(7)) if k % 4 < 2 else list(pick.choice(list(found.values())))
        at = pick.randrange(len(line))
        line[at : at + pick.randrange(2)] = ["c"] * pick.randrange(2)
        found[k] = line or ["a"]
    rows = [(k, "\t".join(w).upper() if k % 5 else " ".join(w) + " ") for k, w in found.items()]

    def edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    seen, want = [], {}
    for k, w in found.items():
        near = len(w) >= near_words and any(len(x) >= near_words and edit(x, w) for x in seen)
        want[k] = (int(w in seen), int(near and w not in seen))
        seen += [] if w in seen else [w]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), near_words=near_words)
    assert {r.doc_id: (r.n_exact, r.n_near) for r in got.collect()} == want
    assert 20 < sum(n for _, n in want.values())


def test_quality(spark):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen, unseen = (labels.filter(f"crc32(cast(doc_id as string)) % 5 {op} 0") for op in ("!=", "="))
    trees = quality.learned(sample, seen)
    rows = quality.scored(sample.withColumn("score", F.lit("clash")), trees).join(unseen, "doc_id").select("score", "quality").collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in rows) >= 0.9 * len(rows)
    # The flattened trees give what walking each by itself gives.
    x = quality.matrix(pa.array([r.text for r in sample.limit(50).collect()]))

    def walk(row, at):
        while trees.left[at] != at:
            at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        return trees.value[at]

    want = [1 / (1 + math.exp(-(trees.base + sum(walk(row, r) for r in trees.roots)))) for row in x]
    assert trees.scores(x) == pytest.approx(want)


def test_quality_awkward(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1), (6, 0), (15, None), (None, 1)], "doc_id long, quality int")
    trees = quality.learned(docs, labels)
    assert all(0 <= r.score <= 1 for r in quality.scored(docs, trees).collect())
    none = quality.learned(empty, labels.filter("false"))
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(empty, none).count() == 0


def test_shards(docs, empty):
    got = shards.shard(docs, 4).collect()
    assert len(got) == len(TEXTS)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    text = {k: t for k, t in TEXTS if k is not None}
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 16 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in got if r.doc_id is not None)
    where = defaultdict(set)
    for r in got:
        if r.doc_id is not None:
            where[text[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    assert shards.shard(empty, 4).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 5000), st.integers(1, 300), max_size=8), st.integers(1, 40))
def test_schedule_equals_plain_lpt(sizes, n):
    loads, want = [(0, shard) for shard in range(n)], Counter()
    for size in sorted(sizes, reverse=True):
        for _ in range(sizes[size]):
            load, shard = heapq.heappop(loads)
            want[size, shard] += 1
            heapq.heappush(loads, (load + size, shard))
    got, ranks = Counter(), defaultdict(list)
    for size, shard, a, b in shards.schedule(list(sizes.items()), n):
        got[size, shard] += b - a
        ranks[size] += range(a, b)
    assert got == want and all(ranks[size] == list(range(count)) for size, count in sizes.items())


def test_shards_equal_plain_lpt_over_all_groups(spark):
    """The whole query against a heap over every group by itself."""
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = registry.queries()["op6_sharding"](spark, sf).collect()
    assert len(got) == len(text)
    where, total = {}, Counter()
    for r in got:
        assert where.setdefault(text[r.doc_id], r.shard) == r.shard
        total[text[r.doc_id]] += r.size
    loads, want = [(0, shard) for shard in range(40)], Counter()
    for size in sorted(total.values(), reverse=True):
        load, shard = heapq.heappop(loads)
        want[size, shard] += 1
        heapq.heappush(loads, (load + size, shard))
    assert Counter((total[t], shard) for t, shard in where.items()) == want


def test_shards_near_equal(spark):
    loads = Counter()
    for r in registry.queries()["op6_sharding"](spark, "/root/testdata/sf0.01").collect():
        loads[r.shard] += r.size
    assert set(loads) == set(range(40)) and max(loads.values()) <= 1.05 * min(loads.values())


def test_jaccard_brute_force(docs, empty):
    """Random near copies and every awkward row, against all pairs."""
    r = random.Random(3)
    texts = [(k, t) for k, t in TEXTS if k is not None and k != 15]
    for g in range(12):
        base = [f"g{g}x{i}" for i in range(r.randint(3, 60))]
        for c in range(8):
            t = list(base)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = f"new{r.randrange(99)}"
            texts.append((1000 + 10 * g + c, " ".join(t)))
    sets = {}
    for k, t in texts:
        w = words(t)
        size = min(5, len(w))
        sets[k] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    got = jaccard.near_duplicates(docs.sparkSession.createDataFrame(texts, "doc_id long, text string"))
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got.collect()) == sorted((k, len(sets[k]), top(k)) for k in keys)
    assert jaccard.near_duplicates(docs).count() == len(TEXTS)
    assert jaccard.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bits", [5, 8, 16, 24])
def test_jaccard_segments_keep_all_bits(monkeypatch, bits):
    """Shingles of one segment that differ in any one bit stay apart, and come back whole."""
    x, y = 0xFEDCBA9876543210, 0x0123456789ABCDEF
    near = {x} | {x ^ 1 << i for i in range(bits, 64)}
    sets = [np.array(sorted({s, y}), np.uint64) for s in sorted(near)]
    monkeypatch.setattr(jaccard, "shingle_sets", lambda texts, words: sets)
    monkeypatch.setattr(jaccard, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))), pa.array(["text"] * len(sets))], ["key", "text"])
    packed = pa.Table.from_batches(list(jaccard._pack(bits, 5)([batch])))
    got = []
    for to in sorted(set(packed["to"].to_pylist())):
        if to < 1 << bits:
            back = jaccard._segment(bits)(packed.filter(pa.array([t == to for t in packed["to"].to_pylist()])))
            got += [int(s) for part in back["shingles"] for s in np.frombuffer(part.as_py(), np.uint64)]
    assert got == [y] * len(sets)


def test_decontamination_small(spark, docs, empty):
    bench = spark.createDataFrame([(1, " ".join(_BASE[:15])), (2, "TWO, words!"), (3, None), (4, "?"), (None, "word")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(docs.withColumn("hits", F.lit("clash")), bench).collect()}
    assert (got[8].n_hit, got[8].items, got[8].contaminated) == (15, ["1"], True)
    assert (got[5].n_words, got[5].n_hit, got[5].contaminated) == (2, 2, True)
    assert (got[1].n_words, got[1].n_hit, got[1].contaminated) == (0, 0, False)
    assert decontaminate(docs, bench.filter("false")).filter("contaminated").count() == 0
    assert decontaminate(empty, bench).count() == 0


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        import base64

        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_bpe_equals_library(docs, ranks, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = byte_bpe.encode(docs.withColumn("ids", F.lit("clash")), path, public_tokenizers.PATTERN, back="decoded").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert r.ids == ranks.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encode(empty, path, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120))
def test_bpe_any_text(ranks, encoder, text):
    assert list(encoder.encode(text)) == ranks.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text("abcdefgh nteriosu", max_size=60), st.text("abcdefgh nteriosu", max_size=20), st.data())
def test_bpe_append_and_edit(encoder, text, new, data):
    raw, more = text.encode(), new.encode()
    table = byte_bpe.PrefixTable(encoder.vocabulary, raw)
    table.append(more)
    assert table.ids() == byte_bpe.PrefixTable(encoder.vocabulary, raw + more).ids()
    a = data.draw(st.integers(0, len(raw)))
    b = data.draw(st.integers(a, len(raw)))
    table = byte_bpe.PrefixTable(encoder.vocabulary, raw)
    table.replace(a, b, more)
    assert table.ids() == byte_bpe.PrefixTable(encoder.vocabulary, raw[:a] + more + raw[b:]).ids()


def test_langid(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learned(sample.filter("crc32(cast(doc_id as string)) % 5 != 0"), path)
    rows = langid.predicted(sample.filter("crc32(cast(doc_id as string)) % 5 = 0"), model).collect()
    known = [r for r in rows if r.lang is not None and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in known) >= 0.97 * len(known)
    odd = {r.doc_id: r for r in langid.predicted(docs.withColumn("score", F.lit("clash")), model).collect()}
    assert [odd[k].lang_pred for k in (1, 2, 3, 17)] == ["und"] * 4 and odd[1].score == 0
    none = langid.learned(empty, path)
    assert {r.lang_pred for r in langid.predicted(docs, none).collect()} == {"und"}
    assert langid.predicted(empty, model).count() == 0


def test_langid_rare_language_and_equal_keys(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = [(None, f"the engine reads {i} tables", "en") for i in range(3000)] + [(None, "größe schön", "de")] * 2 + [(None, "el niño juega", "es")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learned(labelled, path, sample=10)
    assert model.languages == ["de", "en", "es"]
    assert np.allclose(model.priors, np.log([3, 3001, 2]))
    asked = spark.createDataFrame([(1, "schön größe größe"), (2, "the tables"), (3, "niño juega niño")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predicted(asked, model).collect()} == {1: "de", 2: "en", 3: "es"}


def test_langid_forward_equals_all_segmentations():
    """The forward sum against a recursion over every way to cut a word."""
    import numpy as np

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows, _ = langid.pieces(path)
    table = np.random.default_rng(1).random((len(rows) + 1, 2))
    table[-1] = 0

    def total(data):
        if not data:
            return np.ones(2)
        return sum((table[rows[data[:n]]] * total(data[n:]) for n in range(1, len(data) + 1) if data[:n] in rows), np.zeros(2))

    some = ["a", "größe", "spark", "niño"]
    want = np.log([total(b" " + w.encode()) for w in some])
    assert np.allclose(langid.log_probabilities(some, table, path), want)


def test_registry_columns_are_json_safe():
    assert json.dumps(sorted(registry.queries()))
