"""LM scoring with a log-frequency Bloom filter.

Training counts every word and every run of two to ``order`` words.  A count is
quantised to a level (its place among thresholds that grow by half), and a gram
of level q puts q keys, (gram, 1) to (gram, q), into a Bloom filter.  Scoring asks
for (gram, 1), (gram, 2) ... until a key is absent; the last present level gives
the count back.  A token's probability is smoothed from the shorter gram's:

    p(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)),
    p(w | h) = (c(h w) + MU * p(w | h')) / (max(c(h), c(h w)) + MU),

with h' the context h without its first word, and counts from the filter.  Before
a text's first word stands an end; contexts do not reach further back.

Grams are 64-bit hashes.  Tasks count the grams of some MB of text at a time with
numpy and send sorted runs, cut into segments by the hash's top bits; each
segment is summed in a task of its own, which also builds the segment's part of
the filter, sized for its own grams.  So the filter grows with the corpus at a
constant error rate: one absent key in 2^PROBES counts as present, which takes a
gram's count up by one level.  The number of segments follows from the bytes of
the texts alone, so results do not depend on a session's settings.

``order`` is two unless the caller asks for more: of 0.5 GB of documents, filter and
counts of words and pairs take 113 MB, triples 92 MB more.

Grams move as the differences of their sorted hashes, in compressed planes of
bytes.  A run of words keeps the bits that name its segment and ``NAME_BITS`` more,
so that within a segment fewer than one in 10^5 share their name with another.

Filter and word counts are broadcast while they take at most ``BROADCAST_BYTES``
together; larger ones stay in their segments.  The texts are packed into runs of
``RUN_BYTES``, whose distinct grams go to the segments; back come levels and counts
alone, in the order of the grams, which the run finds again from its texts.  Results
are equal, and all that is moved is in proportion to the texts.

Defined results: null texts count as empty and have one token, the end; repeated
rows are learned from and scored each by itself; with no training rows N = V = 0
and every text has base score 0; other columns are kept, whatever their names,
and a column with an output's name is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.llm.words import row_name, set_aside
from lintel.storage import written

#: Small, so that a model takes little of every Python worker's memory.
BROADCAST_BYTES = 8 << 20
PROBES, MU, ADD, ORDER = 5, 4.0, 0.1, 2
#: Bytes of texts for each segment of a kind; a task holds one segment's grams of all runs.
SEGMENT_BYTES = 16 << 20
CHUNK_BYTES, RUN_TOKENS, RUN_BYTES = 1 << 20, 2_000_000, 16 << 20
#: What a text counts in a run besides its bytes.
TEXT_BYTES = 8
#: Bits that name a run of words within its segment.
NAME_BITS = 40
#: Grams that are put into a filter or looked up at once.
LOOKED_UP = 250_000
OUTPUTS = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
END = _U(0x9E3779B97F4A7C15)

THRESHOLDS = np.array(sorted({int(np.ceil(1.5**q)) for q in range(90)}), np.float64)
#: Count that stands for each level: the geometric mean of its range.
COUNT_OF = np.concatenate([[0.0], np.sqrt(THRESHOLDS[:-1] * np.maximum(THRESHOLDS[:-1], THRESHOLDS[1:] - 1)), THRESHOLDS[-1:]])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text's words, and where each text starts."""
    data = np.frombuffer(b"".join(t.translate(_LOWER) + b" " for t in texts), np.uint8)
    inside = ~_BLANK[data]
    at = np.flatnonzero(inside)
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    words = np.searchsorted(starts, ends)
    if len(starts):
        lengths = stops - starts
        place = at - np.repeat(starts, lengths)
        powers = np.cumprod(np.concatenate([[_U(1)], np.full(int(lengths.max()), _U(0x5851F42D4C957F2D))]))
        values = _BYTE[data[at]] * powers[place]
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        hashes = mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    out = np.full(len(hashes) + len(texts), END)
    keep = np.ones(len(out), bool)
    keep[words + np.arange(len(texts))] = False
    out[keep] = hashes
    return out, np.concatenate([[0], words[:-1] + np.arange(1, len(texts))]).astype(np.int64)


def contexts(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The token before each; before a text's first stands an end."""
    before = np.empty_like(grams)
    before[1:] = grams[:-1]
    before[starts] = END
    return before


def pairs(before: np.ndarray, grams: np.ndarray) -> np.ndarray:
    return mixed(before * _U(0xD1342543DE82EF95) + grams)


def longer(grams: np.ndarray, starts: np.ndarray, order: int):
    """(grams, contexts, whether there is one) of two words, three, ... up to ``order``, for every token."""
    head, valid = contexts(grams, starts), np.ones(len(grams), bool)
    for size in range(2, order + 1):
        both = pairs(head, grams)
        yield both, head, valid
        # The next context is this gram, one token earlier; the first tokens have none so long.
        head, valid = contexts(both, starts), np.concatenate([[False], valid[:-1]]) if len(valid) else valid
        valid[starts] = False


def chunks(texts: list):
    """Texts as bytes in runs of some MB."""
    some, size = [], 0
    for t in texts:
        some.append((t or "").encode())
        size += len(some[-1])
        if size >= CHUNK_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def blob(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, behind the number of planes."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unblob(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of a ``blob``."""
    width, out = data[0], np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data[1:], width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def name_bits(kind: int, bits: int) -> int:
    """Bits that name a gram within its segment: all of a word's, for exact counts."""
    return NAME_BITS if kind else 64 - bits


def cut(kind: int, grams: np.ndarray, bits: int):
    """(segment, from, to, names) of sorted grams; names: the differences of what names them, as a blob."""
    edges = np.searchsorted(grams, np.arange(1 << bits, dtype=np.uint64) << _U(64 - bits))
    width = name_bits(kind, bits)
    names = (grams >> _U(64 - bits - width)) & _U((1 << width) - 1)
    for seg, (a, b) in enumerate(zip(edges.tolist(), [*edges[1:].tolist(), len(grams)])):
        if b > a:
            yield seg, a, b, blob(np.diff(names[a:b], prepend=_U(0)))


def keys(kind: int, seg: int, bits: int, names: list[bytes], sizes: list[int]) -> np.ndarray:
    """The grams of many runs in one segment, run by run, as its filter knows them."""
    out = filled((np.cumsum(unblob(x, n), dtype=np.uint64) for x, n in zip(names, sizes)), sizes, np.uint64)
    out |= _U(seg << name_bits(kind, bits))
    return out


def filled(parts, sizes: list[int], kind: type) -> np.ndarray:
    """Parts of these sizes one after the other, without holding them besides."""
    out, at = np.empty(sum(sizes), kind), 0
    for part, size in zip(parts, sizes):
        out[at : at + size] = part
        at += size
    return out


class Filter:
    """Segments of a log-frequency Bloom filter, one after the other; 2^bits segments by the hash's top bits; ``drop``: lower bits that it doesn't know."""

    def __init__(self, bits: int, words: np.ndarray, starts: np.ndarray, drop: int = 0):
        self.bits, self.words, self.starts, self.drop = bits, words, starts, drop
        self.sizes = np.diff(starts).astype(np.uint64) * _U(64)

    @staticmethod
    def segment(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bits of one segment's grams."""
        levels = np.searchsorted(THRESHOLDS, counts, side="right")
        keys = int(levels.sum())
        words = np.zeros(max(1, int(np.ceil(keys * PROBES * 1.4427 / 64))), np.uint64)
        size = _U(len(words) * 64)
        for at in range(0, len(grams), LOOKED_UP):
            part, most = grams[at : at + LOOKED_UP], levels[at : at + LOOKED_UP]
            for level in range(1, int(most.max(initial=0)) + 1):
                some = part[most >= level]
                for probe in range(PROBES):
                    bit = _bit(some, level, probe) % size
                    np.bitwise_or.at(words, (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
        return words

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each gram, by repeated membership probes."""
        return np.concatenate([self._levels(some) for some in np.split(grams, range(LOOKED_UP, len(grams), LOOKED_UP))])

    def _levels(self, grams: np.ndarray) -> np.ndarray:
        found = np.zeros(len(grams), np.uint8)
        live = np.arange(len(grams))
        part = (grams >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(grams), np.int64)
        size, start = self.sizes[part], self.starts[part]
        grams = grams >> _U(self.drop)
        live = live[size > 0]
        for level in range(1, len(THRESHOLDS) + 1):
            for probe in range(PROBES):
                bit = _bit(grams[live], level, probe) % size[live]
                word = self.words[start[live] + (bit >> _U(6)).astype(np.int64)]
                live = live[(word >> (bit & _U(63))) & _U(1) != 0]
            if not len(live):
                break
            found[live] = level
        return found


def _bit(grams: np.ndarray, level: int, probe: int) -> np.ndarray:
    return mixed(grams + _U((level * 64 + probe) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


class Model:
    """Filters by length of gram, exact word counts by sorted hash, and totals."""

    def __init__(self, filters: list[Filter], known: np.ndarray, counts: np.ndarray, n: int, v: int):
        self.filters, self.known, self.counts, self.n, self.v = filters, known, counts, n, v

    def score(self, texts: list) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        parts = [self._score(some) for some in chunks(texts)]
        return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0)] * 4

    def _score(self, some: list[bytes]):
        grams, starts = tokens(some)
        distinct, which = np.unique(grams, return_inverse=True)
        exact = np.zeros(len(distinct))
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            exact = np.where(self.known[at] == distinct, self.counts[at], 0).astype(np.float64)
        levels = lambda kind, grams: self.filters[kind].levels(grams) if kind else self.filters[0].levels(distinct)[which]
        return sums(grams, starts, exact[which], levels, len(self.filters), self.n, self.v)


def sums(grams: np.ndarray, starts: np.ndarray, exact: np.ndarray, levels: Callable, order: int, n: int, v: int) -> list[np.ndarray]:
    """n_tokens, n_known, base_score and score of each text from its tokens' exact counts; levels(kind, grams): the filter's."""
    total = n + ADD * (v + 1)
    count = COUNT_OF[levels(0, grams)]
    p = (count + ADD) / total
    first = count[-1]  # a run of tokens ends with an end
    for kind, (both, _, valid) in enumerate(longer(grams, starts, order), 1):
        # A context's count is that of the shorter gram, one token earlier.
        around = np.concatenate([[first], count[:-1]])
        around[starts] = first
        count = np.zeros(len(grams))
        count[valid] = COUNT_OF[levels(kind, both[valid])]
        p = np.where(valid, (count + MU * p) / (np.maximum(around, count) + MU), p)
    summed = lambda x: np.add.reduceat(x, starts)
    return [np.diff(np.append(starts, len(grams))), summed((exact > 0).astype(np.int64)), summed(np.log10((exact + ADD) / total)), summed(np.log10(p))]


RUN = "kind int, seg int, n int, names binary, counts binary"
SEGMENT = "kind int, seg int, bits binary, names binary, counts binary, n long, v long"


def _runs(bits: int, order: int):
    """Sorted runs of counted grams, cut into segments; kind: words of a gram less one."""

    def rows(kind: int, grams: np.ndarray):
        distinct, counts = np.unique(grams, return_counts=True)
        for seg, a, b, names in cut(kind, distinct, bits):
            yield kind, seg, b - a, names, blob(counts[a:b])

    def run(batches):
        held: list[list[np.ndarray]] = [[] for _ in range(order)]
        size = 0

        def flush():
            found = [row for kind in range(order) if held[kind] for row in rows(kind, np.concatenate(held[kind]))]
            names = ["kind", "seg", "n", "names", "counts"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names)

        for batch in batches:
            for some in chunks(batch.column(0).to_pylist()):
                grams, starts = tokens(some)
                held[0].append(grams)
                for kind, (both, _, valid) in enumerate(longer(grams, starts, order), 1):
                    held[kind].append(both[valid])
                size += len(grams)
                if size >= RUN_TOKENS:
                    yield flush()
                    held, size = [[] for _ in range(order)], 0
        if size:
            yield flush()

    return run


def _summed(bits: int):
    def run(table: pa.Table) -> pa.Table:
        """One segment: exact counts of its grams and their filter."""
        kind, seg, sizes = table["kind"][0].as_py(), table["seg"][0].as_py(), table["n"].to_pylist()
        grams = keys(kind, seg, bits, table["names"].to_pylist(), sizes)
        counts = filled((unblob(x, n) for x, n in zip(table["counts"].to_pylist(), sizes)), sizes, np.int64)
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        grams, counts = grams[first], np.add.reduceat(counts, first)
        known = (blob(np.diff(grams, prepend=_U(0))), blob(counts)) if kind == 0 else (b"", b"")
        row = {"kind": kind, "seg": seg, "bits": Filter.segment(grams, counts).tobytes(), "names": known[0], "counts": known[1], "n": int(counts.sum()), "v": len(grams)}
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.table({k: pa.array([x], t) for (k, x), t in zip(row.items(), types)})

    return run


class Learned:
    """Segments of filter and counts as a table, and the totals."""

    def __init__(self, segments: DataFrame, bits: int, order: int):
        self.segments, self.bits, self.order = segments, bits, order
        totals = segments.filter("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
        self.n, self.v = totals
        # A word that is broadcast has eight bytes and its count's four.
        self.bytes = segments.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0] + 12 * self.v


def learn(texts: DataFrame, text: str = "text", order: int = ORDER) -> Learned:
    """Counts of all rows' words and longer grams, in segments: 64 of a kind at least, and one for each ``SEGMENT_BYTES`` of text."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    bits = min(max(6, (size // SEGMENT_BYTES).bit_length()), 64 - NAME_BITS)
    runs = texts.select(F.col(text)).mapInArrow(_runs(bits, order), RUN)
    return Learned(written(runs.groupBy("kind", "seg").applyInArrow(_summed(bits), SEGMENT), "lm-segments"), bits, order)


def _model(learned: Learned) -> Model:
    """The whole model in memory; its size has been checked."""
    filters = []
    for kind in range(learned.order):
        rows = learned.segments.filter(F.col("kind") == kind).select("seg", "bits").orderBy("seg").toArrow()
        lengths = np.zeros(1 << learned.bits, np.int64)
        lengths[rows["seg"].to_numpy()] = [len(x.as_buffer()) // 8 for x in rows["bits"]]
        words = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_buffer(), np.uint64) for x in rows["bits"])])
        filters.append(Filter(learned.bits, words, np.concatenate([[0], np.cumsum(lengths)]), 64 - learned.bits - name_bits(kind, learned.bits)))
        del rows
    rows = learned.segments.filter("kind = 0").select("names", "counts", F.col("v").cast("int").alias("n")).orderBy("seg").toArrow().to_pylist()
    known = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(unblob(r["names"], r["n"]), dtype=np.uint64) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.uint64), *(unblob(r["counts"], r["n"]) for r in rows)])
    return Model(filters, known, np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts, learned.n, learned.v)


def score(docs: DataFrame, learned: Learned, key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score."""
    docs, back = set_aside(docs, key, text, tuple(OUTPUTS))
    if learned.bytes > broadcast_bytes:
        return back(_score_by_runs(docs, learned), *OUTPUTS)
    shared = docs.sparkSession.sparkContext.broadcast(_model(learned))

    @F.arrow_udf("struct<" + ",".join(f"{k}:{t}" for k, t in OUTPUTS.items()) + ">")
    def run(texts: pa.Array) -> pa.Array:
        found = shared.value.score(texts.to_pylist())
        kinds = {"long": pa.int64(), "double": pa.float64()}
        return pa.StructArray.from_arrays([pa.array(x, kinds[t]) for x, t in zip(found, OUTPUTS.values())], list(OUTPUTS))

    return back(docs.withColumn("lm", run(F.col("text"))), "lm.*")


PACKED = "ids binary, lengths binary, texts binary, n int"
ASKED = "run long, kind int, seg int, n int, names binary"
ANSWER = "run long, kind int, seg int, n int, levels binary, counts binary"
SCORED = "a long, b long, " + ", ".join(f"{k} {t}" for k, t in OUTPUTS.items())


def _packed(batches):
    """Runs of texts of some MB, in lower case and compressed, with the two hashes that name each."""
    codec = pa.Codec("zstd", compression_level=3)
    ids: list[bytes] = []
    texts: list[bytes] = []
    size = 0

    def flush():
        row = (b"".join(ids), blob(np.array([len(t) for t in texts])), codec.compress(b"".join(texts), asbytes=True), len(texts))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.binary(), pa.binary(), pa.binary(), pa.int32()))], ["ids", "lengths", "texts", "n"])

    for batch in batches:
        named = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype("<i8") for i in (0, 1)], 1)
        for name, text in zip(named, batch.column(2)):
            ids.append(name.tobytes())
            texts.append((text.as_py() or "").encode().translate(_LOWER))
            size += len(texts[-1]) + TEXT_BYTES
            if size >= RUN_BYTES:
                yield flush()
                ids, texts, size = [], [], 0
    if texts:
        yield flush()


def _unpacked(row: dict):
    """The tokens of a run of texts and where each text starts, in chunks as everywhere: tokens take many times their bytes."""
    ends = np.cumsum(unblob(row["lengths"], row["n"]).astype(np.int64))
    begins = np.concatenate([[0], ends[:-1]])
    data = pa.Codec("zstd").decompress(row["texts"], int(ends[-1]), asbytes=True)
    chunk = (ends + TEXT_BYTES * np.arange(1, len(ends) + 1)) // CHUNK_BYTES
    for some in np.split(np.arange(len(ends)), np.flatnonzero(np.diff(chunk)) + 1):
        yield tokens([data[begins[i] : ends[i]] for i in some])


def _distinct(run, order: int) -> list[np.ndarray]:
    """Sorted distinct grams of each kind of a run's chunks."""

    def different(grams: np.ndarray) -> np.ndarray:
        # np.unique uses a table of hashes here, which is slower for so many than sorting.
        grams = np.sort(grams)
        return grams[np.flatnonzero(np.diff(grams, prepend=~grams[:1]))]

    held: list[list[np.ndarray]] = [[] for _ in range(order)]
    for grams, starts in run:
        held[0].append(different(grams))
        for kind, (both, _, valid) in enumerate(longer(grams, starts, order), 1):
            held[kind].append(different(both[valid]))
    return [different(np.concatenate(x)) for x in held]


def _asked(bits: int, order: int):
    """The distinct grams of each run of texts, cut into segments."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in ("run", "lengths", "texts", "n")}
                rows = [(row["run"], kind, seg, b - a, names) for kind, grams in enumerate(_distinct(_unpacked(row), order)) for seg, a, b, names in cut(kind, grams, bits)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["run", "kind", "seg", "n", "names"])

    return run


def _answered(bits: int):
    def run(asked: pa.Table, segment: pa.Table) -> pa.Table:
        """What one segment has of the grams of all runs: the filter's levels, and the exact counts of words."""
        if not len(asked):
            return pa.table({c: pa.array([], t) for c, t in (("run", pa.int64()), ("kind", pa.int32()), ("seg", pa.int32()), ("n", pa.int32()), ("levels", pa.binary()), ("counts", pa.binary()))})
        kind, seg, sizes = asked["kind"][0].as_py(), asked["seg"][0].as_py(), asked["n"].to_pylist()
        grams = keys(kind, seg, bits, asked["names"].to_pylist(), sizes)
        order = np.argsort(grams)
        grams = grams[order]
        new = np.concatenate([[True], grams[1:] != grams[:-1]])
        which = np.empty(len(grams), np.int32)
        which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        grams = grams[new]
        del order, new
        levels, counts = np.zeros(len(grams), np.uint8), np.zeros(len(grams), np.uint64)
        if len(segment):
            words = np.frombuffer(segment["bits"][0].as_buffer(), np.uint64)
            levels = Filter(0, words, np.array([0, len(words)])).levels(grams)
            if kind == 0:
                n = segment["v"][0].as_py()
                known = np.cumsum(unblob(segment["names"][0].as_py(), n), dtype=np.uint64)
                at = np.minimum(np.searchsorted(known, grams), n - 1)
                counts = np.where(known[at] == grams, unblob(segment["counts"][0].as_py(), n)[at], _U(0))
        runs = np.split(which, np.cumsum(sizes)[:-1])
        out = {"levels": [blob(levels[x]) for x in runs], "counts": [blob(counts[x]) if kind == 0 else b"" for x in runs]}
        return asked.select(["run", "kind", "seg", "n"]).append_column("levels", pa.array(out["levels"], pa.binary())).append_column("counts", pa.array(out["counts"], pa.binary()))

    return run


def _finished(order: int, n: int, v: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """The scores of a run of texts from the answers of all segments."""
        row = texts.to_pylist()[0]
        chunks = list(_unpacked(row))
        distinct = _distinct(chunks, order)
        rows = sorted(answers.to_pylist(), key=lambda x: (x["kind"], x["seg"]))
        found = [np.concatenate([np.zeros(0, np.uint8), *(unblob(x["levels"], x["n"]).astype(np.uint8) for x in rows if x["kind"] == kind)]) for kind in range(order)]
        counts = np.concatenate([unblob(x["counts"], x["n"]) for x in rows if x["kind"] == 0]).astype(np.float64)

        def place(kind: int, grams: np.ndarray) -> np.ndarray:
            some, which = np.unique(grams, return_inverse=True)
            return np.searchsorted(distinct[kind], some)[which]

        def scored(grams: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
            words = place(0, grams)
            return sums(grams, starts, counts[words], lambda kind, some: found[kind][place(kind, some) if kind else words], order, n, v)

        out = [np.concatenate(x) for x in zip(*(scored(*chunk) for chunk in chunks))]
        ids = np.frombuffer(row["ids"], "<i8").reshape(-1, 2)
        kinds = {"long": pa.int64(), "double": pa.float64()}
        return pa.table({"a": ids[:, 0], "b": ids[:, 1], **{k: pa.array(x, kinds[t]) for x, (k, t) in zip(out, OUTPUTS.items())}})

    return run


def _score_by_runs(docs: DataFrame, learned: Learned) -> DataFrame:
    """The same scores without a broadcast: the grams of runs of texts meet their segments, and the answers meet the texts."""
    bits, order = learned.bits, learned.order
    rows = docs.withColumn("rid", row_name(F.col("key"), F.col("text")))
    texts = rows.select("rid.a", "rid.b", "text").mapInArrow(_packed, PACKED)
    texts = written(texts.withColumn("run", F.monotonically_increasing_id()), "lm-texts")
    asked = texts.select("run", "lengths", "texts", "n").mapInArrow(_asked(bits, order), ASKED)
    answers = asked.groupBy("kind", "seg").cogroup(learned.segments.groupBy("kind", "seg")).applyInArrow(_answered(bits), ANSWER)
    scores = texts.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_finished(order, learned.n, learned.v), SCORED)
    # Equal rows have equal scores.
    scores = scores.dropDuplicates(["a", "b"]).select(F.struct("a", "b").alias("rid"), *OUTPUTS)
    return rows.join(scores, "rid", "left")
