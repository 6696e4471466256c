"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are computed with numpy from its bytes, words and lines.
The trees are fitted on a bounded sample of labelled rows (``SAMPLE`` at most,
the rows with the lowest hash), by histograms over at most 64 bins a feature and
the logistic loss.  The fitted trees are flattened into five arrays (feature,
threshold, left, right, value) that all rows of a batch walk at once.

Defined results: null and empty texts have all statistics at 0 and get a score;
repeated rows get equal scores; labels that are null are not learned from; with
no labelled rows, or with one class only, every score is the class's rate
(0.5 without rows); other columns of the documents are kept and a column with an
output's name is replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that are learned from, at most.
SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, LEAST, L2 = 64, 80, 4, 0.15, 8, 1.0

_CLASS = np.zeros(256, np.uint8)
for _i, _set in enumerate((b" ", b"\n\t\r\x0b\x0c", b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:", b"!?", bytes(range(128, 256)))):
    _CLASS[list(_set)] = _i + 1
FEATURES = 34


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text."""
    out = np.zeros(FEATURES, np.float32)
    data = (text or "").encode()
    if not data:
        return out
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, counts, 9)
    p = counts[counts > 0] / n
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    k, m = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    distinct = set(words)
    pairs = set(zip(words, words[1:]))
    same = sum(map(bytes.__eq__, words, words[1:]))
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1, np.int64)
    tails = np.bincount(_CLASS[[w[-1] for w in words]], minlength=9) if words else np.zeros(9)
    heads = np.bincount(_CLASS[[w[0] for w in words]], minlength=9) if words else np.zeros(9)
    seconds = np.bincount(_CLASS[[w[1] if len(w) > 1 else 0 for w in words]], minlength=9) if words else np.zeros(9)
    letters = max(1.0, kinds[4] + kinds[5] + kinds[8])
    out[:9] = kinds / n
    out[9] = np.log1p(n)
    out[10] = np.log1p(k)
    out[11] = -(p * np.log2(p)).sum()
    out[12:15] = lengths.mean(), lengths.std(), lengths.max()
    out[15] = len(distinct) / k
    out[16] = len(distinct) / np.sqrt(k)
    out[17] = len(pairs) / k
    out[18] = same / k
    out[19] = len(set(lines)) / m
    out[20:22] = line_lengths.mean(), line_lengths.std()
    out[22] = tails[0] / k
    out[23] = tails[6] / k
    out[24] = tails[7] / k
    out[25] = heads[5] / k
    out[26] = (heads[5] - (seconds[5])) / k
    out[27] = kinds[5] / letters
    out[28] = data.count(b" | ") / k
    out[29] = counts[list(b"#$%&*<>{}[]|\\^~=_@/")].sum() / n
    out[30] = p.max()
    out[31] = len(zlib.compress(data, 1)) / n
    out[32] = np.count_nonzero(lengths == 1) / k
    out[33] = counts[list(b"()\"'-")].sum() / n
    return out


def matrix(texts: pa.Array) -> np.ndarray:
    return np.stack([statistics(t.as_py()) for t in texts]) if len(texts) else np.zeros((0, FEATURES), np.float32)


@dataclass
class Trees:
    """All trees in flat arrays; ``roots`` has each tree's first node. Leaves point to themselves."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: every row walks every tree, a level at a time."""
        total = np.full(len(x), self.base)
        if len(x) and len(self.roots):
            rows = np.arange(len(x))
            for root in self.roots:
                at = np.full(len(x), root)
                for _ in range(DEPTH):
                    at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
                total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees on the histograms of ``x``; the same rows give the same trees."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        edges = _edges(x)
        bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
        total = np.full(len(y), base)
        offsets = np.arange(x.shape[1]) * BINS

        def node() -> int:
            for a, b in ((feature, 0), (threshold, np.inf), (left, len(feature)), (right, len(feature)), (value, 0.0)):
                a.append(b)
            left[-1] = right[-1] = len(left) - 1
            return len(left) - 1

        def grow(rows: np.ndarray, depth: int) -> int:
            here = node()
            gs, hs = g[rows], h[rows]
            value[here] = float(-RATE * gs.sum() / (hs.sum() + L2))
            if depth == DEPTH or len(rows) < 2 * LEAST:
                return here
            flat = (bins[rows] + offsets).ravel()
            size = x.shape[1] * BINS
            sums = [np.bincount(flat, np.repeat(v, x.shape[1]), size).reshape(-1, BINS).cumsum(1) for v in (gs, hs, np.ones(len(rows)))]
            G, H, N = gs.sum(), hs.sum(), len(rows)
            gain = sums[0] ** 2 / (sums[1] + L2) + (G - sums[0]) ** 2 / (H - sums[1] + L2) - G * G / (H + L2)
            gain[(sums[2] < LEAST) | (N - sums[2] < LEAST)] = -1
            best = int(gain.argmax())
            if gain.flat[best] <= 1e-6:
                return here
            f, b = divmod(best, BINS)
            feature[here], threshold[here] = f, float(edges[f][b])
            goes = bins[rows, f] <= b
            left[here], right[here] = grow(rows[goes], depth + 1), grow(rows[~goes], depth + 1)
            return here

        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            roots.append(grow(np.arange(len(y)), 0))
            part = Trees(0.0, np.array(roots[-1:]), *map(np.array, (feature, threshold, left, right, value)))
            at = np.full(len(y), roots[-1])
            for _ in range(DEPTH):
                at = np.where(x[np.arange(len(y)), part.feature[at]] <= part.threshold[at], part.left[at], part.right[at])
            total = total + part.value[at]
    arrays = (np.array(a) for a in (feature, threshold, left, right, value))
    return Trees(base, np.array(roots, np.int64), *arrays)


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled rows, those with the lowest hash of the key."""
    marks = labels.select(F.col(key).alias("_k"), F.col(label).cast("double").alias("_y")).filter(F.col("_y").isNotNull() & F.col("_k").isNotNull())
    some = marks.orderBy(F.xxhash64("_k"), "_k", "_y").limit(sample)
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(some), "_k")

    @F.arrow_udf("array<float>")
    def stats(texts: pa.Array) -> pa.Array:
        return pa.array(list(matrix(texts)), pa.list_(pa.float32()))

    # Repeated keys can't make the sample longer than the bound.
    found = rows.select("_k", "_y", stats("_t").alias("x")).orderBy(F.xxhash64("_k"), "_k", "_y", "x").limit(sample).toArrow()
    x = found["x"].combine_chunks().values.to_numpy().reshape(-1, FEATURES) if len(found) else np.zeros((0, FEATURES), np.float32)
    return fit(x, found["_y"].to_numpy())


def scored(docs: DataFrame, trees: Trees, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(matrix(texts)), pa.float64())

    return docs.withColumn(score, run(F.col(text)))
