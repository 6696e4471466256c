"""Language ID by segmentation-marginalised unigrams over a fixed vocabulary.

A word is a run of letters, in lower case, with a blank before it, as bytes.
Each language has a probability for every piece of the vocabulary; a word's
probability is the sum, by the forward algorithm, over all ways to cut it into
pieces.  A text's score is the sum of its words' log probabilities plus the
language's prior; the prediction has the highest posterior.

Piece probabilities are learned by expectation maximisation: word counts of each
language, over about ``SAMPLE`` of its labelled rows (those with the lowest hash
of key and text, equal rows once), are spread over tasks, each adds up the
expected counts of pieces over all segmentations (forward and backward), and
Spark sums them by language and piece.  The languages and their priors are
counted over all labelled rows.

Defined results: texts that are null or have no letter are ``und`` with score 0;
rows without a language are not learned from; with nothing to learn from every
row is ``und``; ties go to the language first in order; repeated rows get equal
results; an existing column with an output's name is replaced.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.words import row_id, vocabulary_file
from lintel.storage import written

SAMPLE, ROUNDS, SMOOTHING = 4_000, 2, 0.05
#: Words whose log probabilities one worker keeps; a full store is emptied.
WORDS_KEPT = 250_000
UNDETERMINED = "und"

_letters = regex.compile(r"\p{L}+").findall


def text_words(text: str | None) -> list[str]:
    return _letters(text.lower()) if text else []


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict[bytes, int], int]:
    """Piece -> row of the probability table, and the longest piece's length."""
    with open(vocabulary_file(path), "rb") as lines:
        found = {base64.b64decode(line.split()[0]): i for i, line in enumerate(lines)}
    return found, max(map(len, found))


#: Between words in a text for the automaton: no byte.
_GAP = chr(256)


@lru_cache(maxsize=2)
def _finder(path: str) -> ahocorasick.Automaton:
    """Finds all pieces in a text whose characters stand for bytes; a piece's value is its row and, in 16 bits, its length."""
    finder = ahocorasick.Automaton()
    for piece, row in pieces(path)[0].items():
        finder.add_word(piece.decode("latin-1"), (row << 16) | len(piece))
    finder.make_automaton()
    return finder


def _cuts(words: list[bytes], path: str):
    """For equally long words: at each end, (length, rows of the table) of the pieces that end there; -1: none."""
    n = len(words[0])
    matches = _finder(path).iter(_GAP.join(w.decode("latin-1") for w in words))
    found = np.fromiter(chain.from_iterable(matches), np.int64).reshape(-1, 2)
    word, end = np.divmod(found[:, 0], n + 1)
    row, length = found[:, 1] >> 16, found[:, 1] & 0xFFFF
    # By end, then length, in runs.
    key = (end << 16) | length
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    by_end: list[list] = [[] for _ in range(n)]
    for run in np.split(order, starts[1:]) if len(order) else ():
        at = np.full(len(words), -1)
        at[word[run]] = row[run]
        by_end[end[run[0]]].append((int(length[run[0]]), at))
    yield from enumerate(by_end, 1)


def _forward(cuts, table: np.ndarray, count: int, n: int):
    """Forward sums at every end, each scaled by its word's ``scale`` (a log) at that end."""
    sums = [np.ones((count, table.shape[1]))]
    scale = [np.zeros((count, 1))]
    for end, found in cuts:
        total = np.zeros((count, table.shape[1]))
        for length, at in found:
            total += sums[end - length] * np.exp(scale[end - length] - scale[end - 1]) * table[at]
        top = total.max(axis=1, keepdims=True)
        sums.append(total / top)
        scale.append(scale[end - 1] + np.log(top))
    return sums, scale


def log_probabilities(words: list[str], table: np.ndarray, path: str) -> np.ndarray:
    """Log probability of each word in each language; ``table`` ends with a row of zeros."""
    out = np.zeros((len(words), table.shape[1]))
    by_length: dict[int, list[int]] = {}
    data = [b" " + w.encode() for w in words]
    for i, w in enumerate(data):
        by_length.setdefault(len(w), []).append(i)
    for n, members in by_length.items():
        sums, scale = _forward(_cuts([data[i] for i in members], path), table, len(members), n)
        with np.errstate(divide="ignore"):
            out[members] = np.log(sums[-1]) + scale[-1]
    return out


def expected(words: list[str], counts: np.ndarray, table: np.ndarray, path: str) -> np.ndarray:
    """Expected counts of all pieces over all segmentations of ``words``; one language."""
    total = np.zeros(len(table))
    by_length: dict[int, list[int]] = {}
    data = [b" " + w.encode() for w in words]
    for i, w in enumerate(data):
        by_length.setdefault(len(w), []).append(i)
    for n, members in by_length.items():
        cuts = list(_cuts([data[i] for i in members], path))
        sums, scale = _forward(cuts, table, len(members), n)
        back = [np.zeros(len(members)) for _ in range(n)] + [np.ones(len(members))]
        weight = counts[members]
        # back[end] is scaled so that sums[end] * back[end] is the share of the word's probability that passes ``end``.
        back[n] = 1 / sums[n][:, 0]
        for end, found in reversed(cuts):
            for length, at in found:
                start = end - length
                step = table[at, 0] * np.exp(scale[start] - scale[end])[:, 0] * back[end]
                back[start] += step
                np.add.at(total, at, weight * sums[start][:, 0] * step)
    return total[:-1]


class Model:
    """Languages in order, their log priors and the table of piece probabilities."""

    def __init__(self, languages: list[str], priors: np.ndarray, table: np.ndarray, path: str):
        self.languages, self.priors, self.table, self.path = languages, priors, table, path
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(languages)))

    def learn_words(self, words: set[str]) -> None:
        if len(self.known) + len(words) > WORDS_KEPT:
            self.known.clear()
        fresh = sorted(words - self.known.keys())
        start = len(self.known)
        while start + len(fresh) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            self.rows[start + at : start + at + len(some)] = log_probabilities(some, self.table, self.path)
        self.known.update(zip(fresh, range(start, start + len(fresh))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = []
        for at in range(0, len(texts), 512):
            some = [text_words(t) for t in texts[at : at + 512]] if self.languages else [[]] * len(texts[at : at + 512])
            self.learn_words(set(chain.from_iterable(some)))
            found += map(self._predict, some)
        return found

    def _predict(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNDETERMINED, 0.0
        logs = self.rows[list(map(self.known.__getitem__, words))].sum(0) + self.priors
        best = int(logs.argmax())
        return self.languages[best], float(1 / np.exp(logs - logs[best]).sum())


def learned(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """A model of all languages, from all rows of those with at most ``sample`` different rows and about ``sample`` of each other."""
    named = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("lang")).filter("t is not null and lang is not null")
    named = named.select("lang", "t", row_id(F.col("k"), F.col("t")).alias("h"))
    found = named.groupBy("lang", "h").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("different")).collect()
    rates = sorted((r.lang, r.n) for r in found)
    # Hashes up to a language's share are about ``sample``, whatever its size: nothing is sorted.
    tops = [(r.lang, min(int(sample / r.different * 2**64) - 2**63, 2**63 - 1)) for r in found]
    some = named.join(F.broadcast(docs.sparkSession.createDataFrame(tops, "lang string, top long")), "lang").filter("h <= top")
    if any(r.n > r.different for r in found):
        some = some.dropDuplicates(["lang", "h"])
    some = written(some.select("t", "lang"), "langid-sample")

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([text_words(t.as_py()) for t in texts], pa.list_(pa.string()))

    counts = written(some.select("lang", F.explode(split("t")).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "langid-words")
    languages = [r[0] for r in rates]
    size = len(pieces(path)[0])
    priors = np.log(np.array([r[1] for r in rates], float) + 1)
    table = np.full((size + 1, len(languages)), 1 / size)
    table[-1] = 0
    index = {name: i for i, name in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        shared = docs.sparkSession.sparkContext.broadcast((index, table))

        def step(batches):
            index, table = shared.value
            for batch in batches:
                names, words, n = (batch.column(i).to_pylist() for i in range(3))
                for name in sorted(set(names)):
                    mine = [i for i, x in enumerate(names) if x == name]
                    for at in range(0, len(mine), 4096):
                        part = mine[at : at + 4096]
                        got = expected([words[i] for i in part], np.array([n[i] for i in part], float), table[:, [index[name]]], path)
                        seen = np.flatnonzero(got)
                        yield pa.RecordBatch.from_arrays([pa.array([index[name]] * len(seen), pa.int32()), pa.array(seen, pa.int32()), pa.array(got[seen])], ["l", "piece", "c"])

        # At most one row for each language and piece of the vocabulary.
        sums = counts.select("lang", "word", "n").mapInArrow(step, "l int, piece int, c double").groupBy("l", "piece").agg(F.sum("c").alias("c")).toArrow()
        table = np.full((size + 1, len(languages)), SMOOTHING)
        np.add.at(table, (sums["piece"].to_numpy(), sums["l"].to_numpy()), sums["c"].to_numpy())
        table[-1] = 0
        table /= table.sum(0)
    return Model(languages, priors, table, path)


def predicted(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior."""
    parts = (model.languages, model.priors, model.table, model.path)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    taken = set(docs.columns) | {lang, score}
    both = next(name for name in (f"predicted_{i}" for i in range(len(taken) + 1)) if name not in taken)

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(texts: pa.Array) -> pa.Array:
        found = _model(shared).predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang", "score"])

    out = docs.withColumn(both, run(F.col(text)))
    return out.withColumn(lang, F.col(f"{both}.lang")).withColumn(score, F.col(f"{both}.score")).drop(both)


_kept: list = []


def _model(shared) -> Model:
    """One model per worker process and broadcast; it holds the broadcast's value, whose identity it is known by."""
    parts = shared.value
    if not _kept or _kept[0] is not parts:
        _kept[:] = parts, Model(*parts)
    return _kept[1]
