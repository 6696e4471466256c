"""Personal data by patterns and a skip-chain conditional random field.

Base spans are those of four patterns (email, ip, card, phone), each leftmost and
without overlap within its kind.  The field then looks for mentions that the
patterns miss, as a phone number without its plus or a name without its host.

* Nodes are the tokens of a document that hold a digit or an ``@``; labels are
  the four kinds and ``none``.  Tokens within base spans are observed.
* Chain edges join tokens with one blank between them.  Skip edges join a token
  to the next of the same letters and digits, wherever in the document; similar
  edges join it to the next with the same name before ``@`` or, at the end of a
  run of numbers, the same last seven digits.  A node has at most two edges of a
  sort, so edges grow with nodes and a much repeated token forms no pile of pairs.
* Unary potentials follow from counts of digits, signs, a checksum and a word
  before the token; each sort of edge has a symmetric table of label pairs.
* Loopy message passing, a fixed number of rounds over all documents of a batch at
  once, gives the marginals.  A token gets a kind if its marginal is at least
  ``THRESHOLD``; neighbours of one kind are one span, and a span stands only if
  one of its tokens repeats or resembles an observed token of that kind.

Potentials are learned by pseudo-likelihood on at most about ``SAMPLE`` rows
(those with the lowest hash of key and text), where the labels are the patterns'.
Every node is learned from as it is, without its signs, and by one edge alone as
the repetition of a node of its label, so that edges learn to carry a label to a
token that does not show it.  Tasks count the different cases; the driver fits on
the ``CASES`` most frequent.

Defined results: null and empty texts have no spans; with nothing to learn from
no span is added; repeated rows get equal results; positions count code points;
very long texts take time and memory in proportion to their length; an existing
column with an output's name is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.words import row_id
from lintel.storage import written

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
SAMPLE, CASES = 20_000, 20_000
THRESHOLD, ROUNDS = 0.8, 12
#: Letters and digits a token needs to be linked to others.
KEY_LENGTH = 5
CHAIN, SKIP, SIMILAR = range(3)

# The patterns are fixed values of the task. Where one scans a long run without a match, the form here scans it once.
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer

_word = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+").finditer
_token = re.compile(r"[+(]{0,2}[A-Za-z0-9](?:[A-Za-z0-9@._%+()-]*[A-Za-z0-9)])?").finditer
#: Words before a token that speak for a kind, in the order of KINDS; fixed values.
_cues = [re.compile(p) for p in (r"mail|contact", r"\b(?:ip|host|server|address)\b", r"\b(?:card|visa|credit|pay)", r"\b(?:phone|tel|call|mobile|fax)")]
_NO_DIGITS = str.maketrans("", "", "".join(chr(c) for c in range(128) if not chr(c).isdigit()))
#: Upper ends of the classes of a count of digits.
_STEPS = (0, 2, 4, 7, 11, 15, 19)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        end = _domain(text, at + 1)
        if end:
            start = at
            while start > done and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
                start -= 1
            if start < at:
                found.append((start, end.end()))
                done = end.end()
        at = text.find("@", at + 1)
    return found


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by kind and start; end is exclusive."""
    found = [("email", *e) for e in emails(text)]
    found += [("ip", m.start(), m.end()) for m in _ip(text) if is_ip(m[0])]
    found += [("card", m.start(), m.end()) for m in _card(text) if is_card(m[0])]
    return found + [("phone", m.start(), m.end()) for m in _phone(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def _step(n: int) -> int:
    return next((i for i, top in enumerate(_STEPS) if n <= top), len(_STEPS))


#: Offsets of the unary features: classes of digits, of digits of the run, then signs, letters, cues and one that is always there.
_SLOTS = (len(_STEPS) + 1, len(_STEPS) + 1, 2, 2, 2, 2, 2, 2, 2, 1 + len(KINDS), 1)
_AT = np.concatenate([[0], np.cumsum(_SLOTS)])
FEATURES = int(_AT[-1])
#: The slots that a node keeps without its signs.
_PLAIN, _ALWAYS = (0, 8, 10), (10,)


class Graph:
    """Tokens of one document (ASCII by their pattern) with their features, keys and edges."""

    def __init__(self, text: str, base: list[Span]):
        self.tokens = [(w.start() + m.start(), w.start() + m.end()) for w in _word(text) for m in _token(w[0]) if any(c.isdigit() or c == "@" for c in m[0])]
        n = len(self.tokens)
        self.label = [NONE] * n
        for kind, start, end in reversed(sorted(base, key=lambda s: (KINDS.index(s[0]), s[1]))):
            for i in self._within(start, end):
                self.label[i] = KINDS.index(kind)
        strings = [text[a:b] for a, b in self.tokens]
        digits = [s.translate(_NO_DIGITS) for s in strings]
        near = [i > 0 and self.tokens[i][0] - self.tokens[i - 1][1] == 1 and text[self.tokens[i][0] - 1] == " " for i in range(n)]
        numeric = [not any(c.isalpha() or c == "@" for c in s) for s in strings]
        self.edges = [(i - 1, i, CHAIN) for i in range(n) if near[i]]
        self.features, self.keys = [], []
        start = 0
        for i in range(n):
            if not (i and near[i] and numeric[i] and numeric[i - 1]):
                start = i
                end = i + 1
                while end < n and near[end] and numeric[end] and numeric[end - 1]:
                    end += 1
                run = "".join(digits[start:end]) if numeric[i] else digits[i]
            s, a = strings[i], self.tokens[i][0]
            before = text[max(0, a - 40) : a].lower()
            cue = next((k + 1 for k, c in enumerate(_cues) if c.search(before)), 0)
            octets = s.count(".") == 3 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in s.split("."))
            signs = (strings[start].lstrip("(").startswith("+"), 0 < s.find("@") < s.rfind("."), "(" in s or ")" in s, "-" in s, octets, 16 <= len(run) <= 19 and luhn(run), any(c.isalpha() for c in s))
            self.features.append((_step(len(digits[i])), _step(len(run)), *map(int, signs), cue, 0))
            name = "".join(filter(str.isalnum, s)).lower()
            own = [(SKIP, name)] if len(name) >= KEY_LENGTH else []
            local = s.split("@")[0].lower()
            if len("".join(filter(str.isalnum, local))) >= KEY_LENGTH and not numeric[i]:
                own.append((SIMILAR, local))
            if numeric[i] and i == end - 1 and len(run) >= 7:
                own.append((SIMILAR, run[-7:]))
            self.keys.append(own)
        self.kinds: dict[tuple, set[int]] = defaultdict(set)
        last: dict[tuple, int] = {}
        for i, own in enumerate(self.keys):
            for key in own:
                if key in last:
                    self.edges.append((last[key], i, key[0]))
                last[key] = i
                self.kinds[key].add(self.label[i])

    def _within(self, start: int, end: int):
        """Tokens that overlap a span; they are in order."""
        low = bisect_right(self.tokens, (start, start))
        while low > 0 and self.tokens[low - 1][1] > start:
            low -= 1
        return range(low, bisect_left(self.tokens, (end, end)))

    def open(self) -> bool:
        """Whether a token without a label repeats or resembles one that has a label."""
        return any(len(kinds) > 1 and NONE in kinds for kinds in self.kinds.values())

    def supported(self, i: int, kind: int) -> bool:
        return any(kind in self.kinds[key] for key in self.keys[i])


def cases(graph: Graph):
    """For pseudo-likelihood: (features, labels at the other ends of edges by sort, label) of every node."""
    around = [[[0] * LABELS for _ in range(3)] for _ in graph.tokens]
    for a, b, sort in graph.edges:
        around[a][sort][graph.label[b]] += 1
        around[b][sort][graph.label[a]] += 1
    for i, features in enumerate(graph.features):
        yield (*features, *(n for sort in around[i] for n in sort), graph.label[i])


def one_hot(features: np.ndarray, slots=range(len(_SLOTS))) -> np.ndarray:
    out = np.zeros((len(features), FEATURES))
    for s in slots:
        out[np.arange(len(features)), _AT[s] + features[:, s]] = 1
    return out


class Model:
    """Unary weights (feature, label) and a symmetric table of label pairs for each sort of edge."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def marginals(self, graphs: list[Graph]) -> np.ndarray:
        """Of all nodes of all graphs, one after the other."""
        offsets = np.concatenate([[0], np.cumsum([len(g.tokens) for g in graphs])]).astype(int)
        features = np.array([f for g in graphs for f in g.features], int).reshape(-1, len(_SLOTS))
        own = one_hot(features) @ self.unary
        label = np.array([x for g in graphs for x in g.label], int)
        seen = label != NONE
        own[seen] = -1e3
        own[seen, label[seen]] = 0
        edges = np.array([(a + o, b + o, sort) for g, o in zip(graphs, offsets) for a, b, sort in g.edges], int).reshape(-1, 3)
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        table, back = np.exp(self.pair)[np.concatenate([edges[:, 2]] * 2)], np.roll(np.arange(2 * len(edges)), len(edges))
        sent = np.zeros((2 * len(edges), LABELS))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, sent)
            told = belief[source] - sent[back]
            told = np.exp(told - told.max(1, keepdims=True))
            new = np.log(np.einsum("ek,eky->ey", told, table))
            sent = (sent + new - new.max(1, keepdims=True)) / 2
        np.add.at(own, target, sent)
        own = np.exp(own - own.max(1, keepdims=True))
        return own / own.sum(1, keepdims=True)

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """The spans that the field adds to each text's base spans."""
        found: list[list[Span]] = [[] for _ in texts]
        graphs = {i: Graph(t, b) for i, (t, b) in enumerate(zip(texts, base)) if b}
        graphs = {i: g for i, g in graphs.items() if g.open()}
        if not graphs:
            return found
        marginals, at = self.marginals(list(graphs.values())), 0
        for i, g in graphs.items():
            found[i] = _spans(g, marginals[at : at + len(g.tokens)])
            at += len(g.tokens)
        return found


def _spans(graph: Graph, marginals: np.ndarray) -> list[Span]:
    best = marginals.argmax(1)
    kind = np.where((marginals.max(1) >= THRESHOLD) & (np.array(graph.label) == NONE), best, NONE)
    chained = {b for a, b, sort in graph.edges if sort == CHAIN}
    groups: list[list[int]] = []
    for i in np.flatnonzero(kind != NONE).tolist():
        if groups and i in chained and groups[-1][-1] == i - 1 and kind[i] == kind[i - 1]:
            groups[-1].append(i)
        else:
            groups.append([i])
    return [(KINDS[kind[g[0]]], graph.tokens[g[0]][0], graph.tokens[g[-1]][1]) for g in groups if any(graph.supported(i, kind[i]) for i in g)]


def fitted(rows: np.ndarray, weights: np.ndarray, penalty: float = 1.0, steps: int = 400) -> Model:
    """Maximum pseudo-likelihood with a quadratic penalty, by Adam on all cases at once."""
    unary, pair = np.zeros((FEATURES, LABELS)), np.zeros((3, LABELS, LABELS))
    if not len(rows):
        return Model(unary, pair)
    n = len(_SLOTS)
    around, label = rows[:, n:-1].reshape(-1, 3, LABELS), np.eye(LABELS)[rows[:, -1]]
    # Each case as it is, without its signs, and by one edge alone as a repetition of, or something like, a node of its label.
    twins = [np.zeros_like(around) for _ in range(2)]
    for twin, sort in zip(twins, (SKIP, SIMILAR)):
        twin[np.arange(len(rows)), sort, rows[:, -1]] = 1
    blank = one_hot(rows[:, :n], _ALWAYS)
    x = np.concatenate([one_hot(rows[:, :n]), one_hot(rows[:, :n], _PLAIN), blank, blank])
    around, y = np.concatenate([around, around, *twins]), np.concatenate([label] * 4)
    w = np.concatenate([weights, weights / 3, weights, weights]) / weights.sum()
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (unary, pair)]
    for step in range(1, steps + 1):
        logits = x @ unary + np.einsum("nsk,sky->ny", around, pair)
        p = np.exp(logits - logits.max(1, keepdims=True))
        error = (y - p / p.sum(1, keepdims=True)) * w[:, None]
        up = np.einsum("nsk,ny->sky", around, error)
        gradients = (x.T @ error - penalty / weights.sum() * unary, up + up.transpose(0, 2, 1) - penalty / weights.sum() * pair)
        for value, gradient, moments in zip((unary, pair), gradients, state):
            moments[0] += 0.1 * (gradient - moments[0])
            moments[1] += 0.01 * (gradient**2 - moments[1])
            value += 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
    return Model(unary, pair)


def learned(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model from about ``sample`` different rows of ``docs``."""
    named = docs.select(F.col(text).alias("t"), row_id(F.col(key), F.col(text)).alias("h")).filter("t is not null")
    different = named.agg(F.count_distinct("h").alias("n")).first().n
    top = min(int(sample / max(different, 1) * 2**64) - 2**63, 2**63 - 1)
    some = named.filter(F.col("h") <= top).dropDuplicates(["h"]).select("t")
    width = len(_SLOTS) + 3 * LABELS + 1

    def count(batches):
        for batch in batches:
            found = Counter(c for t in batch.column(0).to_pylist() for c in cases(Graph(t, base_spans(t))))
            yield pa.RecordBatch.from_arrays([pa.array(map(list, found), pa.list_(pa.int32())), pa.array(found.values(), pa.int64())], ["case", "n"])

    counted = written(some.mapInArrow(count, "case array<int>, n long").groupBy("case").agg(F.sum("n").alias("n")), "private-cases")
    rows = counted.orderBy(F.desc("n"), "case").limit(CASES).toArrow()
    return fitted(np.array(rows["case"].to_pylist(), int).reshape(-1, width), rows["n"].to_numpy().astype(float))


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def tagged(docs: DataFrame, model: Model, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """``docs`` with base spans and all spans (both by kind, as listed in KINDS, then start)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.unary, model.pair))
    taken = set(docs.columns) | {base, spans}
    both = next(name for name in (f"private_{i}" for i in range(len(taken) + 1)) if name not in taken)
    out_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def form(found: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found], out_type)

    @F.arrow_udf(f"struct<base:{_SPANS},spans:{_SPANS}>")
    def run(texts: pa.Array) -> pa.Array:
        texts = [t or "" for t in texts.to_pylist()]
        first = [base_spans(t) for t in texts]
        more = Model(*shared.value).added(texts, first)
        every = [sorted({*a, *b}, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if b else a for a, b in zip(first, more)]
        return pa.StructArray.from_arrays([form(first), form(every)], ["base", "spans"])

    out = docs.withColumn(both, run(F.col(text)))
    return out.withColumn(base, F.col(f"{both}.base")).withColumn(spans, F.col(f"{both}.spans")).drop(both)
