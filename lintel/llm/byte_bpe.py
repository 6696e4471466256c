"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end its
encoding.  ``PrefixTable`` stores that token for each prefix, so

* the encoding is read off backwards in one pass,
* appending bytes only adds entries (exact appends),
* an edit recomputes entries from the edit on; earlier ones stay.

A token ``t`` may follow ``s`` when encoding ``s + t`` keeps both tokens apart;
that test walks down the merges which made the two tokens.  ``Columns`` fills the
tables of many short pieces at once, one column for each byte; the tokens that
may end a prefix are those of its node in an automaton of all tokens
(Aho-Corasick), longest first.

Defined results: a null text counts as the empty text and gives an empty id
list; rows keep their number and order, ties and repeated rows are encoded
alike; an existing column with the output's name is replaced; empty tables give
empty tables.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.llm.words import vocabulary_file

#: Distinct pieces, steps between prefixes and token pairs that one worker keeps, also between tasks and through stages without encoding.
PIECES, PREFIXES, PAIRS = 240_000, 120_000, 300_000
#: Pieces whose ids are put together at once, new ones and characters of theirs at most, and bytes of the longest piece that is kept.
RUN, NEW, CHARS, SHORT = 250_000, 30_000, 4_000_000, 48


class Vocabulary:
    """Token bytes, ranks and the pair of tokens that each token was merged from."""

    def __init__(self, path: str):
        with open(vocabulary_file(path), "rb") as lines:
            pairs = [line.split() for line in lines]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.parts: dict[int, tuple[int, int]] = {}
        self._pairs: dict[int, bool] = {}
        for rank in sorted(self.token):
            self.parts[rank] = self._merged_from(self.token[rank], rank)
        ends: dict[bytes, set[int]] = {}
        for token in self.rank:
            if len(token) > 2:
                ends.setdefault(token[-3:], {2} if token[-2:] in self.rank else set()).add(len(token))
        #: Lengths of the tokens that end in these three bytes, longest first.
        self.lengths = {end: sorted(found, reverse=True) for end, found in ends.items()}

    def _merged_from(self, token: bytes, rank: int) -> tuple[int, int]:
        for cut in range(1, len(token)):
            left, right = self.rank.get(token[:cut], rank), self.rank.get(token[cut:], rank)
            if left < rank and right < rank and self.apart(left, right, rank):
                return left, right
        return rank, rank

    def apart(self, left: int, right: int, limit: int = 1 << 60) -> bool:
        """Whether no merge of a rank below ``limit`` crosses the border of the two tokens."""
        while True:
            joined = self.rank.get(self.token[left] + self.token[right])
            if joined is not None and joined < limit:
                return False
            if left > right:
                limit, down = left, self.parts[left][1]
                if down != left:
                    left = down
                    continue
                limit, down = right + 1, self.parts[right][0]
                if down == right:
                    return True
                right = down
            else:
                limit, down = right + 1, self.parts[right][0]
                if down != right:
                    right = down
                    continue
                limit, down = left, self.parts[left][1]
                if down == left:
                    return True
                left = down

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.apart(left, right)
        return known

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixTable:
    """The unique valid last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._fill()

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of bytes ``start`` to ``stop``; entries before ``start`` stay."""
        self.data = self.data[:start] + new + self.data[stop:]
        del self.last[start:]
        self._fill()

    def _fill(self) -> None:
        v, data, last = self.vocabulary, self.data, self.last
        for end in range(len(last) + 1, len(data) + 1):
            for length in v.lengths.get(data[max(0, end - 3) : end], (2,)):
                if length <= end and (token := v.rank.get(data[end - length : end])) is not None:
                    if length == end:
                        last.append(token)
                        break
                    if v.may_follow(last[end - length - 1], token):
                        last.append(token)
                        break
            else:
                last.append(v.rank[data[end - 1 : end]])

    def ids(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(self.vocabulary.token[token])
        return found[::-1]


class Memo:
    """Values of keys of at least 0, computed for different new keys at once; of keys that share a slot one is kept."""

    def __init__(self, slots: int, values: Callable[[np.ndarray], np.ndarray], kind: type):
        self.keys, self.held, self.values = np.full(slots, -1, np.int64), np.zeros(slots, kind), values

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = keys % len(self.keys)
        out = self.held[slots]
        missed = np.flatnonzero(self.keys[slots] != keys)
        if len(missed):
            new, where = np.unique(keys[missed], return_inverse=True)
            found = self.values(new)
            out[missed] = found[where]
            slots, kept = np.unique(new % len(self.keys), return_index=True)
            self.keys[slots], self.held[slots] = new[kept], found[kept]
        return out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of these ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class Columns:
    """Prefix tables of many pieces, filled byte by byte for all of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        nodes = sorted(sorted({token[:end] for token in vocabulary.rank for end in range(len(token) + 1)}), key=len)
        number = {prefix: i for i, prefix in enumerate(nodes)}
        parent = np.array([number[x[:-1]] for x in nodes[1:]], np.int64)
        byte = np.array([x[-1] for x in nodes[1:]], np.int64)
        #: In this order of nodes, keys of edges ascend: edge i leads to node i + 1.
        self.edges = parent << 8 | byte
        self.back = np.zeros(len(nodes), np.int32)
        #: One more than ranks, so that -1, no token, has no bytes.
        tops = max(vocabulary.token) + 2
        self.length, self.shorter = np.zeros(tops, np.int32), np.zeros(tops, np.int32)
        #: By node, the longest token that ends there; by token, the next shorter one that ends it.
        self.ending = np.array([vocabulary.rank.get(x, -1) for x in nodes], np.int32)
        for node in np.split(np.arange(1, len(nodes)), np.flatnonzero(np.diff([len(x) for x in nodes[1:]])) + 1):
            if len(nodes[node[0]]) > 1:
                self.back[node] = self._steps(self.back[parent[node - 1]].astype(np.int64) << 8 | byte[node - 1])
            own, behind = self.ending[node], self.ending[self.back[node]]
            self.length[own[own >= 0]], self.shorter[own[own >= 0]] = len(nodes[node[0]]), behind[own >= 0]
            self.ending[node] = np.where(own >= 0, own, behind)
        self.step, self.follow = Memo(PREFIXES, self._steps, np.int32), Memo(PAIRS, self._follow, np.bool_)
        self.bytes = np.frombuffer(b"".join(vocabulary.token.get(i, b"") for i in range(tops)), np.uint8)
        self.starts = np.cumsum(self.length, dtype=np.int64) - self.length

    def _steps(self, keys: np.ndarray) -> np.ndarray:
        """Nodes after one more byte; a key is a node and the byte."""
        out, rows = np.zeros(len(keys), np.int32), np.arange(len(keys))
        while len(rows):
            at = np.searchsorted(self.edges, keys[rows])
            met = self.edges[np.minimum(at, len(self.edges) - 1)] == keys[rows]
            out[rows[met]] = at[met] + 1
            rows = rows[~met]
            node, byte = keys[rows] >> 8, keys[rows] & 255
            if not node.all():
                raise KeyError(bytes([byte[node == 0][0]]))
            keys = keys.copy()
            keys[rows] = self.back[node].astype(np.int64) << 8 | byte
        return out

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        apart = self.vocabulary.apart
        return np.array([apart(key >> 32, key & 0xFFFFFFFF) for key in keys.tolist()], np.bool_)

    def ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")
        sizes, width = sizes[order], max(1, int(sizes.max(initial=0)))
        data = np.frombuffer(b"".join(pieces[i].ljust(width) for i in order.tolist()), np.uint8).reshape(-1, width).T.copy()
        last, node = np.empty(data.shape, np.int32), np.zeros(len(pieces), np.int64)
        for at in range(width):
            n = np.searchsorted(-sizes, -at)
            node = self.step(node[:n].astype(np.int64) << 8 | data[at, :n])
            token = self.ending[node]
            rows = np.arange(n)
            while len(rows):
                found = token[rows]
                length = self.length[found]
                # A token of the whole prefix is its encoding; one byte is what is left in the end.
                unsure = (length <= at) & (length > 1)
                rows, found, length = rows[unsure], found[unsure], length[unsure]
                rows = rows[~self.follow(last[at - length, rows].astype(np.int64) << 32 | found)]
                token[rows] = self.shorter[token[rows]]
            if token.min(initial=0) < 0:
                raise KeyError(bytes([data[at, :n][token < 0][0]]))
            last[at, :n] = token
        turns, rows, left = [], np.flatnonzero(sizes), sizes.copy()
        while len(rows):
            token = last[left[rows] - 1, rows]
            turns.append((rows, token))
            left[rows] -= self.length[token]
            rows = rows[left[rows] > 0]
        counts = np.zeros(len(pieces), np.int64)
        for rows, _ in turns:
            counts[order[rows]] += 1
        ends, out = np.cumsum(counts), np.empty(counts.sum(), np.int32)
        for turn, (rows, token) in enumerate(turns, 1):
            out[ends[order[rows]] - turn] = token
        return out, counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[_ranges(self.starts[ids], self.length[ids])]


class Known(dict):
    """Numbers of pieces, which are the places of their ids; a piece not met yet gets the next one."""

    def __init__(self, before: dict[str, int], size: int):
        super().__init__()
        self.before, self.size, self.new = before, size, []

    def __missing__(self, piece: str) -> int:
        number = self.before.pop(piece, None)
        if number is None:
            number = self.size
            self.size += 1
            self.new.append(piece)
        self[piece] = number
        return number


class Encoder:
    """Texts to ids and back; pieces are those that ``pattern`` matches."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.pieces = regex.compile(pattern).findall
        #: Pieces of ``before`` were met before ``known`` was last full, and go when it is full again.
        self.before: dict[str, int] = {}
        self.known = Known(self.before, 0)
        #: Ids of the numbered pieces, one after the other; where each starts, and how many it has.
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @cached_property
    def columns(self) -> Columns:
        return Columns(self.vocabulary)

    def _learn(self) -> list[str]:
        """Put the ids of new pieces behind the others, those of long pieces last; gives the long ones."""
        data = [piece.encode() for piece in self.known.new]
        ids, counts = self.columns.ids([x if len(x) <= SHORT else b"" for x in data])
        starts, parts, size = len(self.ids) + np.cumsum(counts) - counts, [self.ids, ids], len(self.ids) + len(ids)
        long = [i for i, x in enumerate(data) if len(x) > SHORT]
        for i in long:
            whole = self.vocabulary.rank.get(data[i])
            parts.append(np.array([whole] if whole is not None else PrefixTable(self.vocabulary, data[i]).ids(), np.int32))
            starts[i], counts[i] = size, len(parts[-1])
            size += len(parts[-1])
        self.ids, self.starts, self.counts = np.concatenate(parts), np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])
        new, self.known.new = self.known.new, []
        return [new[i] for i in long]

    def _forget(self) -> None:
        """What ``known`` has becomes ``before``; all else goes."""
        numbers = np.fromiter(self.known.values(), np.int64, len(self.known))
        self.before = dict(zip(self.known, range(len(numbers))))
        self.known = Known(self.before, len(numbers))
        self.ids, self.counts = self.ids[_ranges(self.starts[numbers], self.counts[numbers])], self.counts[numbers]
        self.starts = np.cumsum(self.counts) - self.counts

    def runs(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts one after the other, and where texts end among those of this run; a run may end inside of a text."""
        numbers, ends, chars, part = array("q"), [], 0, max(1, PIECES // 16)

        def run() -> tuple[np.ndarray, np.ndarray]:
            long = self._learn()
            met = np.array(numbers, np.int64)
            counts = self.counts[met]
            ids = self.ids[_ranges(self.starts[met], counts)]
            if long:
                self.ids = self.ids[: self.starts[self.known[long[0]]]].copy()
                for piece in long:
                    del self.known[piece]
            return ids, np.concatenate([[0], np.cumsum(counts)])[ends]

        for text in texts:
            pieces = self.pieces(text)
            chars += len(text)
            for start in range(0, len(pieces), part):
                some = pieces if len(pieces) <= part else pieces[start : start + part]
                full = len(self.known) + len(some) > PIECES // 2 or self.known.size > 2 * PIECES
                if full or len(numbers) > RUN or len(self.known.new) > NEW or chars > CHARS:
                    yield run()
                    numbers, ends, chars = array("q"), [], 0
                    if full:
                        self._forget()
                numbers.extend(map(self.known.__getitem__, some))
            ends.append(len(numbers))
        yield run()

    def encode(self, text: str) -> array:
        return array("i", b"".join(ids.tobytes() for ids, _ in self.runs([text])))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process."""
    return Encoder(path, pattern)


def _ints(numbers: array) -> pa.Array:
    """The numbers in place, without a copy."""
    return pa.Array.from_buffers(pa.int32(), len(numbers), [None, pa.py_buffer(numbers)])


def encoded_batch(e: Encoder, texts: pa.Array) -> pa.StructArray:
    """Ids and decoded bytes of all texts, each written once to the buffers that the result keeps."""
    ids, ends, data, cuts = array("i"), array("i", [0]), bytearray(), array("i", [0])
    for found, stops in e.runs(text.as_py() or "" for text in texts):
        lengths = np.concatenate([[0], np.cumsum(e.columns.length[found], dtype=np.int64)])
        ends.extend((stops + len(ids)).tolist())
        cuts.extend((lengths[stops] + len(data)).tolist())
        ids.frombytes(found.tobytes())
        data += memoryview(e.columns.decode(found))
    decoded = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(_ints(ends), _ints(ids)), decoded], ["ids", "decoded"])


def encoded(text: Column, path: str, pattern: str) -> Column:
    """struct(ids array<int>, decoded binary): the ids of a text and the bytes they decode to."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def run(texts: pa.Array) -> pa.Array:
        return encoded_batch(encoder(path, pattern), texts)

    return run(text)


def decoded(ids: Column, path: str) -> Column:
    """Binary: the bytes of an id list; null for a null list."""

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        v = encoder(path, r"(?s).+").vocabulary
        return pa.array([None if x.as_py() is None else v.decode(x.as_py()) for x in lists], pa.binary())

    return run(ids)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", back: str | None = None) -> DataFrame:
    """``df`` with the ids of column ``text``; ``back`` names a column for the decoded bytes."""
    taken = set(df.columns) | {ids, back}
    both = next(name for name in (f"encoded_{i}" for i in range(len(taken) + 1)) if name not in taken)
    out = df.withColumn(both, encoded(F.col(text), path, pattern)).withColumn(ids, F.col(f"{both}.ids"))
    if back:
        out = out.withColumn(back, F.col(f"{both}.decoded"))
    return out.drop(both)
