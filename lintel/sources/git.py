"""Files of commits out of pack files, without a git program.

A pack's index (version 2) has a fan-out table of 256 counts, the sorted names of
its objects and their offsets.  Tasks read one slice of an index each, by offset,
into a table of objects (pack, oid, offset).  Whatever is asked for is looked up
there by a join, dealt to ranges of (pack, offset), and read from those places only.

A delta is resolved where it is met: its base lies at an offset of the same pack,
mostly nearby, so a task follows the chain and keeps what it has resolved, up to a
bound of bytes.  A base that is named by its oid is found by binary search between
two entries of the fan-out table.

Trees are walked one level a join: a path's next part against the entries of the
trees that the last level led to.  Objects outside of packs are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.sources.ranges import Ranges, listed
from lintel.storage import written

COMMIT, TREE, BLOB, TAG, OFFSET_DELTA, NAMED_DELTA = 1, 2, 3, 4, 6, 7
KINDS = {COMMIT: "commit", TREE: "tree", BLOB: "blob", TAG: "tag"}
FAN = 8
#: Bytes of resolved objects that one task keeps.
KEPT = 64 << 20
#: Bytes of an index that one slice has, and objects that are handed on at once.
SLICE, ROWS = 1 << 20, 1 << 14
FOLDER = "40000"


class Index:
    """The index of one pack, read by offset."""

    def __init__(self, path: str):
        self._file = Ranges(path)
        head = self._file.read(0, FAN + 1024)
        if head[:FAN] != b"\xfftOc\x00\x00\x00\x02":
            raise ValueError(f"{path} is no pack index of version 2")
        self.fan = struct.unpack(">256I", head[FAN:])
        self.count = self.fan[-1]
        self._names = FAN + 1024
        self._offsets = self._names + 24 * self.count
        self._large = self._offsets + 4 * self.count

    def slice(self, first: int, last: int | None = None) -> list[tuple[str, int]]:
        """(oid, offset) of the objects whose names begin with the byte ``first``, or with one from it to ``last``."""
        low, high = self.fan[first - 1] if first else 0, self.fan[first if last is None else last]
        names = self._file.read(self._names + 20 * low, 20 * (high - low))
        places = struct.unpack(f">{high - low}I", self._file.read(self._offsets + 4 * low, 4 * (high - low)))
        return [(names[20 * i : 20 * i + 20].hex(), self._place(p)) for i, p in enumerate(places)]

    def _place(self, p: int) -> int:
        return p if p < 1 << 31 else struct.unpack(">Q", self._file.read(self._large + 8 * (p & 0x7FFFFFFF), 8))[0]

    def find(self, oid: bytes) -> int:
        """An object's offset, by binary search."""
        low, high = self.fan[oid[0] - 1] if oid[0] else 0, self.fan[oid[0]]
        while low < high:
            middle = (low + high) // 2
            name = self._file.read(self._names + 20 * middle, 20)
            if name == oid:
                return self._place(struct.unpack(">I", self._file.read(self._offsets + 4 * middle, 4))[0])
            low, high = (middle + 1, high) if name < oid else (low, middle)
        raise KeyError(oid.hex())

    def close(self) -> None:
        self._file.close()


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A size in groups of seven bits, the lowest first, and where it ends."""
    value, shift = 0, 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def patched(base: bytes, delta: bytes) -> bytes:
    """What a delta makes of its base: parts of it, copied, and new bytes."""
    size, at = _number(delta, 0)
    if size != len(base):
        raise ValueError("a delta is for another base")
    size, at = _number(delta, at)
    out = bytearray()
    while at < len(delta):
        op = delta[at]
        at += 1
        if not op & 0x80:
            out += delta[at : at + op]
            at += op
            continue
        fields = []
        for bit in range(7):
            fields.append(delta[at] if op >> bit & 1 else 0)
            at += op >> bit & 1
        start, length = int.from_bytes(fields[:4], "little"), int.from_bytes(fields[4:], "little")
        out += base[start : start + (length or 0x10000)]
    if len(out) != size:
        raise ValueError("a delta doesn't give the size it says")
    return bytes(out)


class Pack:
    """One pack; ``at`` gives the object at an offset, its chain of deltas resolved."""

    def __init__(self, path: str):
        self.path, self._file, self._index = path, Ranges(path), None
        self._kept: OrderedDict[int, tuple[int, bytes]] = OrderedDict()
        self._bytes = 0

    def _header(self, offset: int) -> tuple[int, int, int]:
        """Kind, offset of the base (0: none), and where the compressed bytes begin."""
        head = self._file.read(offset, 64)
        kind, at = head[0] >> 4 & 7, 1
        while head[at - 1] & 0x80:
            at += 1
        if kind == OFFSET_DELTA:
            back = head[at] & 0x7F
            while head[at] & 0x80:
                at += 1
                back = (back + 1) << 7 | head[at] & 0x7F
            return kind, offset - back, offset + at + 1
        if kind == NAMED_DELTA:
            self._index = self._index or Index(self.path.removesuffix(".pack") + ".idx")
            return kind, self._index.find(head[at : at + 20]), offset + at + 20
        return kind, 0, offset + at

    def _inflated(self, at: int) -> bytes:
        engine, out, step = zlib.decompressobj(), [], 1 << 12
        while not engine.eof:
            part = self._file.read(at, step)
            if not part:
                raise ValueError(f"{self.path} ends within an object")
            out.append(engine.decompress(part))
            at, step = at + len(part), min(step * 4, 1 << 24)
        return b"".join(out)

    def at(self, offset: int) -> tuple[int, bytes]:
        chain = []
        while offset not in self._kept:
            kind, base, at = self._header(offset)
            chain.append((offset, kind, self._inflated(at)))
            if kind not in (OFFSET_DELTA, NAMED_DELTA):
                break
            offset = base
        else:
            self._kept.move_to_end(offset)
        found = self._kept.get(offset)
        for place, kind, data in reversed(chain):
            found = (kind, data) if found is None else (found[0], patched(found[1], data))
            self._keep(place, found)
        return found

    def _keep(self, offset: int, found: tuple[int, bytes]) -> None:
        self._kept[offset] = found
        self._bytes += len(found[1])
        while self._bytes > KEPT and len(self._kept) > 1:
            self._bytes -= len(self._kept.popitem(last=False)[1][1])

    def close(self) -> None:
        self._file.close()
        if self._index:
            self._index.close()


def objects(spark: SparkSession, path: str) -> DataFrame:
    """``objects_of`` all packs below a folder."""
    return objects_of(listed(spark, path, "*.idx"))


def slices(indexes: DataFrame) -> DataFrame:
    """(path, first, last): the parts in which indexes (path, length) are read, by the first bytes of names."""
    n = F.least(F.ceil(F.col("length") / SLICE), F.lit(256)).cast("int")
    each = indexes.withColumn("n", F.greatest(n, F.lit(1))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return each.select("path", F.floor(F.col("i") * 256 / F.col("n")).cast("int").alias("first"), (F.floor((F.col("i") + 1) * 256 / F.col("n")) - 1).cast("int").alias("last"))


def objects_of(indexes: DataFrame) -> DataFrame:
    """(pack, oid, offset) of all objects in the packs of indexes (path, length); an object that is in several packs is given once.

    An index is read in slices of about a megabyte, so a small one is opened once.
    """
    def read(batches):
        index, out = None, []
        for batch in batches:
            for name, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                if index is None or index[0] != name:
                    if index:
                        index[1].close()
                    index = (name, Index(name))
                pack = name.removesuffix(".idx") + ".pack"
                out += [(pack, oid, place) for oid, place in index[1].slice(first, last)]
                if len(out) >= ROWS:
                    yield _places(out)
                    out = []
        if index:
            index[1].close()
        yield _places(out)

    # As many tasks as shuffles have: names are few bytes that stand for much work.
    dealt = slices(indexes).repartition(int(indexes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "first").sortWithinPartitions("path", "first")
    found = dealt.mapInArrow(read, "pack string, oid string, offset long")
    return written(found.groupBy("oid").agg(F.min(F.struct("pack", "offset")).alias("p")).select("p.pack", "oid", "p.offset"), "git-objects")


def _places(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["pack", "oid", "offset"])


def contents(index: DataFrame, oids: DataFrame, key: str = "oid") -> DataFrame:
    """(oid, kind, data) of distinct objects; those that no pack has are left out."""
    places = index.join(oids.select(F.col(key).alias("oid")).distinct(), "oid")
    dealt = places.repartitionByRange("pack", "offset").sortWithinPartitions("pack", "offset").select("pack", "offset", "oid")

    def read(batches):
        pack = None
        for batch in batches:
            out, size = [], 0
            for name, offset, oid in zip(*(c.to_pylist() for c in batch.columns)):
                if pack is None or pack.path != name:
                    if pack:
                        pack.close()
                    pack = Pack(name)
                kind, data = pack.at(offset)
                out.append((oid, KINDS.get(kind), data))
                size += len(data)
                if size > 1 << 24:
                    yield _batch(out)
                    out, size = [], 0
            yield _batch(out)

    return dealt.mapInArrow(read, "oid string, kind string, data binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.binary()))], ["oid", "kind", "data"])


def roots(index: DataFrame, commits: DataFrame, key: str = "commit") -> DataFrame:
    """(commit, tree): the tree that a commit names in its first line."""
    found = contents(index, commits, key).filter("kind = 'commit'")
    return found.select(F.col("oid").alias(key), F.regexp_extract(F.decode(F.substring("data", 1, 64), "ISO-8859-1"), "^tree ([0-9a-f]{40})", 1).alias("tree"))


def entries(index: DataFrame, trees: DataFrame, key: str = "tree") -> DataFrame:
    """(tree, mode, name, oid) of all entries of distinct trees."""

    def parsed(batches):
        for batch in batches:
            rows = []
            for tree, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = 0
                while at < len(data):
                    blank, end = data.index(b" ", at), data.index(b"\0", at)
                    rows.append((tree, data[at:blank].decode(), data[blank + 1 : end].decode("utf-8", "replace"), data[end + 1 : end + 21].hex()))
                    at = end + 21
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], [key, "mode", "name", "oid"])

    found = contents(index, trees, key).filter("kind = 'tree'").select("oid", "data")
    return found.mapInArrow(parsed, f"{key} string, mode string, name string, oid string")


def blobs(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (commit, path, and what else it has) with ``data``: the file at that path in that commit; null where there is none."""
    asked = wanted.select("commit", "path").distinct()
    parts = F.split("path", "/")
    at = asked.join(roots(index, asked), "commit").withColumn("parts", parts).filter(F.size("parts") > 0)
    at, found, level = written(at.withColumnRenamed("tree", "oid"), "git-level"), [], 0
    while at.head(1):
        step = at.withColumn("name", F.col("parts")[level]).withColumnRenamed("oid", "tree").join(_children(index, at), ["tree", "name"])
        step = written(step, "git-step")
        last = F.size("parts") == level + 1
        found.append(step.filter(last & (F.col("mode") != FOLDER)).select("commit", "path", "oid"))
        at = written(step.filter(~last & (F.col("mode") == FOLDER)).select("commit", "path", "parts", "oid"), "git-level")
        level += 1
    names = wanted.sparkSession.createDataFrame([], "commit string, path string, _oid string")
    for part in found:
        names = names.unionByName(part.withColumnRenamed("oid", "_oid"))
    # Rows get their object's name first, so contents are dealt once.
    named = written(wanted.join(names, ["commit", "path"], "left").select(*wanted.columns, "_oid"), "git-named")
    data = contents(index, named, "_oid").filter("kind = 'blob'").select(F.col("oid").alias("_oid"), "data")
    return named.join(data, "_oid", "left").select(*wanted.columns, "data")


def _children(index: DataFrame, at: DataFrame) -> DataFrame:
    return entries(index, at.select(F.col("oid").alias("tree")), "tree")


def tree_files(index: DataFrame, commits: DataFrame) -> DataFrame:
    """(commit, path, mode, oid) of every file of the commits, one level of folders after the other."""
    at = written(commits.select("commit").distinct().join(roots(index, commits), "commit").select("commit", F.lit("").alias("folder"), F.col("tree").alias("oid")), "git-level")
    found = []
    while at.head(1):
        step = written(at.withColumnRenamed("oid", "tree").join(_children(index, at), "tree").select("commit", F.concat("folder", "name").alias("path"), "mode", "oid"), "git-step")
        found.append(step.filter(F.col("mode") != FOLDER))
        at = written(step.filter(F.col("mode") == FOLDER).select("commit", F.concat("path", F.lit("/")).alias("folder"), "oid"), "git-level")
    out = commits.sparkSession.createDataFrame([], "commit string, path string, mode string, oid string")
    for part in found:
        out = out.unionByName(part)
    return out
