"""Members of ZIP archives by offset: directories first, contents only of what is wanted.

An archive's directory stands at its end; a task reads it in blocks and gives a row
for each member with its place.  Which members are wanted is a join or filter on
that narrow table.  Those are dealt to ranges of (archive, place), and a task
fetches each member's own bytes, so what is read follows what is asked for, and an
archive of any size is shared by many tasks.  A member is one value of a row, so it
must be below 2 GB.
"""

from __future__ import annotations

import struct
import zlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.sources.ranges import Ranges, listed

STORED, DEFLATED = 0, 8
#: Bytes fetched at once: of a directory, and of a member's own header.
DIRECTORY_BLOCK, HEADER_BLOCK = 1 << 20, 512
BATCH_BYTES, BATCH_ROWS = 8 << 20, 10_000
_END = struct.Struct("<4s4H2IH")
_LARGE_PLACE = struct.Struct("<4sIQI")
_LARGE_END = struct.Struct("<4sQ2H2I4Q")
_ENTRY = struct.Struct("<4s6H3I5H2I")
_LOCAL = struct.Struct("<4s5H3I2H")
ALL_ONES = 0xFFFFFFFF
MEMBERS = "archive string, entry string, method int, crc long, packed long, size long, place long"


def _directory(f: Ranges) -> tuple[int, int, int] | None:
    """Where the directory begins and ends, and by how much all places are off (bytes before the archive); None without one."""
    tail = min(f.size, (1 << 16) + _END.size + _LARGE_PLACE.size)
    data = f.read(f.size - tail, tail)
    at = data.rfind(b"PK\5\6")
    if at < 0 or at + _END.size > len(data):
        return None
    _, _, _, _, _, size, start, _ = _END.unpack_from(data, at)
    end = f.size - tail + at
    if at >= _LARGE_PLACE.size and data[at - _LARGE_PLACE.size :][:4] == b"PK\6\7":
        end -= _LARGE_PLACE.size + _LARGE_END.size
        large = _LARGE_END.unpack(f.read(end, _LARGE_END.size))
        size, start = large[8], large[9]
    return end - size, end, end - size - start


def _entries(f: Ranges, start: int, end: int, off: int):
    """(name, method, crc, packed, size, place) of every member that isn't a folder."""
    at = start
    while at < end:
        fields = _ENTRY.unpack(f.read(at, _ENTRY.size))
        if fields[0] != b"PK\1\2":
            raise ValueError(f"{f.path}: no entry where the directory has one")
        flags, method, crc, packed, size, n, m, k, place = fields[3], fields[4], *fields[7:13], fields[16]
        rest = f.read(at + _ENTRY.size, n + m)
        name = rest[:n].decode("utf-8" if flags & 0x800 else "cp437")
        sizes = [size, packed, place]
        if ALL_ONES in sizes:
            sizes = _large(rest[n:], sizes)
        if not name.endswith("/"):
            if flags & 1 or method not in (STORED, DEFLATED):
                raise ValueError(f"{f.path}: {name} is encrypted or of an unknown method")
            yield name, method, crc, sizes[1], sizes[0], sizes[2] + off
        at += _ENTRY.size + n + m + k


def _large(extra: bytes, sizes: list[int]) -> list[int]:
    """Sizes and place with those that don't fit into 32 bits from the extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if s == ALL_ONES else s for s in sizes]
        at += 4 + length
    return sizes


def members(spark: SparkSession, path: str, named: str = "*.zip") -> DataFrame:
    """``MEMBERS`` of all archives below a folder; a file without a directory gives no rows, folders are left out."""

    def read(batches):
        rows: list[tuple] = []
        for batch in batches:
            for name in batch.column(0).to_pylist():
                f = Ranges(name, DIRECTORY_BLOCK)
                found = _directory(f)
                for member in _entries(f, *found) if found else ():
                    rows.append((name, *member))
                    if len(rows) >= BATCH_ROWS:
                        yield _rows(rows)
                        rows = []
                f.close()
        yield _rows(rows)

    paths = listed(spark, path, named)
    return paths.select("path").repartition("path").mapInArrow(read, MEMBERS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in MEMBERS.split(", ")]
    types = (pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def content(f: Ranges, method: int, crc: int, packed: int, size: int, place: int) -> bytes:
    head = _LOCAL.unpack(f.read(place, _LOCAL.size))
    if head[0] != b"PK\3\4":
        raise ValueError(f"{f.path}: no member at {place}")
    data = f.read(place + _LOCAL.size + head[9] + head[10], packed)
    if method == DEFLATED:
        data = zlib.decompress(data, -15, max(size, 1))
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError(f"{f.path}: the member at {place} is damaged")
    return data


def with_content(wanted: DataFrame) -> DataFrame:
    """(archive, entry, content) of rows with the columns ``MEMBERS``, each member once."""

    def read(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for archive, mine in groupby(rows, key=lambda r: r[0]):
            f, out, size = Ranges(archive, HEADER_BLOCK), [], 0
            for _, place, entry, method, crc, packed, length in mine:
                out.append((entry, content(f, method, crc, packed, length, place)))
                size += length
                if size >= BATCH_BYTES:
                    yield _contents(archive, out)
                    out, size = [], 0
            yield _contents(archive, out)
            f.close()

    once = wanted.groupBy("archive", "place").agg(*(F.first(c).alias(c) for c in ("entry", "method", "crc", "packed", "size")))
    dealt = once.repartitionByRange("archive", "place").sortWithinPartitions("archive", "place")
    return dealt.mapInArrow(read, "archive string, entry string, content binary")


def _contents(archive: str, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["archive", "entry", "content"])


def suffix_keys(path: str, parts: list[int]):
    """array<string>: the last n parts of a path without its ending, for each n of ``parts`` that it has."""
    names = F.split(F.regexp_replace(path, r"\.[^./]*\z", ""), "/")
    return F.filter(F.array(*(F.when(F.size(names) >= n, F.array_join(F.slice(names, -n, n), "/")) for n in parts)), lambda k: k.isNotNull())


def matched(wanted: DataFrame, entries: DataFrame, entry: str = "entry") -> DataFrame:
    """``wanted`` (archive, file: a path without its ending) with the rows of ``entries`` (archive, ``entry``) whose path ends in it.

    Paths meet in their last parts, as many as the wanted path has but for its first,
    which may begin within a folder's name; so files that share a simple name only
    don't meet.
    """
    depth = F.greatest(F.size(F.split("file", "/")) - 1, F.lit(1))
    # One number for each depth of package.
    depths = sorted(r[0] for r in wanted.select(depth.alias("n")).distinct().collect())
    left = wanted.withColumn("_key", F.array_join(F.slice(F.split("file", "/"), -depth, depth), "/"))
    right = entries.withColumn("_key", F.explode(suffix_keys(entry, depths))) if depths else entries.withColumn("_key", F.lit(None).cast("string"))
    met = left.join(right, ["archive", "_key"])
    stem = F.regexp_replace(entry, r"\.[^./]*\z", "")
    return met.filter(F.endswith(stem, F.col("file"))).drop("_key")
