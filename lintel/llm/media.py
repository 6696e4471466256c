"""Media columns: payloads in archives, read back through a Spark data source.

Writing: each task puts its rows' payloads, as 8-bit mono WAV files, into ZIP
archives below a shared folder and returns one row per finished archive; these
rows are kept as a table, so archives of tasks that were repeated are never read.

Reading: ``ArchiveSource`` is a Python data source.  The driver lists only
archives and their sizes and plans byte ranges over them; the task of a range
reads the archive's directory (at its end), takes the members whose headers
start in the range and streams their payloads as Arrow batches.  A member that
can't be read is tried again by itself at its offset; one that stays unreadable
gives a row with null media and the error.

Files are opened with pyarrow's file systems, so archives may lie wherever these
reach (file, hdfs, s3, gs).

Defined results: a null payload is stored as the empty payload; null keys are
stored and come back as null; repeated rows are stored and read each by itself;
an empty table gives an empty table.
"""

from __future__ import annotations

import io
import struct
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ARCHIVE_BYTES = 128 << 20
RANGE_BYTES = 8 << 20
#: Ranges that the driver plans at most, besides one for each archive.
MOST_RANGES = 100_000
BATCH_BYTES = 4 << 20
ATTEMPTS = 3
RATE = 8000

MEMBER = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("key", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("error", pa.string())])
MEMBER_DDL = "archive string, offset long, key long, n_bytes long, media binary, error string"


def opened(uri: str):
    """(file system, path) of a URI."""
    return fs.FileSystem.from_uri(uri)


def padded(payload: bytes, unit: int, fill: bytes = b" ") -> bytes:
    """``payload`` filled up to a positive multiple of ``unit``."""
    return payload + fill * (-len(payload) % unit or (0 if payload else unit))


def wav(samples: bytes) -> bytes:
    """An 8-bit mono WAV file; ``samples`` has an even length."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples)) + samples


def wav_samples(media: bytes) -> bytes:
    """The samples of an 8-bit mono WAV file, its chunks walked one by one."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, kind = 12, None
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            kind = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data":
            if kind is None or kind[0] != 1 or kind[1] != 1 or kind[5] != 8:
                raise ValueError("not 8-bit mono PCM")
            if at + 8 + size > len(media):
                raise ValueError("the file ends within its samples")
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def features(samples: bytes) -> str:
    """Duration, mean, root mean square, peak, zero crossings and the energy of eight equal stretches."""
    x = np.frombuffer(samples, np.uint8).astype(np.int16) - 128
    if not len(x):
        return "ms=0"
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    power = x.astype(np.int32) ** 2
    ends = np.linspace(0, len(x), 9).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(power, dtype=np.int64)])
    stretch = [int(round((sums[b] - sums[a]) / max(1, b - a))) for a, b in zip(ends, ends[1:])]
    return f"ms={len(x) * 1000 // RATE};mean={x.mean():.4f};rms={np.sqrt(sums[-1] / len(x)):.4f};peak={int(np.abs(x).max())};crossings={crossings};energy={','.join(map(str, stretch))}"


class _Archives:
    """Writes members into archives of bounded size; collects a row for each finished archive."""

    def __init__(self, folder: str):
        self.fs, self.folder = opened(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.zip, self.done, self.members = None, [], 0

    def add(self, key, n_bytes: int, media: bytes) -> None:
        if self.zip is None:
            self.name = f"{uuid.uuid4().hex}.zip"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        name = f"{self.members}/{'' if key is None else key}/{n_bytes}.wav"
        self.zip.writestr(zipfile.ZipInfo(name), media, zipfile.ZIP_DEFLATED, 1)
        self.members += 1
        if self.out.tell() >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.zip is not None:
            self.zip.close()
            size = self.out.tell()
            self.out.close()
            self.done.append((self.name, size, self.members))
            self.zip, self.members = None, 0


def store(df: DataFrame, folder: str, key: str = "doc_id", payload: str = "payload", unit: int = 192) -> DataFrame:
    """Write every row's payload into archives in ``folder``; rows (archive, bytes, members) of finished archives."""

    def write(batches):
        archives = _Archives(folder)
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py() or b""
                archives.add(k, len(data), wav(padded(data, unit)))
        archives.close()
        yield pa.RecordBatch.from_pylist([{"archive": a, "bytes": b, "members": m} for a, b, m in archives.done], pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("members", pa.int64())]))

    from pyspark.sql import functions as F

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(payload).cast("binary").alias("payload"))
    return rows.mapInArrow(write, "archive string, bytes long, members long")


class ByteRange(InputPartition):
    def __init__(self, archive: str, start: int, stop: int):
        self.archive, self.start, self.stop = archive, start, stop


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.directory = options.get("directory")
        self.step = int(options.get("rangebytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def archives(self) -> list[tuple[str, int]]:
        """Finished archives and sizes: those of the directory table, or else all in the folder."""
        if self.directory:
            import pyarrow.dataset as ds

            files, path = opened(self.directory)
            found = ds.dataset(path, format="parquet", filesystem=files).to_table(columns=["archive", "bytes"])
            return list(zip(found["archive"].to_pylist(), found["bytes"].to_pylist()))
        files, path = opened(self.folder)
        return [(f.base_name, f.size) for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.base_name.endswith(".zip")]

    def partitions(self) -> list[ByteRange]:
        """Byte ranges; they grow with the total, so that there are at most ``MOST_RANGES`` and one for each archive."""
        found = sorted(self.archives())
        step = max(self.step, -(-sum(size for _, size in found) // MOST_RANGES))
        return [ByteRange(name, at, min(at + step, size)) for name, size in found for at in range(0, size, step)] or [ByteRange("", 0, 0)]

    def _member(self, files, path: str, info: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        """A member's payload, read by itself at its offset, again if need be."""
        why = None
        for _ in range(self.attempts):
            try:
                with files.open_input_file(path) as f:
                    return _payload(f, info), None
            except (OSError, ValueError, zlib.error, struct.error) as e:
                why = f"{type(e).__name__}: {e}"
        return None, why

    def read(self, part: ByteRange):
        if not part.archive:
            return
        files, folder = opened(self.folder)
        path = f"{folder}/{part.archive}"
        with files.open_input_file(path) as f:
            members = [i for i in zipfile.ZipFile(f).infolist() if part.start <= i.header_offset < part.stop]
            rows, held = [], 0
            for info in sorted(members, key=lambda i: i.header_offset):
                try:
                    media, why = _payload(f, info), None
                except (OSError, ValueError, zlib.error, struct.error):
                    media, why = self._member(files, path, info)
                _, key, n = info.filename.split("/")
                rows.append((part.archive, info.header_offset, int(key) if key else None, int(n.removesuffix(".wav")), media, why))
                held += len(media or b"")
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _payload(f, info: zipfile.ZipInfo) -> bytes:
    f.seek(info.header_offset)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no member at this offset")
    name, extra = struct.unpack_from("<HH", head, 26)
    f.seek(info.header_offset + 30 + name + extra)
    data = f.read(info.compress_size)
    media = zlib.decompress(data, -15) if info.compress_type == zipfile.ZIP_DEFLATED else data
    if len(media) != info.file_size or zlib.crc32(media) != info.CRC:
        raise ValueError("the member's length or checksum differs")
    return media


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MEMBER)], schema=MEMBER)


class ArchiveSource(DataSource):
    """``spark.read.format("lintel_archive").option("path", folder)``; options directory, rangeBytes, attempts."""

    @classmethod
    def name(cls) -> str:
        return "lintel_archive"

    def schema(self) -> str:
        return MEMBER_DDL

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def stored(spark: SparkSession, folder: str, directory: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Members of the archives in ``folder``, streamed from byte ranges."""
    spark.dataSource.register(ArchiveSource)
    read = spark.read.format("lintel_archive").option("path", folder).option("rangeBytes", str(range_bytes))
    return (read.option("directory", directory) if directory else read).load()
