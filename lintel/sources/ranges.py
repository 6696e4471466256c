"""Parts of files by offset, read inside tasks on any file system that pyarrow opens."""

from __future__ import annotations

import re

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Bytes that are fetched at once for small reads.
BLOCK = 1 << 20


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a local path; Spark writes ``file:/x`` for ``file:///x``."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


class Ranges:
    """One open file; small reads that follow one another are served from one fetched block."""

    def __init__(self, path: str, block: int = BLOCK):
        fs, at = _place(path)
        self.path, self._block_size, self._file = path, block, fs.open_input_file(at)
        self.size = self._file.size()
        self._start, self._block = 0, b""

    def read(self, offset: int, length: int) -> bytes:
        """``length`` bytes from ``offset``, fewer at the end of the file."""
        at = offset - self._start
        if not (0 <= at and at + length <= len(self._block)):
            self._block, self._start, at = self._file.read_at(max(length, min(self._block_size, self.size)), offset), offset, 0
        return self._block[at : at + length]

    def close(self) -> None:
        self._file.close()


def write_bytes(path: str, data: bytes) -> None:
    fs, at = _place(path)
    fs.create_dir(at.rpartition("/")[0])
    with fs.open_output_stream(at) as out:
        out.write(data)


def listed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, length) of all files below a folder whose name is like ``pattern``; their content isn't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", "length")
