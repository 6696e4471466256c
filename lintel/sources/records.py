"""Records of CSV files whose quoted fields hold line breaks, with the files still split into blocks.

A line break ends a record unless it lies within quotes, so between lines a reader
is in one of two states.  Each block of a file, read by itself, says in which state
it ends for either state at its start; those functions are constant, the identity
or a swap, so the state in which a block is entered follows from the last constant
one before it and the number of swaps since.  Then each block is read once more from
its state, and only the records that cross a border are put together by a grouping.

Fields are those of Python's csv module: a quote counts where a field begins with
it and, within such a field, doubled; elsewhere it is a character like others.
"""

from __future__ import annotations

import csv
import io
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lintel.storage import written

OUTSIDE, INSIDE = 0, 1
#: Blocks whose states are sent to all tasks; those of more are joined by a shuffle.
BROADCAST_BLOCKS = 100_000
BATCH_BYTES = 8 << 20
#: Records whose fields are held at once.
RECORDS = 128
_to_quote = re.compile(r'[^"]*+(?:""[^"]*+)*+"(?!")').match


def state_after(line: str, state: int, comma: str = ",") -> int:
    """The state at the end of a line that begins in ``state``."""
    at = 0
    while True:
        if state == INSIDE:
            closing = _to_quote(line, at)
            if not closing:
                return INSIDE
            # What follows a closing quote belongs to the field as it is.
            at = line.find(comma, closing.end())
            if at < 0:
                return OUTSIDE
            at += 1
        # Outside, at the beginning of a field: fields without a quote in front are passed over.
        while not line.startswith('"', at):
            at = line.find(comma, at) + 1
            if not at:
                return OUTSIDE
        state, at = INSIDE, at + 1


def fields(record: str, comma: str = ",") -> list[str]:
    csv.field_size_limit(1 << 31)
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=comma), [])


def _lines(batches):
    """(path, start, at, line) with text for bytes; a line end of two characters keeps its first for now."""
    for batch in batches:
        path, start, at, lines = (batch.column(i) for i in range(4))
        for p, s, a, line in zip(path.to_pylist(), start.to_pylist(), at.to_pylist(), lines.to_pylist()):
            yield p, s, a, line.decode("utf-8", "replace")


def csv_records(spark: SparkSession, path: str, comma: str = ",") -> DataFrame:
    """(path, start, at, fields) of every record that isn't blank; start and at give the order within a file.

    Bytes that are no UTF-8 are replaced.  A quote that is never closed makes one
    record of the rest of its file.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("line"))

    def ends(batches):
        for (name, start), lines in groupby(_lines(batches), key=lambda r: r[:2]):
            after = [OUTSIDE, INSIDE]
            for _, _, _, line in lines:
                after = [state_after(line, s, comma) for s in after] if '"' in line else [OUTSIDE if s == OUTSIDE else INSIDE for s in after]
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([start], pa.int64()), pa.array([after[0]], pa.int32()), pa.array([after[1]], pa.int32())], ["path", "start", "outside", "inside"])

    blocks = written(raw.mapInArrow(ends, "path string, start long, outside int, inside int"), "csv-blocks")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # One narrow row for each block of a file.
    blocks = blocks.withColumn("swap", ((F.col("outside") == INSIDE) & (F.col("inside") == OUTSIDE)).cast("int"))
    blocks = blocks.withColumn("swaps", F.coalesce(F.sum("swap").over(before), F.lit(0)))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").alias("state"), "swaps"))
    last = F.last(fixed, ignorenulls=True).over(before)
    state = (F.coalesce(last["state"], F.lit(OUTSIDE)) + F.col("swaps") - F.coalesce(last["swaps"], F.lit(0))) % 2
    entered = written(blocks.select("path", "start", state.cast("int").alias("state")), "csv-entered")
    entered = F.broadcast(entered) if entered.count() <= BROADCAST_BLOCKS else entered
    ordered = raw.join(entered, ["path", "start"]).sortWithinPartitions("path", "start", "at").select("path", "start", "at", "line", "state")

    def parts(batches):
        """Pieces of records: ``first`` where the record begins in the block, ``last`` where it ends there."""
        out, size = [], 0
        rows = ((b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py(), b.column(3)[i].as_py().decode("utf-8", "replace"), b.column(4)[i].as_py()) for b in batches for i in range(b.num_rows))
        for (name, start), lines in groupby(rows, key=lambda r: r[:2]):
            begun, held, state, place = False, [], None, None
            for _, _, at, line, entry in lines:
                state = entry if state is None else state
                if not held:
                    begun, place = state == OUTSIDE, at
                held.append(line)
                state = state_after(line, state, comma)
                if state == OUTSIDE:
                    out.append((name, start, place, begun, True, "\n".join(held)))
                    size += len(out[-1][-1])
                    held = []
                if size > BATCH_BYTES:
                    yield _pieces(out)
                    out, size = [], 0
            if held:
                out.append((name, start, place, begun, False, "\n".join(held)))
                size += len(out[-1][-1])
        yield _pieces(out)

    pieces = written(ordered.mapInArrow(parts, "path string, start long, at long, first boolean, last boolean, text string"), "csv-pieces")
    # At most two pieces of a block go on; each that begins a record numbers those behind it.
    broken = pieces.filter(~F.col("first") | ~F.col("last"))
    number = F.sum(F.col("first").cast("int")).over(Window.partitionBy("path").orderBy("start", "at"))
    whole = broken.withColumn("n", number).groupBy("path", "n").agg(F.array_sort(F.collect_list(F.struct("start", "at", "text"))).alias("p"))
    whole = whole.select("path", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["at"].alias("at"), F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))

    def split(batches):
        """Few records at once: a batch holds thousands, each of which may be a whole text."""
        for batch in batches:
            for low in range(0, batch.num_rows, RECORDS):
                part = batch.slice(low, RECORDS)
                found = pa.array([fields(r.removesuffix("\r"), comma) for r in part.column(3).to_pylist()], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), found], ["path", "start", "at", "fields"])

    every = pieces.filter("first and last").select("path", "start", "at", "text").unionByName(whole)
    return every.filter(~F.col("text").isin("", "\r")).mapInArrow(split, "path string, start long, at long, fields array<string>")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["path", "start", "at", "first", "last", "text"])
