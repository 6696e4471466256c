"""Greedy filling of chunks in order, without a task that sees a whole group.

1. Narrow rows are dealt to ranges of (group, order) and numbered.
2. Each range, on its own, looks up for every row where a chunk that starts there
   ends (binary search in prefix sums) and, by pointer doubling, how many chunks
   start from there on in the range and what the last of them holds.  A chunk that
   is open when a range begins ends no later than one that starts with the range's
   first row, so only those first rows can be entered: they are kept.
3. The kept rows, one chunk's worth for each range, are read in order with the
   open chunk as the only state, which fixes where each range is entered.
4. Each range is walked once from its entry, and rows get their chunk.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.storage import written

#: Sizes count in thousandths, as whole numbers, so that sums are the same in any order.
UNIT = 1_000


def ends(sums: np.ndarray, starts: np.ndarray, budget: int, most: int | None) -> np.ndarray:
    """Where chunks that start at ``starts`` end, among the rows that ``sums`` (from 0) are of; a chunk has a row at least."""
    found = np.maximum(np.searchsorted(sums, sums[starts] + budget, side="right") - 1, starts + 1)
    found = found if most is None else np.minimum(found, starts + most)
    return np.minimum(found, len(sums) - 1)


def entries(sizes: np.ndarray, budget: int, most: int | None) -> list[tuple[np.ndarray, ...]]:
    """For each row that may be entered: its place, the sum up to and with it, chunks from there on, and the last one's sum and rows."""
    n = len(sizes)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    jump = np.append(ends(sums, np.arange(n), budget, most), n)
    count, last = np.append(np.ones(n, np.int64), 0), np.arange(n + 1)
    first = np.arange(min(jump[0], n - 1) + 1)
    while (jump[:-1] < n).any():
        count = count + count[jump]
        last = np.where(jump < n, last[jump], last)
        jump = jump[jump]
    return first, sums[first + 1], count[first], sums[n] - sums[last[first]], n - last[first]


def numbers(sizes: np.ndarray, entry: int, base: int, budget: int, most: int | None) -> np.ndarray:
    """Chunk of each row of a range: ``base`` up to the row ``entry`` (-1: of all), where the next one starts."""
    starts = np.zeros(len(sizes), np.int64)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    while 0 <= entry < len(sizes):
        starts[entry] = 1
        entry = int(ends(sums, np.array([entry]), budget, most)[0])
    return base + np.cumsum(starts)


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names)


def chunked(df: DataFrame, by: str, order: str, size: Column, budget: float, max_rows: int | None = None) -> DataFrame:
    """``df`` with ``chunk`` numbers, from 1, within ``by`` by greedy filling in the order of ``order``.

    A row that would break the budget, or be one more than ``max_rows``, opens a
    chunk; a row beyond the budget is a chunk of its own.  A null group is a group;
    null keys come first; of equal keys the smaller size comes first; sizes that are
    null or negative count as 0; every row comes back once; a column ``chunk`` of
    ``df`` is replaced; an empty table stays empty.
    """
    limit, most = int(budget * UNIT), max_rows
    kept = written(df.drop("chunk").withColumns({"_size": F.greatest(F.coalesce(F.round(size * UNIT).cast("long"), F.lit(0)), F.lit(0)), "_id": F.monotonically_increasing_id()}), "chunk-rows")
    ranged = kept.select(F.col(by).alias("by"), F.col(order).alias("key"), "_size", "_id").repartitionByRange("by", "key", "_size").sortWithinPartitions("by", "key", "_size", "_id")
    ranged = ranged.select(F.col("by").cast("string").alias("by"), "_size", "_id", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"))
    narrow = written(ranged, "chunk-ranges")

    def looked_up(batches):
        for (name, part), rows in groupby(_rows(batches), key=lambda r: (r[0], r[1])):
            at, sizes = zip(*((r[2], r[3]) for r in rows))
            sizes = np.array(sizes, np.int64)
            n, found = len(sizes), entries(sizes, limit, most)
            # Behind them: what the range adds to an open chunk that it doesn't end.
            whole = ([n], [int(sizes.sum())], [0], [0], [0])
            found = [np.concatenate([a, b]) for a, b in zip(found, whole)]
            head = [pa.array([name] * len(found[0]), pa.string()), pa.array([part] * len(found[0]), pa.int32()), pa.array([at[0]] * len(found[0]), pa.int64())]
            yield pa.RecordBatch.from_arrays([*head, *(pa.array(c, pa.int64()) for c in found)], ["by", "range", "at", "place", "sum", "count", "last_sum", "last_rows"])

    def stitched(batches):
        names, types = ["range", "at", "entry", "base"], [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            open_sum, open_rows, base, out = 0, 0, 0, []
            for (part, at), places in groupby(rows, key=lambda r: (r[1], r[2])):
                entered = None
                for _, _, _, place, total, count, last_sum, last_rows in places:
                    if not count:  # the whole range
                        if entered is None:
                            entered = (-1, base, open_sum + total, open_rows + place, base)
                    elif entered is None and (not open_rows or open_sum + total > limit or most is not None and open_rows + place >= most):
                        entered = (place, base, last_sum, last_rows, base + count)
                entry, before, open_sum, open_rows, base = entered
                out.append((part, at, entry, before))
                if len(out) >= 10_000:
                    yield _batch(out, names, types)
                    out = []
            yield _batch(out, names, types)

    def walked(batches):
        def out(ids, sizes, entry, base):
            found = numbers(np.array(sizes, np.int64), entry, base, limit, most)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.int64())], ["_id", "chunk"])

        head, ids, sizes = None, [], []
        for _, _, is_row, number, value in _rows(batches):
            if is_row:
                ids.append(number)
                sizes.append(value)
                continue
            if ids:
                yield out(ids, sizes, *head)
            head, ids, sizes = (number, value), [], []
        if ids:
            yield out(ids, sizes, *head)

    dealt = narrow.repartition("range").sortWithinPartitions("range", "at").select("by", "range", "at", "_size")
    places = dealt.mapInArrow(looked_up, "by string, range int, at long, place long, sum long, count long, last_sum long, last_rows long")
    inside = places.repartition("by").sortWithinPartitions("by", "range", "at", "place").mapInArrow(stitched, "range int, at long, entry long, base long")
    # An entry stands right before its range's first row.
    heads = inside.select("range", "at", F.lit(0).alias("is_row"), F.col("entry").alias("number"), F.col("base").alias("value"))
    rows = narrow.select("range", "at", F.lit(1).alias("is_row"), F.col("_id").alias("number"), F.col("_size").alias("value"))
    chunks = heads.unionByName(rows).repartition("range").sortWithinPartitions("range", "at", "is_row").mapInArrow(walked, "_id long, chunk long")
    return kept.join(chunks, "_id").drop("_id", "_size")
