"""Sharding by longest processing time, with groups that stay together.

Rows of equal text form a group.  Groups are scheduled by size, largest first:
each goes to the least loaded shard, ties to the lowest shard.

1. Groups and their sizes, and the number of groups of each size.
2. The driver sees sizes and counts only, from large to small, and keeps the
   loads in a heap.  Of the many groups of a size, all but the last few for each
   shard fill the loads up to one level; a heap over the shards deals out the
   rest one by one.  So each shard gets as many groups of each size as if every
   group had been handled by itself.
3. Groups of a size are ranked by name on Spark, and the lowest shard takes the
   first of them, and so on: a join on size and rank places the groups.
4. Rows get the shard of their group, and slots.

What the driver holds grows with the number of different sizes, not with rows or
groups; their sums are at most the bytes of all texts, so n bytes have at most
sqrt(2 n) of them.

Defined results: a null text has size ``overhead`` and is a group apart from the
empty text; its crc32 is that of no bytes.  Repeated rows are all placed, each in
a slot of its own; rows without a key too.  An empty table gives an empty table;
other columns of the input are ignored.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lintel.llm.words import join_counted, small
from lintel.storage import written

#: Rows are numbered apart in so many parts of each shard.
PARTS = 1024


def level_counts(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` groups of ``size`` every shard surely gets: those that fill the loads up to one level."""
    few, rest = sorted(loads), count - len(loads)
    if rest <= 0:
        return [0] * len(loads)
    total = 0
    for j, load in enumerate(few, 1):
        total += load
        # The level up to which the j lowest can take ``rest`` groups.
        level = (rest * size + total) // j
        if j == len(few) or level <= few[j]:
            break
    # A group goes to a shard before any shard is loaded beyond the level, so all that start below it are sure.
    return [max(0, (level - load) // size) for load in loads]


def schedule(sizes: list[tuple[int, int]], shards: int):
    """(size, shard, from, to): of the groups of a size, ranked from 0, shard has those from ``from`` to before ``to``."""
    loads = [0] * shards
    for size, count in sorted(sizes, reverse=True):
        got = level_counts(loads, size, count)
        heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, got))]
        heapq.heapify(heap)
        for _ in range(count - sum(got)):
            load, shard = heap[0]
            got[shard] += 1
            heapq.heapreplace(heap, (load + size, shard))
        at = 0
        for shard, n in enumerate(got):
            loads[shard] += n * size
            if n:
                yield size, shard, at, at + n
                at += n


def sized(docs: DataFrame, key: str, text: str, overhead: int) -> DataFrame:
    """Narrow rows: key, size, text_crc32 and the group's 128-bit name."""
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.struct(F.xxhash64(text, F.col(text).isNull()).alias("a"), F.xxhash64(F.lit("second"), F.col(text), F.col(text).isNull()).alias("b"))
    return docs.select(F.col(key).alias("key"), (F.octet_length(body) + overhead).cast("long").alias("size"), F.crc32(body).cast("long").alias("text_crc32"), name.alias("name"))


def ranked(groups: DataFrame) -> DataFrame:
    """Groups with their rank among those of their size, from 0: numbered within ranges of the order, a range's start added."""
    ranged = groups.repartitionByRange("bytes", "name").sortWithinPartitions("bytes", "name")
    kept = written(ranged.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "shard-ranked")
    # One row for each size and range that has it.
    starts = kept.groupBy("range", "bytes").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("bytes").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("range", "bytes", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return kept.join(small(written(starts, "shard-starts")), ["range", "bytes"]).select("name", "rows", "bytes", (F.col("start") + F.col("at") - F.col("first")).alias("rank"))


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """Columns key, size, text_crc32, law, shard and slot; sizes of shards are near equal."""
    spark = docs.sparkSession
    rows = written(sized(docs, key, text, overhead), "shard-rows")
    groups = written(rows.groupBy("name").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")), "shard-groups")
    # One row for each size.
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("n")).toArrow()
    plan = list(zip(*schedule(list(zip(sizes["bytes"].to_pylist(), sizes["n"].to_pylist())), shards))) or [[]] * 4
    table = pa.table([pa.array(c, t) for c, t in zip(plan, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["bytes", "shard", "from", "to"])
    # Rows: at most one for each size and shard, and for each group.
    placed = ranked(groups).join(small(spark.createDataFrame(table), table.num_rows), "bytes").filter("rank >= from and rank < to")
    placed = written(placed.select("name", "rows", "shard"), "shard-placed")
    out = numbered(join_counted(rows, placed, "name", "rows", rows.count()))
    return out.select(F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


def numbered(rows: DataFrame) -> DataFrame:
    """Slots, gapless from 0 in each shard: rows are dealt to parts, counted by shard and part, and numbered in each."""
    # Not by key or name, which many rows may share.
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS))), "shard-parts")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "name"))
    # One row for each shard and part: at most shards * PARTS.
    return rows.join(F.broadcast(starts), ["shard", "part"]).withColumn("slot", (F.col("start") + place - 1).cast("long"))
