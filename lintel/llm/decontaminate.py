"""Benchmark decontamination by a prefix-filtered set join, in DataFrame expressions only.

A window is ``size`` consecutive words of a benchmark item, or all words of a
shorter item.  Containing a window means containing all of its one-word
shingles, so the necessary prefix of a window is a single word; ordered by
rarity, that is the word with the fewest occurrences in the documents.

1. Count the benchmark's words in all documents; windows with an absent word go.
2. Join the documents' words with the windows' rarest words.
3. Bounds: the window must fit into the document at that position.
4. Verify: the document's words in that stretch are exactly the window's.

The benchmark's words and windows are broadcast up to a checked number of rows
and shuffled beyond.  Lists of windows with one rarest word are cut into blocks.

Defined results: null and empty texts have no words and are never hit; items
without words have no window; repeated items count once by their id; repeated
rows of documents get equal results; empty tables are fine on either side; all
columns of the documents are kept, whatever their names, and a column with an
output's name is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.llm.words import row_name, set_aside, small, split_words
from lintel.storage import written

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
BLOCK = 256
OUTPUTS = ("n_words", "n_hit", "items", "hits", "contaminated")


def words(text: Column) -> Column:
    return split_words(text, SEPARATORS)


def windows(bench: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Distinct windows: window (words joined by a blank), n, parts and the items that hold them."""
    items = bench.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    each = items.withColumn("n", n).select("item", "n", "w", F.explode(starts).alias("at")).select("item", "n", F.slice("w", F.col("at"), F.col("n")).alias("parts"))
    return each.groupBy("parts", "n").agg(F.sort_array(F.collect_set("item")).alias("items")).withColumn("window", F.array_join("parts", " "))


def with_rarest(found: DataFrame, docs_words: DataFrame) -> DataFrame:
    """Blocks of windows by their rarest word: word, block, list of (offset, n, window, items)."""
    parts = found.select("window", F.posexplode("parts").alias("offset", "word"))
    vocabulary = written(parts.select("word").distinct(), "decontaminate-words")
    seen = docs_words.select(F.explode("w").alias("word")).join(small(vocabulary), "word", "left_semi")
    counts = written(seen.groupBy("word").agg(F.count("*").alias("df")), "decontaminate-counts")
    rarity = parts.join(small(counts), "word", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word", "offset")).alias("r"))
    chosen = found.join(rarity.filter("r.df > 0"), "window").select("window", "n", "items", "r.word", "r.offset")
    blocks = chosen.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("word").orderBy("window")) - 1) / BLOCK))
    return blocks.groupBy("word", "block").agg(F.collect_list(F.struct("offset", "n", "window", "items")).alias("windows"))


def _hits(w: Column, candidates: Column) -> Column:
    """Verified occurrences (start, n, items) of candidate windows in the words ``w``."""

    def fits(at, window):
        start = at - window["offset"]
        inside = (start >= 0) & (start + window["n"] <= F.size(w))
        return F.when(inside, F.array_join(F.slice(w, start + 1, window["n"]), " ") == window["window"]).otherwise(F.lit(False))

    def at_position(candidate, at):
        good = F.filter(candidate["windows"], lambda x: fits(at, x))
        return F.transform(good, lambda x: F.struct((at - x["offset"]).alias("start"), x["n"].alias("n"), x["items"].alias("items")))

    return F.flatten(F.transform(candidates, lambda c: F.flatten(F.transform(c["at"], lambda at: at_position(c, at)))))


def decontaminate(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 13, share: int = 20) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids of items that occur), hits and contaminated (share * n_hit >= n_words > 0)."""
    docs, back = set_aside(docs, key, text, OUTPUTS)
    rows = docs.withColumn("rid", row_name(F.col("key"), F.col("text")))
    found = written(windows(bench, item, item_text, size), "decontaminate-windows")
    blocks = written(with_rarest(found, docs.select(words(F.col("text")).alias("w"))), "decontaminate-blocks")
    places = rows.select("rid", F.posexplode(words(F.col("text"))).alias("at", "word"))
    keys = small(blocks.select("word").distinct())
    met = places.join(keys, "word", "left_semi").groupBy("rid", "word").agg(F.collect_set("at").alias("at"))
    candidates = met.join(small(blocks), "word").groupBy("rid").agg(F.collect_list(F.struct("at", "windows")).alias("candidates"))
    out = rows.join(candidates, "rid", "left").withColumn("w", words(F.col("text")))
    none = F.array().cast("array<struct<start:int,n:int,items:array<string>>>")
    # The partition's number is not deterministic to the optimizer: hits are computed once, and filters on what follows from them stay above.
    some = F.col("candidates").isNotNull() & (F.spark_partition_id() >= 0)
    out = out.withColumn("hits", F.when(some, _hits(F.col("w"), F.col("candidates"))).otherwise(none))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))))
    out = (
        out.withColumn("n_words", F.size("w").cast("long"))
        .withColumn("n_hit", F.size(covered).cast("long"))
        .withColumn("items", F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )
    return back(out, *OUTPUTS)
