"""Line dedup by a deletion-neighbourhood join, in DataFrame expressions only.

Lines are compared by their words (lower case A-Z, cut at white space).  Lines
of the same words are duplicates; lines of at least ``near_words`` words that
are one word edit apart (a word put in, taken out or replaced) are near
duplicates.  A line goes if an earlier line, in the order of document id, row
hash and line number, is its duplicate or near duplicate.

1. Distinct lines, each with its earliest place.
2. Lines one edit apart agree in their first or their last half; lines that
   share no half with another line emit nothing further.  No partner is lost.
3. Deletion neighbourhood: a line emits, for each position outside of a half it
   shares, the hash of what is left when that word is out, and of itself with a
   gap there; both hashes come from running sums over word hashes, so a line
   emits in proportion to its length.
4. Equal variants meet at their earliest line (no pairs among the others).
5. Word by word, each meeting is verified to be one edit; the earlier line wins.

The edit bound is one word.  Shorter lines than ``near_words`` (a parameter) go only if
they are repeated exactly, since a word is too large a part of them.

Defined results: blank lines are never dropped; null texts have no lines and stay
null; repeated rows of one id and text count as one document, each row getting
the same result; rows without an id come first in the order; an empty table gives
an empty table; all columns are kept, whatever their names, and a column with an
output's name is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.llm.words import join_counted, lowered, row_name, set_aside
from lintel.storage import written

NEAR_WORDS = 8
OUTPUTS = ("n_lines", "n_exact", "n_near", "kept")
#: Two hashes of a line's words; as columns of their own they sort and group faster than as a struct.
LINE = ("line_a", "line_b")
BLANKS, IN_LINE, WORD = r"[\x20\x09-\x0D]+", r"[\x20\x09\x0B-\x0D]+", r"[^\x20\x09-\x0D]"
#: Lines without any of these have single blanks between words already.
UNEVEN = ("  ", "\t", "\v", "\f", "\r")


def line_words(line: Column) -> Column:
    """The words of a line joined by blanks."""
    return F.trim(F.regexp_replace(lowered(line), BLANKS, " "))


def _even(line: Column) -> Column:
    """A lower-case line with single blanks between its words and none at its ends."""
    return F.trim(F.when(reduce(or_, (F.contains(line, F.lit(x)) for x in UNEVEN)), F.regexp_replace(line, IN_LINE, " ")).otherwise(line))


def _lines(rows: DataFrame, near_words: int) -> DataFrame:
    """key, rid, i, the hashes of every line with words, and those of its halves if it has ``near_words``.

    One step a select: what a generator, a filter or a branch names again and again is computed each time, a column once.
    """
    each = rows.select("key", "rid", F.posexplode(F.split("text", "\n", -1)).alias("i", "l")).filter(F.col("l").rlike(WORD))
    each = each.withColumn("l", lowered(F.col("l"))).withColumn("l", _even(F.col("l")))
    each = each.withColumn("n", F.octet_length("l") - F.octet_length(F.replace("l", F.lit(" "))) + 1)
    each = each.withColumn("half", F.floor(F.col("n") / 2).cast("int"))
    each = each.withColumn("head", _words(F.col("l"), F.col("half"))).withColumn("tail", _words(F.col("l"), -F.col("half")))
    halves = F.when(F.col("n") >= near_words, _halves(F.col("n"), F.col("half"), F.col("head"), F.col("tail")))
    return each.select("key", "rid", "i", F.xxhash64("l").alias(LINE[0]), F.xxhash64(F.lit("second"), "l").alias(LINE[1]), halves.alias("halves"))


def _words(line: Column, count: Column) -> Column:
    """The first words of a line, or the last ones if ``count`` is negative."""
    return F.call_function("substring_index", line, F.lit(" "), count)


def _halves(n: Column, half: Column, head: Column, tail: Column) -> Column:
    """Hashes of the first and the last half of n words, in turns; of an even n also of one word less, as lines of n - 1 words have it."""
    hashes = lambda size, first, last: [F.xxhash64(size, F.lit("first"), first), F.xxhash64(size, F.lit("last"), last)]
    own, less = hashes(half, head, tail), half - 1
    return F.when(n % 2 == 1, F.array(*own)).otherwise(F.array(*own, *hashes(less, _words(head, less), _words(tail, -less))))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are exactly one edit apart."""
    return F.when(F.size(a) == F.size(b), F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d)) == 1).otherwise(
        F.when(F.size(a) == F.size(b) + 1, _one_more(a, b)).when(F.size(b) == F.size(a) + 1, _one_more(b, a)).otherwise(F.lit(False))
    )


def _one_more(a: Column, b: Column) -> Column:
    """Whether ``a`` without one of its words is ``b``: what follows the first difference must agree."""
    at = F.array_position(F.zip_with(F.slice(a, F.lit(1), F.size(b)), b, lambda x, y: x != y), True).cast("int")
    return F.when(at == 0, F.lit(True)).otherwise(F.slice(a, at + 1, F.size(b) - at + 1) == F.slice(b, at, F.size(b) - at + 1))


def _variants(words: DataFrame) -> DataFrame:
    """(key, line): a key for every word left out and for every gap of each line, but not inside a half that it shares.

    ``head`` and ``tail`` say whether another line has its first, or its last, half.
    If both lines of an insertion agree in the first m words, the word that is out
    may be taken behind them: one inside them is repeated up to there.
    """
    each = words.select(*LINE, "head", "tail", F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))
    # 32 bits of a hash: sums over 2^31 words stay within a long.  Two independent sums, as lines of one key are verified against its earliest only.
    part = lambda *of: F.shiftrightunsigned(F.xxhash64(*of), 32)
    from_end = F.col("n") - F.col("i")
    each = each.select(*LINE, "head", "tail", "n", "i", part("w", "i").alias("f"), part("w", from_end, F.lit("end")).alias("b"), part(F.lit("second"), "w", "i").alias("f2"), part(F.lit("second"), "w", from_end, F.lit("end")).alias("b2"))
    before = Window.partitionBy(*LINE).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*LINE).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*LINE)
    run = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    each = each.select("*", run("f", before).alias("pre"), run("f2", before).alias("pre2"), run("b", after).alias("done"), run("b2", after).alias("done2"))
    each = each.select("*", (F.sum("b").over(whole) - F.col("done")).alias("suf"), (F.sum("b2").over(whole) - F.col("done2")).alias("suf2"))
    least, none = F.floor((F.col("n") - 1) / 2), F.lit(0).cast("long")
    behind = F.col("head") & (F.col("i") >= least)
    out = F.xxhash64("i", F.col("n") - 1, "pre", "suf", "pre2", "suf2")
    gap = F.xxhash64("i", "n", "pre", F.col("suf") + F.col("b"), "pre2", F.col("suf2") + F.col("b2"))
    last = F.xxhash64("n", "n", F.col("pre") + F.col("f"), none, F.col("pre2") + F.col("f2"), none)
    each = each.filter(behind | F.col("tail") & (F.col("i") <= F.col("n") - least))
    keys = [
        F.when(behind | F.col("tail") & (F.col("i") < F.col("n") - least), out),
        gap,
        F.when((F.col("i") == F.col("n") - 1) & (F.col("head") | (least == 0)), last),
    ]
    return each.select(F.explode(F.array(*keys)).alias("key"), *LINE).filter(F.col("key").isNotNull())


def near_lines(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines (by hash) that an earlier line is one edit from. lines: LINE, first, halves; texts: rid and text."""
    halves = lines.filter(F.col("halves").isNotNull()).select(*LINE, "first", F.posexplode("halves").alias("at", "half"))
    met = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    some = halves.join(met.hint("shuffle_hash"), "half", "left_semi").groupBy(*LINE)
    some = written(some.agg(F.min("first").alias("first"), F.max(F.col("at") % 2 == 0).alias("head"), F.max(F.col("at") % 2 == 1).alias("tail")), "lines-met")
    wanted = some.select(F.col("first.rid").alias("rid"), F.struct(F.col("first.i").alias("i"), *LINE, "head", "tail").alias("w")).groupBy("rid").agg(F.collect_list("w").alias("w"))
    found = texts.join(wanted, "rid").select(F.split("text", "\n", -1).alias("l"), "w").select("l", F.explode("w").alias("w"))
    found = found.select(F.get("l", F.col("w.i")).alias("l"), *(F.col(f"w.{c}").alias(c) for c in (*LINE, "head", "tail")))
    words = written(found.dropDuplicates([*LINE]).withColumn("words", F.split(line_words(F.col("l")), " ")).drop("l"), "lines-words")
    keyed = written(_variants(words), "lines-variants")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = written(keyed.join(shared.hint("shuffle_hash"), "key", "left_semi").join(some.select(*LINE, "first"), [*LINE]), "lines-members")
    others = [f"other_{c}" for c in LINE]
    earliest = members.groupBy("key").agg(F.min(F.struct("first", *LINE)).alias("e")).select("key", *(F.col(f"e.{c}").alias(o) for c, o in zip(LINE, others)))
    pairs = members.join(earliest, "key").filter(reduce(or_, (F.col(c) != F.col(o) for c, o in zip(LINE, others)))).select(*LINE, *others).distinct()
    mine, other = words.select(*LINE, "words"), words.select(*(F.col(c).alias(o) for c, o in zip(LINE, others)), F.col("words").alias("others"))
    return pairs.join(mine, [*LINE]).join(other, others).filter(one_edit(F.col("words"), F.col("others"))).select(*LINE).distinct()


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with ``text`` cut to the kept lines, and n_lines (with words), n_exact and n_near (dropped), kept."""
    docs, back = set_aside(docs, key, text, OUTPUTS)
    rows = docs.withColumn("rid", row_name(F.col("key"), F.col("text")))
    each = written(_lines(rows, near_words), "lines")
    lines = each.groupBy(*LINE).agg(F.min(F.struct("key", "rid", "i")).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves"))
    lines = written(lines, "lines-distinct")
    near = near_lines(lines.select(*LINE, "first", "halves"), rows.select("rid", "text")).withColumn("near", F.lit(True))
    faulty = lines.join(near, [*LINE], "left").filter("near or n > 1").select(*LINE, "n", F.col("first.rid").alias("rid0"), F.col("first.i").alias("i0"), F.coalesce("near", F.lit(False)).alias("near"))
    gone = join_counted(each.select(*LINE, "rid", "i"), written(faulty, "lines-faulty"), [*LINE], "n", each.count()).filter("near or rid != rid0 or i != i0")
    gone = gone.select("rid", "i", (F.col("near") & (F.col("rid") == F.col("rid0")) & (F.col("i") == F.col("i0"))).alias("near"))
    gone = gone.groupBy("rid").agg(F.collect_set("i").alias("gone"), F.collect_set(F.when(F.col("near"), F.col("i"))).alias("near"))
    out = rows.join(gone, "rid", "left")
    none = F.array().cast("array<int>")
    out = out.withColumn("gone", F.coalesce("gone", none)).withColumn("near", F.coalesce("near", none)).withColumn("l", F.split("text", "\n", -1))
    kept = F.filter("l", lambda l, i: ~F.array_contains("gone", i))
    out = (
        out.withColumn("n_lines", F.coalesce(F.size(F.filter("l", lambda l: l.rlike(WORD))), F.lit(0)).cast("long"))
        .withColumn("n_exact", (F.size("gone") - F.size("near")).cast("long"))
        .withColumn("n_near", F.size("near").cast("long"))
        .withColumn("text", F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(kept, "\n")))
        .withColumn("kept", F.col("n_lines") - F.col("n_exact") - F.col("n_near"))
    )
    return back(out, *OUTPUTS)
