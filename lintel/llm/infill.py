"""Fill-in-middle transformation by a parallel automaton scan.

Tokens are runs of white space with the run of other characters behind them, or
white space at the end.  A deterministic automaton finds where they start; its
states are what stood before a character: nothing (0), white space (1), other (2).

1. A text is cut into chunks of ``chunk`` code points.  Each chunk, on its own,
   gives the automaton's transition function (the end state for each of the
   three start states) and the number of tokens that start in it for each.
2. Composition is associative: windows compose the functions within blocks of
   chunks and then those of whole blocks, which gives each chunk its entry state,
   the number of tokens that start before it, and the text's number of tokens.
3. Selection: the hashes of the id choose two ranks of tokens; the chunk in which
   a rank's token starts is the one whose counts enclose it.
4. The place within that chunk is found in the text's own row, from the chunk and
   the state it is entered with, and the pieces are put together there.

A text of one chunk is its own composition: its function is applied to the start
state within the row and nothing is shuffled.  Chunks of longer texts are dealt
over all tasks; of a chunk a few numbers come back, not its text.

Defined results: a null text is the empty one, of form plain; a null id hashes as
``42:``; texts that hold one of the marks are plain; repeated rows get equal
results; an empty table stays empty; all columns are kept, whatever their names,
and a column with an output's name is replaced.  A very long text is one value of
a row, as in the input, and only its chunks are handled by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.llm.words import set_aside, small
from lintel.storage import written

#: Code points of a chunk.
CHUNK = 32_768
#: Chunks whose functions are composed first: a text has at most 2^31 bytes, so a few hundred blocks.
BLOCK = 256
MARKS = ("<P>", "<S>", "<M>")
SPACE, OTHER = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: A token's first character with the one before it: white space after other characters.
START = f"{OTHER}{SPACE}"
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output", "restored")
NOTHING, BLANK, LETTER = 0, 1, 2


def chunk_function(chunk: Column) -> Column:
    """The automaton over a chunk that is not empty: ``ends`` and ``starts``, each an array over the three start states."""
    last = F.when(F.right(chunk, F.lit(1)).rlike(SPACE), F.lit(BLANK)).otherwise(F.lit(LETTER))
    inside = F.regexp_count(chunk, F.lit(START))
    first = F.left(chunk, F.lit(1)).rlike(SPACE).cast("int")
    return F.struct(F.array(last, last, last).alias("ends"), F.array(inside + 1, inside, inside + first).alias("starts"))


def identity() -> Column:
    """The function of no characters."""
    states = F.array(*(F.lit(s) for s in (NOTHING, BLANK, LETTER)))
    return F.struct(states.alias("ends"), F.array_repeat(F.lit(0).cast("long"), 3).alias("starts"))


def composed(one: Column, two: Column) -> Column:
    """First ``one``, then ``two``; associative, with ``identity`` as its unit."""
    ends = F.transform(one["ends"], lambda s: F.get(two["ends"], s))
    starts = F.transform(one["starts"], lambda n, i: n + F.get(two["starts"], F.get(one["ends"], i)))
    return F.struct(ends.alias("ends"), starts.alias("starts"))


def hashes(key: Column) -> list[Column]:
    """The four unsigned numbers that decide cuts and form."""
    digest = F.sha2(F.concat(F.lit("42:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def place_in(chunk: Column, entry: Column, rank: Column) -> Column:
    """Code points of ``chunk`` before the start of its token number ``rank`` (from 1), if it is entered in state ``entry``."""
    first = (entry == NOTHING) | ((entry == LETTER) & F.left(chunk, F.lit(1)).rlike(SPACE))
    # Whatever lies before the first start belongs to the token of an earlier chunk, as a blank and more or as letters.
    pieces = F.regexp_extract_all(chunk, F.lit(f"(?:^{OTHER}+|{SPACE}+{OTHER}*)"), F.lit(0))
    begins = F.when(chunk.rlike(f"^{SPACE}") & ~first, rank + 1).when(chunk.rlike(f"^{OTHER}") & ~first, rank + 1).otherwise(rank)
    return F.length(F.array_join(F.slice(pieces, F.lit(1), F.greatest(begins - 1, F.lit(0)).cast("int")), ""))


def _cuts(rows: DataFrame) -> DataFrame:
    """Ranks of the tokens at which prefix and middle end, from n and the hashes."""
    h = hashes(F.col("key"))
    return rows.withColumn("low", F.least(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1))).withColumn("high", F.greatest(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)))


def _before(group: list[str], order: str) -> Column:
    """All functions ``f`` of the group before this one, composed."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.aggregate(F.collect_list("f").over(earlier), identity(), composed)


def _scanned(rows: DataFrame, chunk: int) -> DataFrame:
    """For each ``rid``: n, low and high, and for the token after either cut its chunk, entry state and rank in it."""
    pieces = F.regexp_extract_all(F.col("body"), F.lit(f"(?s).{{1,{chunk}}}+"), F.lit(0))
    dealt = rows.select("rid", "key", F.posexplode(pieces).alias("at", "piece")).repartition("rid", "at")
    block = F.floor(F.col("at") / BLOCK).alias("block")
    functions = written(dealt.select("rid", "key", "at", block, chunk_function(F.col("piece")).alias("f")), "infill-functions")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "f"))), lambda x: x["f"])
    blocks = functions.groupBy("rid", "block").agg(F.aggregate(listed, identity(), composed).alias("f"))
    blocks = blocks.select("rid", "block", _before(["rid"], "block").alias("outer"))
    entered = functions.withColumn("inner", _before(["rid", "block"], "at")).join(blocks, ["rid", "block"])
    entered = entered.withColumn("met", composed(F.col("outer"), F.col("inner")))
    entered = entered.withColumn("entry", F.get("met.ends", F.lit(NOTHING))).withColumn("seen", F.get("met.starts", F.lit(NOTHING)))
    entered = entered.withColumn("new", F.get("f.starts", F.col("entry"))).withColumn("n", F.max(F.col("seen") + F.col("new")).over(Window.partitionBy("rid")))
    cut = _cuts(entered)

    def holder(rank: str) -> Column:
        """The chunk in which the token after ``rank`` others starts; none where all tokens come before the cut."""
        here = (F.col(rank) >= F.col("seen")) & (F.col(rank) < F.col("seen") + F.col("new"))
        return F.max(F.when(here, F.struct("at", "entry", (F.col(rank) - F.col("seen") + 1).alias("rank")))).alias(f"{rank}_in")

    return cut.groupBy("rid").agg(F.first("n").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"), holder("low"), holder("high"))


def _placed(rows: DataFrame, chunk: int) -> DataFrame:
    """Code points before either cut: ``low_at`` and ``high_at``."""
    for rank in ("low", "high"):
        held = F.col(f"{rank}_in")
        piece = F.substring(F.col("body"), (held["at"] * chunk + 1).cast("int"), F.lit(chunk))
        at = held["at"] * chunk + place_in(piece, held["entry"], held["rank"])
        rows = rows.withColumn(f"{rank}_at", F.when(held.isNull(), F.length("body")).otherwise(at).cast("int"))
    return rows


def _formed(rows: DataFrame) -> DataFrame:
    """Form, lengths, output, and the text rebuilt from form and output."""
    h = hashes(F.col("key"))
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains(F.col("body"), F.lit(mark))
    form = F.when((F.col("body") == "") | marked | (h[2] % 100 >= 50), "plain").when(h[3] % 100 < 80, "spm").otherwise("psm")
    piece = lambda a, b: F.substring(F.col("body"), F.lit(1) + a, b - a)
    low, high = F.col("low_at"), F.col("high_at")
    prefix, middle, suffix = piece(F.lit(0), low), piece(low, high), piece(high, F.length("body"))
    p, s, m = map(F.lit, MARKS)
    out = rows.withColumn("form", form).withColumn(
        "output",
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("body")),
    )
    rearranged = F.col("form") != "plain"
    out = out.withColumn("prefix_chars", F.when(rearranged, low).cast("long")).withColumn("middle_chars", F.when(rearranged, high - low).cast("long"))
    return out.withColumn("restored", restored(F.col("form"), F.col("output")))


def restored(form: Column, output: Column) -> Column:
    """The text from form and output: the parts between the marks, which occur once each, in the text's order."""
    parts = F.split(output, "<[PSM]>", -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def infilled(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars, output and restored."""
    docs, back = set_aside(docs, key, text, OUTPUTS)
    rows = docs.withColumn("body", F.coalesce("text", F.lit("")))
    f = chunk_function(F.col("body"))
    short = rows.filter(F.length("body") <= chunk).withColumn("n", F.when(F.col("body") == "", F.lit(0)).otherwise(F.get(f["starts"], F.lit(NOTHING))).cast("long"))
    short = _cuts(short)
    for rank in ("low", "high"):
        here = F.struct(F.lit(0).alias("at"), F.lit(NOTHING).alias("entry"), (F.col(rank) + 1).alias("rank"))
        short = short.withColumn(f"{rank}_in", F.when(F.col(rank) < F.col("n"), here))
    # Rows of long texts are written once, so that a row keeps its number when they are read again.
    long = written(rows.filter(F.length("body") > chunk).withColumn("rid", F.monotonically_increasing_id()), "infill-long")
    found = written(_scanned(long, chunk), "infill-cuts")
    names = [*rows.columns, "n", "low", "high", "low_in", "high_in"]
    long = long.join(small(found), "rid").select(names)
    return back(_formed(_placed(short.select(names).unionByName(long), chunk)), *OUTPUTS)
