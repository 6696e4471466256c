"""Chat formatting with a grammar round trip, in DataFrame expressions only.

Grammar: a conversation is a sequence of turns; a turn is ``### role:``, a line
break, the text, a line break, ``</turn>`` and a line break.  Roles are
percent-encoded.  A control string inside a text (a ``### name:`` or a
``</turn>``) would read as grammar, so each turn is rendered, parsed again and
compared with its source; a turn that comes back different is rendered with a
backslash before each of its control strings (and before the backslashes that
already precede one), which the parser takes off again.  ``render`` stops with
an error if a turn is still different after the last level.

Defined results: null texts and roles count as empty; turns are ordered by
turn, then role, then text, so ties and repeated rows are kept in a fixed order;
rows whose conversation id is null form one conversation; an empty table gives
an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The grammar's control strings.
CONTROL = r"(?:### [A-Za-z0-9.*_%+\-]*:|</turn>)"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """One more backslash before every control string."""
    return F.regexp_replace(text, rf"(?<!\\)\\*+(?={CONTROL})", r"$0\\")


def unescape(text: Column) -> Column:
    """One backslash less before every control string that has any."""
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+)(?={CONTROL})", "$1")


#: How a text may be written, mildest first.
LEVELS = (lambda text: text, escape)


def turn_text(role: Column, written: Column) -> Column:
    """A turn of the template around an already escaped text."""
    return F.concat(F.lit("### "), F.url_encode(role), F.lit(":\n"), written, F.lit("\n</turn>\n"))


def parse(formatted: Column) -> Column:
    """array<struct<role,text>> read back from formatted text by the grammar alone."""
    turns = F.filter(F.split(formatted, r"(?<!\\)</turn>\n", -1), lambda t: t != "")
    return F.transform(
        turns,
        lambda t: F.struct(
            F.url_decode(F.regexp_extract(t, r"^### ([^:\n]*):\n", 1)).alias("role"),
            unescape(F.regexp_extract(t, r"(?s)^### [^:\n]*:\n(.*)\n$", 1)).alias("text"),
        ),
    )


def _returns(formatted: Column, role: Column, text: Column) -> Column:
    """Whether one formatted turn parses to its source, with no control string left over."""
    back = parse(formatted)
    same = (F.size(back) == 1) & (F.get(back, F.lit(0))["role"] == role) & (F.get(back, F.lit(0))["text"] == text)
    return same & (F.regexp_count(formatted, F.lit(rf"(?<!\\){CONTROL}")) == 2)


def render(role: Column, text: Column) -> Column:
    """A turn at the mildest level that parses back to exactly ``role`` and ``text``."""
    tries = [turn_text(role, level(text)) for level in LEVELS]
    chosen = F.raise_error(F.lit("a turn does not survive the round trip")).cast("string")
    for formatted in reversed(tries):
        chosen = F.when(_returns(formatted, role, text), formatted).otherwise(chosen)
    return chosen


def format_chats(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its key and ``formatted``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    plain = rows.select(F.col(key).alias("_key"), F.col(turn).alias("_turn"), role.alias("_role"), text.alias("_text"))
    turns = plain.withColumn("_out", render(F.col("_role"), F.col("_text")))
    ordered = F.sort_array(F.collect_list(F.struct("_turn", "_role", "_text", "_out")))
    chats = turns.groupBy("_key").agg(ordered.alias("_turns"))
    return chats.select(F.col("_key").alias(key), F.array_join(F.transform("_turns", lambda t: t["_out"]), "").alias("formatted"))


def read_back(chats: DataFrame, formatted: str = "formatted") -> DataFrame:
    """``chats`` with ``turns`` (parsed) and ``loss`` (the assistant's texts, unescaped, in order)."""
    out = chats.withColumn("turns", parse(F.col(formatted)))
    mine = F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: t["text"])
    return out.withColumn("loss", mine)


def loss_spans(formatted: Column) -> Column:
    """array<struct<start,length>>: code-point spans of the assistant's (escaped) texts in the formatted text."""
    turns = F.filter(F.split(formatted, r"(?<!\\)</turn>\n", -1), lambda t: t != "")
    marker = len("</turn>\n")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state, t):
        head = F.length(F.regexp_extract(t, r"^### [^:\n]*:\n", 0))
        span = F.struct((state["at"] + head).alias("start"), (F.length(t) - head - 1).alias("length"))
        is_mine = F.regexp_extract(t, r"^### ([^:\n]*):\n", 1) == ASSISTANT
        spans = F.when(is_mine, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(t) + marker).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])
