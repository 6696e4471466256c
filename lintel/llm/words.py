"""Words of a text as DataFrame expressions."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a broadcast table may have; larger ones are shuffled.
BROADCAST_ROWS = 200_000
#: Keys at most whose rows are joined by a broadcast because they are many.
HOT_KEYS = 10_000


#: What may change in lower case besides A-Z; letters that Java's tables lack may be in those of ``lower``.
OTHER_CAPITALS = r"[[^\x00-\x7F]&&[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}]]"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null as empty.

    ``lower`` is much faster than ``translate`` and does the same to texts without other capitals.
    """
    text = F.coalesce(text, F.lit(""))
    plain = (F.octet_length(text) == F.length(text)) | ~text.rlike(OTHER_CAPITALS)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column, separators: str) -> Column:
    """array<string>: what lies between runs of the ``separators`` class, in lower case."""
    return F.filter(F.split(lowered(text), f"[{separators}]+", -1), lambda w: w != "")


def small(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``bound`` rows."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= bound else df


def row_id(key: Column, text: Column) -> Column:
    """A hash that tells rows apart unless key and text are equal (nulls and empty texts differ)."""
    return F.xxhash64(key, key.isNull(), text, text.isNull())


def row_name(key: Column, text: Column) -> Column:
    """Like ``row_id``, of two hashes."""
    return F.struct(row_id(key, text).alias("a"), F.xxhash64(F.lit("second"), key, key.isNull(), text, text.isNull()).alias("b"))


def set_aside(df: DataFrame, key: str, text: str, outputs: tuple[str, ...] = ()) -> tuple[DataFrame, Callable]:
    """``df`` with columns ``key``, ``text`` and otherwise only names that start with ``in_``; and what gives the names back.

    So an operator may name columns as it likes.  The second part takes the
    operator's result and further columns to put behind those of ``df``; columns
    of ``df`` that have the name of one of ``outputs`` are left out.
    """
    taken = {o.lower() for o in outputs}
    inner = [next((mine for mine, theirs in (("key", key), ("text", text)) if c == theirs), f"in_{i}") for i, c in enumerate(df.columns)]
    kept = [(mine, c) for mine, c in zip(inner, df.columns) if c.lower() not in taken]

    def back(out: DataFrame, *more: str) -> DataFrame:
        return out.select(*(F.col(mine).alias(c) for mine, c in kept), *more)

    return df.toDF(*inner), back


def join_counted(rows: DataFrame, named: DataFrame, on: str | list[str], count: str, total: int) -> DataFrame:
    """Inner join on a key that a third of the rows may share: ``count`` has each key's rows, ``total`` their sum.

    At most ``HOT_KEYS`` keys can have a share of 1/HOT_KEYS each; those are
    broadcast.  The rows of all others are shuffled, no key with more than that share.
    """
    least = total / HOT_KEYS
    hot, cold = named.filter(F.col(count) >= least).drop(count), named.filter(F.col(count) < least).drop(count)
    rest = rows.join(F.broadcast(hot.select(on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


def vocabulary_file(path: str) -> str:
    """Where a vocabulary is on this machine: a name without a folder is one of the public vocabularies, wherever a worker has them."""
    return path if "/" in path else public_tokenizers.path(path)
