"""Exact p-values, Holm's correction and bootstrap intervals, from counts that Spark has added up."""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lintel.functions.structures import once, ratio
from lintel.operators.metrics import CONFIG, confusion

RESAMPLES, SEED, ALPHA = 1000, 42, 0.05


@F.pandas_udf(DoubleType())
def chi_square_p(statistic: pd.Series) -> pd.Series:
    """P of a chi-square statistic of one degree of freedom; null stays null."""
    return statistic.map(lambda x: math.erfc(math.sqrt(max(x, 0.0) / 2)), na_action="ignore").astype("float64")


def holm(df: DataFrame, p: str = "p_value", order: list[str] | None = None, alpha: float = ALPHA) -> DataFrame:
    """``df`` with p_corrected (Holm's step-down over all rows) and the two flags.

    One row a test: the tests of a study, not of the data, are what one window holds.
    """
    ranked = Window.orderBy(p, *(order or []))
    running = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tests = F.count(p).over(Window.partitionBy())
    step = (tests - F.row_number().over(ranked) + 1) * F.col(p)
    out = df.withColumn("_step", step).withColumn("p_corrected", F.least(F.max("_step").over(running), F.lit(1.0))).drop("_step")
    return out.withColumn("significant", F.col(p) < alpha).withColumn("significant_corrected", F.col("p_corrected") < alpha)


#: Random bits that one hash gives, binary digits of a probability that are looked at, and hashes that are held at once.
WORD, DIGITS, HELD = 60, 40, 1 << 16


def ones(name: bytes, bits: int) -> int:
    """How many of the first ``bits`` fair bits of the stream ``name`` are 1.

    The generator is a counter: word i of a stream is the first 60 bits of the MD5
    of name and i, which any engine with MD5 and integers repeats.
    """
    total, last = 0, -(-bits // WORD)
    for first in range(0, last, HELD):
        some = range(first, min(first + HELD, last))
        words = np.frombuffer(b"".join([md5(b"%b|%d" % (name, i), usedforsecurity=False).digest()[:8] for i in some]), ">u8") >> np.uint64(64 - WORD)
        if some.stop == last and bits % WORD:
            words[-1] &= np.uint64((1 << bits % WORD) - 1)
        total += int(np.bitwise_count(words).sum())
    return total


def drawn(name: bytes, n: int, part: int, whole: int) -> int:
    """A draw of how many of ``n`` uniform numbers are below part / whole, in integers.

    The numbers are compared with the probability digit by digit.  Of those that are
    equal so far, a count of fair bits says how many have a 0 next; where the
    probability has a 1 these are below it, and where it has a 0 the others are not.
    So a draw takes about 2 n bits, not n numbers.
    """
    if part <= 0 or n <= 0:
        return 0
    if part >= whole:
        return n
    below, rest = 0, part
    for digit in range(1, DIGITS + 1):
        if not n:
            break
        zeros = ones(b"%b|%d" % (name, digit), n)
        rest *= 2
        if rest >= whole:
            rest, below, n = rest - whole, below + zeros, n - zeros
        else:
            n = zeros
    return below


def binomial(name: Column, n: Column, part: Column, whole: Column) -> Column:
    """``drawn`` of four columns."""

    @F.arrow_udf("long")
    def run(names: pa.Array, ns: pa.Array, parts: pa.Array, wholes: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (names, ns, parts, wholes)))
        return pa.array([drawn(s.encode(), *numbers) for s, *numbers in rows], pa.int64())

    return run(name, *(c.cast("long") for c in (n, part, whole)))


def bootstrap_f1(df: DataFrame, by=CONFIG, resamples: int = RESAMPLES, seed: int = SEED) -> DataFrame:
    """F1's 95 % bootstrap interval.

    Drawing n of n rows with replacement gives cells of the confusion matrix in a
    multinomial distribution, so only the counts leave the aggregation; each cell is
    a binomial draw of what the ones before it left.
    """
    cells = confusion(df, by).withColumn("all", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    # A draw is much work in a narrow row, so the number of partitions is given: others are joined into few by their bytes.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = cells.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1)))).repartition(parts, *by, "draw")
    name = lambda cell: F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by), F.col("draw").cast("string"), F.lit(cell))
    left, whole = F.col("all"), F.col("all")
    for cell in ("tp", "fp", "fn"):
        # Each draw is computed once, in a projection of its own.
        draws = draws.withColumn(f"_{cell}", once(binomial(name(cell), left, F.col(cell), whole)))
        left, whole = left - F.col(f"_{cell}"), whole - F.col(cell)
    f1 = ratio(2 * F.col("_tp"), 2 * F.col("_tp") + F.col("_fp") + F.col("_fn"))
    return draws.withColumn("f1", f1).groupBy(*by).agg(F.percentile("f1", F.lit(0.025)).alias("f1_low"), F.percentile("f1", F.lit(0.975)).alias("f1_high"))
