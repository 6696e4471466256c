"""Lowering and lines of words, letter by letter."""

import string

import pandas as pd
from pyspark.sql import functions as F

from lintel.llm.words import lowered


def test_lowered_changes_only_a_to_z(spark):
    """Against translate, for every letter by itself and after other letters."""
    letters = [chr(i) for i in range(1, 0x20000) if not 0xD800 <= i <= 0xDFFF]
    rows = spark.createDataFrame(pd.DataFrame({"t": [f"aZ{c}" for c in letters] + [f"{c}Zé" for c in letters]}))
    wanted = F.translate("t", string.ascii_uppercase, string.ascii_lowercase)
    assert rows.count() == 2 * len(letters)
    assert rows.filter(lowered(F.col("t")) != wanted).count() == 0
    assert rows.limit(1).select(lowered(F.lit(None).cast("string")).alias("x")).first().x == ""
