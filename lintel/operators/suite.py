"""The whole evaluation of a study from one reading of its predictions.

Predictions are reduced to cells: one row for every combination of experiment,
truth, answer and the paired answer without context that occurs, with how often it
does.  Cells add up, so every table of the suite is a small aggregation of them, and
their number follows labels and experiments, not cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.operators import metrics as M
from lintel.operators import significance as S
from lintel.storage import written

CELL = (*M.CONFIG, "actual", "predicted", "actual_category", "predicted_category")


def reduced(predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells with ``base``, ``paired`` and how many predictions each stands for, cases by category).

    A prediction with context is paired with the case's one without, and with each if
    there are several; the others stand in cells that aren't paired.  A row counts once
    among those cells, however many partners it has.
    """
    rows = written(predictions.select("id", *CELL), "suite-rows")
    once = rows.groupBy(*CELL).agg(F.count("*").alias(M.WEIGHT)).select(*CELL, F.lit(None).cast("string").alias("base"), F.lit(False).alias("paired"), M.WEIGHT)
    pairs = M.paired(rows).groupBy("model", "prompt_type", "actual", "base", "context").agg(F.count("*").alias(M.WEIGHT))
    none = F.lit(None).cast("string")
    pairs = pairs.select("model", "prompt_type", F.lit(True).alias("context_enabled"), "actual", F.col("context").alias("predicted"), none.alias("actual_category"), none.alias("predicted_category"), "base", F.lit(True).alias("paired"), M.WEIGHT)
    cases = rows.select("id", "actual_category").distinct().groupBy("actual_category").agg(F.count("*").alias("cases"))
    return written(once.unionByName(pairs), "suite-cells"), written(cases, "suite-cases")


def evaluation(predictions: DataFrame) -> dict[str, DataFrame]:
    """The suite's tables by name: binary, errors, bias, macro_f1, context, transitions, mcnemar, interval_f1, categories, categories_by_model, pairs, modal, intervals."""
    cells, cases = reduced(predictions)
    each = cells.filter("not paired")
    tests = M.contingency(cells).withColumn("p_value", S.chi_square_p("chi_square"))
    return {
        "binary": M.binary_metrics(each),
        "errors": M.error_rates(each),
        "bias": M.prediction_bias(each),
        "macro_f1": M.macro_f1(each),
        "context": M.context_delta(each),
        "transitions": M.transitions(cells),
        "mcnemar": S.holm(tests, order=["model", "prompt_type"]),
        "interval_f1": S.bootstrap_f1(each),
        "categories": M.category_accuracy(each),
        "categories_by_model": M.category_accuracy(each, ("model", "actual_category")),
        "pairs": M.wrong_pairs(each),
        "modal": M.modal_wrong(each),
        "intervals": M.true_n_interval(each, cases),
    }
