"""The evaluation suite's cells against the tables of single predictions, on awkward rows."""

import pytest
from pyspark.sql import functions as F

from lintel.operators import metrics as M
from lintel.operators import significance as S
from lintel.operators.suite import evaluation, reduced

SCHEMA = "id long, model string, prompt_type string, context_enabled boolean, actual string, predicted string, actual_category string, predicted_category string"


def rows():
    labels, kinds = ["Flaky", "Non-Flaky", None, "ERROR"], ["Time Dependent", "Order Dependent", "Non-Flaky", None]
    for i in range(60):
        for model in ("a", "b"):
            for context in (False, True):
                if (i + context) % 13:
                    yield (None if i % 20 == 19 else i, model, "p", context, labels[i % 2], labels[(i * 7 + context + (model == "a")) % 4], kinds[i % 3], kinds[(i * 5 + context) % 4])
    yield (3, "a", "p", False, "Non-Flaky", "Flaky", "Order Dependent", "Order Dependent")  # a case with two answers


def form(df):
    return sorted(repr({k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()}) for r in df.collect())


def test_tables_equal_those_of_single_rows(spark):
    df = spark.createDataFrame(list(rows()), SCHEMA)
    got = evaluation(df)
    want = {
        "binary": M.binary_metrics(df), "errors": M.error_rates(df), "bias": M.prediction_bias(df), "macro_f1": M.macro_f1(df), "context": M.context_delta(df), "transitions": M.transitions(df),
        "mcnemar": S.holm(M.contingency(df).withColumn("p_value", S.chi_square_p("chi_square")), order=["model", "prompt_type"]), "interval_f1": S.bootstrap_f1(df),
        "categories": M.category_accuracy(df), "categories_by_model": M.category_accuracy(df, ("model", "actual_category")), "pairs": M.wrong_pairs(df), "modal": M.modal_wrong(df), "intervals": M.true_n_interval(df),
    }
    assert set(got) == set(want)
    for name in want:
        assert form(got[name].select(*want[name].columns)) == form(want[name]), name


def test_cells_are_few(spark):
    df = spark.range(20_000).select("id", F.lit("m").alias("model"), F.lit("p").alias("prompt_type"), (F.col("id") % 2 == 0).alias("context_enabled"), F.lit("Flaky").alias("actual"), F.lit("Flaky").alias("predicted"), F.lit("x").alias("actual_category"), F.lit("y").alias("predicted_category"))
    cells, cases = reduced(df)
    assert cells.count() == 2 and cells.agg(F.sum(M.WEIGHT)).first()[0] == 20_000 and cases.first().cases == 20_000


@pytest.mark.parametrize("name", ["binary", "mcnemar", "pairs", "intervals"])
def test_empty(spark, name):
    assert evaluation(spark.createDataFrame([], SCHEMA))[name].count() == 0
