"""Binary and multi-class evaluation of predictions: all groups in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.functions.structures import ratio, wald_half_width

POSITIVE, NEGATIVE = "Flaky", "Non-Flaky"
CONFIG = ("model", "prompt_type", "context_enabled")
PROMPT_ORDER = ["zero_shot", "zero_shot_cot", "few_shot_cot"]


#: A column of tables whose rows stand for that many predictions; other tables have one row for each.
WEIGHT = "cell_n"


def _rows(df: DataFrame) -> Column:
    """How many predictions a group has."""
    return F.sum(WEIGHT) if WEIGHT in df.columns else F.count("*")


def _rows_if(df: DataFrame, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(WEIGHT))), F.lit(0)) if WEIGHT in df.columns else F.count_if(condition)


def _is(column: str, label: str) -> Column:
    return F.col(column) == label


def cells(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> list[Column]:
    """tp, fp, fn and tn; rows of other labels count nowhere."""
    pairs = {"tp": (POSITIVE, POSITIVE), "fp": (NEGATIVE, POSITIVE), "fn": (POSITIVE, NEGATIVE), "tn": (NEGATIVE, NEGATIVE)}
    return [_rows_if(df, _is(actual, a) & _is(predicted, p)).alias(name) for name, (a, p) in pairs.items()]


def confusion(df: DataFrame, by=CONFIG) -> DataFrame:
    return df.groupBy(*by).agg(_rows(df).alias("n"), *cells(df))


def precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def f1() -> Column:
    return ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def binary_metrics(df: DataFrame, by=CONFIG, digits: int = 6) -> DataFrame:
    """Cells, accuracy, precision, recall and F1 of every group; 0 where a denominator is 0."""
    r = lambda c, name: F.round(c, digits).alias(name)
    accuracy = ratio(F.col("tp") + F.col("tn"), F.col("n"))
    return confusion(df, by).select(*by, "n", "tp", "fp", "fn", "tn", r(accuracy, "accuracy"), r(precision(), "precision"), r(recall(), "recall"), r(f1(), "f1"))


def error_rates(df: DataFrame, by=CONFIG) -> DataFrame:
    fnr, fpr = F.try_divide(F.col("fn") * 100.0, F.col("fn") + F.col("tp")), F.try_divide(F.col("fp") * 100.0, F.col("fp") + F.col("tn"))
    return confusion(df, by).select(*by, "tp", "fp", "fn", "tn", F.round(fnr, 4).alias("fnr"), F.round(fpr, 4).alias("fpr"))


def prediction_bias(df: DataFrame, by=CONFIG) -> DataFrame:
    """How often the positive class is said against how often it is true."""
    counts = df.groupBy(*by).agg(_rows(df).alias("n"), _rows_if(df, _is("actual", POSITIVE)).alias("actual_positive"), _rows_if(df, _is("predicted", POSITIVE)).alias("predicted_positive"))
    return counts.withColumn("predicted_rate", F.round(F.col("predicted_positive") * 100.0 / F.col("n"), 4)).withColumn("bias", F.round(F.try_divide(F.col("predicted_positive").cast("double"), F.col("actual_positive")), 6))


def context_delta(df: DataFrame, by=("model", "prompt_type")) -> DataFrame:
    """F1, recall and precision without and with context, and the gain, in points."""
    both = binary_metrics(df, (*by, "context_enabled"), 12)
    pick = lambda m, flag: F.max(F.when(F.col("context_enabled") == flag, F.col(m)))
    out = both.groupBy(*by).agg(*(F.round(pick(m, flag) * 100, 4).alias(f"{m}_{name}") for m in ("f1", "recall", "precision") for flag, name in ((False, "baseline"), (True, "context"))), *(F.round((pick(m, True) - pick(m, False)) * 100, 4).alias(f"{m}_delta") for m in ("f1", "recall", "precision")))
    return out


def paired(df: DataFrame, keys=("id", "model", "prompt_type")) -> DataFrame:
    """Each case's predictions without and with context, side by side."""
    if WEIGHT in df.columns:
        return df.filter("paired").withColumn("context", F.col("predicted"))
    base = df.filter(~F.col("context_enabled")).select(*keys, "actual", F.col("predicted").alias("base"))
    context = df.filter("context_enabled").select(*keys, F.col("predicted").alias("context"))
    return base.join(context, list(keys))


def transitions(df: DataFrame, by=("model", "prompt_type")) -> DataFrame:
    said = lambda c: F.col(c).eqNullSafe(F.lit(POSITIVE))
    truth = F.col("actual") == POSITIVE
    pairs = paired(df)
    return pairs.groupBy(*by).agg(
        _rows_if(pairs, truth & ~said("base") & said("context")).alias("fn_to_tp"),
        _rows_if(pairs, truth & said("base") & ~said("context")).alias("tp_to_fn"),
        _rows_if(pairs, ~truth & said("base") & ~said("context")).alias("fp_to_tn"),
        _rows_if(pairs, ~truth & ~said("base") & said("context")).alias("tn_to_fp"),
    )


def contingency(df: DataFrame, by=("model", "prompt_type")) -> DataFrame:
    """Both, only without context, only with, and neither correct; McNemar's statistic with continuity correction."""
    a, b = F.col("base").eqNullSafe(F.col("actual")), F.col("context").eqNullSafe(F.col("actual"))
    pairs = paired(df)
    t = pairs.groupBy(*by).agg(_rows_if(pairs, a & b).alias("both"), _rows_if(pairs, a & ~b).alias("only_baseline"), _rows_if(pairs, ~a & b).alias("only_context"), _rows_if(pairs, ~a & ~b).alias("neither"))
    off, on = F.col("only_baseline"), F.col("only_context")
    return t.withColumn("chi_square", F.round(F.coalesce(F.try_divide(F.pow(F.abs(off - on) - 1.0, 2), off + on), F.lit(0.0)), 6))


def macro_f1(df: DataFrame, by=CONFIG, actual: str = "actual_category", predicted: str = "predicted_category") -> DataFrame:
    """Unweighted mean F1 over all labels that are true or predicted in a group; null labels count as MISSING."""
    a, p = F.coalesce(actual, F.lit("MISSING")), F.coalesce(predicted, F.lit("MISSING"))
    weight = [WEIGHT] if WEIGHT in df.columns else []
    each = df.select(*by, *weight, F.explode(F.array(F.struct(a.alias("label"), F.lit(1).alias("s"), F.lit(0).alias("p"), (a == p).cast("int").alias("t")), F.struct(p.alias("label"), F.lit(0).alias("s"), F.lit(1).alias("p"), F.lit(0).alias("t")))).alias("x")).select(*by, *weight, "x.*")
    w = F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1)
    labels = each.groupBy(*by, "label").agg(F.sum(F.col("s") * w).alias("s"), F.sum(F.col("p") * w).alias("p"), F.sum(F.col("t") * w).alias("t"))
    return labels.groupBy(*by).agg(F.count("*").alias("labels"), F.round(F.avg(ratio(2 * F.col("t"), F.col("s") + F.col("p"))), 6).alias("macro_f1"))


def category_accuracy(df: DataFrame, by=("actual_category",)) -> DataFrame:
    hit = F.col("actual_category").eqNullSafe(F.col("predicted_category"))
    t = df.groupBy(*by).agg(_rows(df).alias("n"), _rows_if(df, hit).alias("correct"))
    return t.withColumn("accuracy", F.round(F.col("correct") * 100.0 / F.col("n"), 4)).withColumn("errors", F.col("n") - F.col("correct"))


def category_accuracy_sets(df: DataFrame) -> DataFrame:
    """Pooled and per-model accuracy in one pass of grouping sets."""
    hit = F.col("actual_category").eqNullSafe(F.col("predicted_category"))
    return df.groupingSets([["actual_category"], ["actual_category", "model"]], "actual_category", "model").agg(_rows(df).alias("n"), _rows_if(df, hit).alias("correct"))


def category_confusion(df: DataFrame, labels: list[str]) -> DataFrame:
    """A row for each true label, a column for each predicted one of ``labels``; other predictions are dropped."""
    return df.filter(F.col("actual_category").isin(labels) & F.col("predicted_category").isin(labels)).groupBy("actual_category").pivot("predicted_category", labels).count().na.fill(0)


def wrong_pairs(df: DataFrame) -> DataFrame:
    """Wrong (true, predicted) pairs with their share of all wrong rows."""
    wrong = df.filter(~F.col("actual_category").eqNullSafe(F.col("predicted_category"))).groupBy("actual_category", "predicted_category").agg(_rows(df).alias("n"))
    # One row for each pair of labels.
    return wrong.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


def modal_wrong(df: DataFrame) -> DataFrame:
    """The most frequent wrong label of each true one (ties: first in order), with its rate over all rows."""
    total = df.groupBy("actual_category").agg(_rows(df).alias("total"))
    wrong = df.filter(~F.col("actual_category").eqNullSafe(F.col("predicted_category"))).groupBy("actual_category", "predicted_category").agg(_rows(df).alias("n"))
    first = F.row_number().over(Window.partitionBy("actual_category").orderBy(F.desc("n"), "predicted_category"))
    return wrong.withColumn("r", first).filter("r = 1").join(total, "actual_category").select("actual_category", F.col("predicted_category").alias("wrong"), "n", F.round(F.col("n") * 100.0 / F.col("total"), 4).alias("rate"))


def true_n_interval(df: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """Category accuracy with a 95 % interval over distinct cases rather than stacked rows; cases: (actual_category, cases), where they are counted already."""
    t = category_accuracy(df).select("actual_category", "n", "accuracy")
    cases = df.select("id", "actual_category").distinct().groupBy("actual_category").agg(F.count("*").alias("cases")) if cases is None else cases
    half = wald_half_width(F.col("accuracy") / 100, F.col("cases")) * 100
    return t.join(cases, "actual_category", "left").withColumn("lo", F.round(F.col("accuracy") - half, 4)).withColumn("hi", F.round(F.col("accuracy") + half, 4))


def integrity(df: DataFrame, by=CONFIG) -> DataFrame:
    """(check, passed) rows: equal sizes, equal id sets, no repeated ids, no nulls in key columns."""
    groups = df.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("named"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("actual", "predicted")))
    one = groups.agg((F.count_distinct("n") == 1).alias("equal_sizes"), (F.count_distinct("named", "ids") == 1).alias("equal_ids"), (F.sum(F.col("n") - F.col("ids")) == 0).alias("no_repeats"), (F.sum(F.col("null_actual") + F.col("null_predicted")) == 0).alias("no_nulls"))
    return one.unpivot([], ["equal_sizes", "equal_ids", "no_repeats", "no_nulls"], "check", "passed")
