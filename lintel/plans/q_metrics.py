"""Queries over predictions: metrics, pairing, categories, intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from lintel.functions.text import CATEGORIES
from lintel.operators import metrics as M
from lintel.operators import significance as G
from lintel.operators.suite import evaluation
from lintel.plans.adapters import view, with_views


def on_predictions(change):
    return lambda spark, sf_dir: change(view(spark, sf_dir, "predictions"))


def sql(text: str) -> str:
    return with_views(text, "predictions")


CELLS = """count(*) AS n, count(*) FILTER (actual = 'Flaky' AND predicted = 'Flaky') AS tp, count(*) FILTER (actual = 'Non-Flaky' AND predicted = 'Flaky') AS fp,
  count(*) FILTER (actual = 'Flaky' AND predicted = 'Non-Flaky') AS fn, count(*) FILTER (actual = 'Non-Flaky' AND predicted = 'Non-Flaky') AS tn"""
PAIRED = """pairs AS (SELECT a.id, a.model, a.prompt_type, a.actual, a.predicted AS base, b.predicted AS context
  FROM predictions a JOIN predictions b ON a.id = b.id AND a.model = b.model AND a.prompt_type = b.prompt_type WHERE NOT a.context_enabled AND b.context_enabled)"""
KEYS = "model, prompt_type, context_enabled"


def _labelled(df):
    return df.select(F.concat_ws(" | ", "model", "prompt_type", F.when(F.col("context_enabled"), "context").otherwise("baseline")).alias("experiment"), (F.col("actual") == F.col("predicted")).alias("correct"), F.col("actual_category").eqNullSafe(F.col("predicted_category")).alias("category_match"))


def _outcomes(df):
    return _labelled(df).groupBy("experiment").agg(F.count("*").alias("n"), F.count_if("correct").alias("correct"), F.count_if("category_match").alias("category_match"))


def _f1_pivot(df):
    m = M.binary_metrics(df).withColumn("setting", F.when(F.col("context_enabled"), "context").otherwise("baseline"))
    wide = m.groupBy("model", "prompt_type").pivot("setting", ["baseline", "context"]).agg(F.first("f1"))
    return wide.withColumn("prompt_rank", F.array_position(F.array(*map(F.lit, M.PROMPT_ORDER)), F.col("prompt_type")).cast("long"))


def _bias_long(df):
    return M.prediction_bias(df).select(*M.CONFIG, "actual_positive", "predicted_positive").unpivot(list(M.CONFIG), ["actual_positive", "predicted_positive"], "measure", "value")


def _compare(df):
    base, context = (M.category_accuracy(df.filter(F.col("context_enabled") == flag)).select("actual_category", F.col("n").alias(f"n_{name}"), F.col("accuracy").alias(name)) for flag, name in ((False, "baseline"), (True, "context")))
    return base.join(context, "actual_category", "full_outer").withColumn("samples", F.greatest("n_baseline", "n_context"))


def _volume(df):
    wrong = df.filter(~F.col("actual_category").eqNullSafe(F.col("predicted_category")))
    parts = [wrong.filter(F.col("context_enabled") == flag).select(F.lit(name).alias("setting"), "actual_category") for flag, name in ((False, "baseline"), (True, "context"))]
    return parts[0].unionByName(parts[1]).groupBy("setting", "actual_category").agg(F.count("*").alias("n"))


def _category_delta(df):
    pick = lambda flag: F.avg(F.when(F.col("context_enabled") == flag, F.col("actual_category").eqNullSafe(F.col("predicted_category")).cast("int")))
    return df.groupBy("model", "prompt_type").agg(F.round(pick(False) * 100, 4).alias("baseline"), F.round(pick(True) * 100, 4).alias("context"), F.round((pick(True) - pick(False)) * 100, 4).alias("delta"))


def _distribution(df):
    """One count for each case, though a case has a row in every experiment."""
    each = df.select("id", "actual").distinct().groupBy("actual").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    return each.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


def _confusion_long(df):
    return df.groupBy(*M.CONFIG, "actual", "predicted").agg(F.count("*").alias("n"))


def _confusion_matrix(df):
    return M.category_confusion(df, sorted(CATEGORIES))


def _rq1(df):
    base = df.filter(~F.col("context_enabled"))
    binary = M.binary_metrics(base, ("model", "prompt_type")).select("model", "prompt_type", "accuracy", "precision", "recall", "f1")
    return binary.join(M.macro_f1(base, ("model", "prompt_type")).drop("labels"), ["model", "prompt_type"])


def _summary_text(df):
    t = M.true_n_interval(df)
    return t.select("actual_category", F.format_string("%.2f [%.2f, %.2f]", "accuracy", "lo", "hi").alias("text"))


def _holm(df):
    tests = M.contingency(df).withColumn("p_value", G.chi_square_p("chi_square"))
    out = G.holm(tests, order=["model", "prompt_type"])
    return out.withColumns({c: F.round(c, 9) for c in ("p_value", "p_corrected")})


def _drawn(cell: str, before: str, left: str, whole: str) -> str:
    """CTE ``d_cell``: the draws of a cell, digit by digit, from those of ``before``."""
    zeros = f"""coalesce(list_sum(list_transform(range(0, (open + {G.WORD - 1}) // {G.WORD}), lambda i: bit_count(CAST('0x' || substr(md5(name || '|' || digit || '|' || i), 1, {G.WORD // 4}) AS BIGINT) & ((1::BIGINT << CAST(least(open - i * {G.WORD}, {G.WORD}) AS INT)) - 1)))), 0)"""
    return f"""w_{cell} AS (SELECT *, {left} AS left_, {whole} AS whole, {G.SEED} || '|' || model || '|' || prompt_type || '|' || context_enabled || '|' || draw || '|{cell}' AS name FROM {before}),
  r_{cell} AS (SELECT name, 1 AS digit, left_ AS open, CAST(0 AS BIGINT) AS below, {cell} AS rest, whole FROM w_{cell} WHERE {cell} > 0 AND left_ > 0 AND {cell} < whole
    UNION ALL SELECT name, digit + 1, CASE WHEN 2 * rest >= whole THEN open - zeros ELSE zeros END, CASE WHEN 2 * rest >= whole THEN below + zeros ELSE below END, CASE WHEN 2 * rest >= whole THEN 2 * rest - whole ELSE 2 * rest END, whole
      FROM (SELECT *, CAST({zeros} AS BIGINT) AS zeros FROM r_{cell}) AS z WHERE digit <= {G.DIGITS}),
  d_{cell} AS (SELECT w.* EXCLUDE (left_, whole, name), CASE WHEN {cell} <= 0 OR left_ <= 0 THEN 0 WHEN {cell} >= w.whole THEN left_ ELSE r.below END AS x_{cell} FROM w_{cell} w LEFT JOIN r_{cell} r ON r.name = w.name AND r.digit = {G.DIGITS + 1})"""


BOOTSTRAP = f"""c AS (SELECT {KEYS}, {CELLS} FROM predictions GROUP BY ALL), s AS (SELECT *, tp + fp + fn + tn AS total, unnest(range(0, {G.RESAMPLES})) AS draw FROM c),
  {_drawn("tp", "s", "total", "total")}, {_drawn("fp", "d_tp", "total - x_tp", "total - tp")}, {_drawn("fn", "d_fp", "total - x_tp - x_fp", "total - tp - fp")},
  f AS (SELECT {KEYS}, CASE WHEN 2 * x_tp + x_fp + x_fn > 0 THEN 2.0::DOUBLE * x_tp / (2 * x_tp + x_fp + x_fn) ELSE 0 END AS f1 FROM d_fn)
SELECT {KEYS}, round(quantile_cont(f1, 0.025), 9) AS f1_low, round(quantile_cont(f1, 0.975), 9) AS f1_high FROM f GROUP BY ALL"""

#: Tables of the suite: the query whose SQL gives the same rows, key columns and measures.
PARTS = {
    "binary": ("binary_metrics_by_config", M.CONFIG, ("n", "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1")),
    "errors": ("confusion_rates", M.CONFIG, ("fnr", "fpr")),
    "bias": ("prediction_bias", M.CONFIG, ("actual_positive", "predicted_positive", "predicted_rate", "bias")),
    "macro_f1": ("macro_f1_by_config", M.CONFIG, ("labels", "macro_f1")),
    "context": ("context_delta", ("model", "prompt_type"), ("f1_baseline", "f1_context", "f1_delta", "recall_delta", "precision_delta")),
    "transitions": ("prediction_transitions", ("model", "prompt_type"), ("fn_to_tp", "tp_to_fn", "fp_to_tn", "tn_to_fp")),
    "mcnemar": ("mcnemar_statistic", ("model", "prompt_type"), ("both", "only_baseline", "only_context", "neither", "chi_square")),
    "categories": ("category_accuracy", ("actual_category",), ("n", "correct", "accuracy", "errors")),
    "categories_by_model": ("category_accuracy_by_model", ("model", "actual_category"), ("n", "correct", "accuracy", "errors")),
    "pairs": ("misclassification_pairs", ("actual_category", "predicted_category"), ("n", "share")),
    "modal": ("modal_misclassification", ("actual_category", "wrong"), ("n", "rate")),
    "intervals": ("true_n_ci", ("actual_category",), ("n", "accuracy", "cases", "lo", "hi")),
}


def _suite(df):
    """All tables of the suite in one long one."""
    tables, out = evaluation(df), None
    for name, (_, keys, measures) in PARTS.items():
        pairs = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures))
        part = tables[name].select(F.lit(name).alias("part"), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("key"), F.explode(pairs).alias("x")).select("part", "key", "x.*")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {
    "evaluation_suite": on_predictions(_suite),
    "binary_metrics_by_config": on_predictions(M.binary_metrics),
    "binary_metrics_by_prompt": on_predictions(lambda df: M.binary_metrics(df, ("prompt_type",))),
    "confusion_rates": on_predictions(M.error_rates),
    "confusion_by_experiment": on_predictions(_confusion_long),
    "prediction_bias": on_predictions(M.prediction_bias),
    "bias_long": on_predictions(_bias_long),
    "context_delta": on_predictions(M.context_delta),
    "category_delta": on_predictions(_category_delta),
    "prediction_transitions": on_predictions(M.transitions),
    "mcnemar_statistic": on_predictions(M.contingency),
    "mcnemar_holm": on_predictions(_holm),
    "bootstrap_f1": on_predictions(lambda df: G.bootstrap_f1(df).select(*M.CONFIG, F.round("f1_low", 9).alias("f1_low"), F.round("f1_high", 9).alias("f1_high"))),
    "macro_f1_by_config": on_predictions(M.macro_f1),
    "rq1_summary": on_predictions(_rq1),
    "f1_pivot": on_predictions(_f1_pivot),
    "category_accuracy": on_predictions(M.category_accuracy),
    "category_accuracy_by_model": on_predictions(lambda df: M.category_accuracy(df, ("model", "actual_category"))),
    "category_accuracy_sets": on_predictions(M.category_accuracy_sets),
    "category_confusion": on_predictions(_confusion_matrix),
    "modal_misclassification": on_predictions(M.modal_wrong),
    "misclassification_pairs": on_predictions(M.wrong_pairs),
    "misclassification_volume": on_predictions(_volume),
    "category_compare": on_predictions(_compare),
    "true_n_ci": on_predictions(M.true_n_interval),
    "true_n_ci_text": on_predictions(_summary_text),
    "integrity_suite": on_predictions(M.integrity),
    "class_distribution_cases": on_predictions(_distribution),
    "experiment_outcomes": on_predictions(_outcomes),
}
CAT = "count(*) AS n, count(*) FILTER (actual_category = predicted_category) AS correct"
#: The chance of a larger chi_square of one degree of freedom, by the series of the error function; beyond 50 it is under 1e-11.
CHI_SQUARE_P = """CASE WHEN chi_square > 50 THEN 0.0 ELSE 1 - list_sum(list_transform(range(0, 200), lambda n: exp(n * 2 * ln(2) + (2 * n + 1) * ln(greatest(sqrt(chi_square / 2), 1e-300)) + lgamma(n + 1) - lgamma(2 * n + 2))))
  * exp(-chi_square / 2) * 2 / sqrt(pi()) END"""
SQL = {
    "bootstrap_f1": sql(f"WITH {BOOTSTRAP}").replace("WITH ", "WITH RECURSIVE ", 1),
    "binary_metrics_by_config": sql(f"""SELECT *, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
  FROM (SELECT {KEYS}, {CELLS} FROM predictions GROUP BY {KEYS})"""),
    "binary_metrics_by_prompt": sql(f"""SELECT *, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
  FROM (SELECT prompt_type, {CELLS} FROM predictions GROUP BY prompt_type)"""),
    "confusion_rates": sql(f"SELECT {KEYS}, tp, fp, fn, tn, round(fn * 100.0 / nullif(fn + tp, 0), 4) AS fnr, round(fp * 100.0 / nullif(fp + tn, 0), 4) AS fpr FROM (SELECT {KEYS}, {CELLS} FROM predictions GROUP BY {KEYS})"),
    "confusion_by_experiment": sql(f"SELECT {KEYS}, actual, predicted, count(*) AS n FROM predictions GROUP BY ALL"),
    "prediction_bias": sql(f"""SELECT *, round(predicted_positive * 100.0 / n, 4) AS predicted_rate, round(predicted_positive / nullif(actual_positive, 0), 6) AS bias FROM (
  SELECT {KEYS}, count(*) AS n, count(*) FILTER (actual = 'Flaky') AS actual_positive, count(*) FILTER (predicted = 'Flaky') AS predicted_positive FROM predictions GROUP BY {KEYS})"""),
    "bias_long": sql(f"""SELECT {KEYS}, 'actual_positive' AS measure, count(*) FILTER (actual = 'Flaky') AS value FROM predictions GROUP BY {KEYS}
  UNION ALL SELECT {KEYS}, 'predicted_positive', count(*) FILTER (predicted = 'Flaky') FROM predictions GROUP BY {KEYS}"""),
    "context_delta": sql(f"""WITH m AS (SELECT model, prompt_type, context_enabled, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) * 100 AS f1, coalesce(tp / nullif(tp + fn, 0), 0) * 100 AS recall, coalesce(tp / nullif(tp + fp, 0), 0) * 100 AS precision
  FROM (SELECT {KEYS}, {CELLS} FROM predictions GROUP BY {KEYS}))
SELECT a.model, a.prompt_type, """ + ", ".join(f"round(a.{m}, 4) AS {m}_baseline, round(b.{m}, 4) AS {m}_context, round(b.{m} - a.{m}, 4) AS {m}_delta" for m in ("f1", "recall", "precision")) + " FROM m a JOIN m b USING (model, prompt_type) WHERE NOT a.context_enabled AND b.context_enabled"),
    "category_delta": sql("""SELECT model, prompt_type, round(b * 100, 4) AS baseline, round(c * 100, 4) AS context, round((c - b) * 100, 4) AS delta FROM (
  SELECT model, prompt_type, avg(CAST(actual_category = predicted_category AS INT)) FILTER (NOT context_enabled) AS b, avg(CAST(actual_category = predicted_category AS INT)) FILTER (context_enabled) AS c FROM predictions GROUP BY ALL)"""),
    "prediction_transitions": sql(f"""WITH {PAIRED} SELECT model, prompt_type, count(*) FILTER (actual = 'Flaky' AND base <> 'Flaky' AND context = 'Flaky') AS fn_to_tp,
  count(*) FILTER (actual = 'Flaky' AND base = 'Flaky' AND context <> 'Flaky') AS tp_to_fn, count(*) FILTER (actual <> 'Flaky' AND base = 'Flaky' AND context <> 'Flaky') AS fp_to_tn,
  count(*) FILTER (actual <> 'Flaky' AND base <> 'Flaky' AND context = 'Flaky') AS tn_to_fp FROM pairs GROUP BY ALL"""),
    "mcnemar_statistic": sql(f"""WITH {PAIRED}, t AS (SELECT model, prompt_type, count(*) FILTER (base = actual AND context = actual) AS "both", count(*) FILTER (base = actual AND context <> actual) AS only_baseline,
  count(*) FILTER (base <> actual AND context = actual) AS only_context, count(*) FILTER (base <> actual AND context <> actual) AS neither FROM pairs GROUP BY ALL)
SELECT *, round(coalesce(pow(abs(only_baseline - only_context) - 1.0, 2) / nullif(only_baseline + only_context, 0), 0), 6) AS chi_square FROM t"""),
    "mcnemar_holm": sql(f"""WITH {PAIRED}, t AS (SELECT model, prompt_type, count(*) FILTER (base = actual AND context = actual) AS "both", count(*) FILTER (base = actual AND context <> actual) AS only_baseline,
  count(*) FILTER (base <> actual AND context = actual) AS only_context, count(*) FILTER (base <> actual AND context <> actual) AS neither FROM pairs GROUP BY ALL), c AS (SELECT *, round(coalesce(pow(abs(only_baseline - only_context) - 1.0, 2) / nullif(only_baseline + only_context, 0), 0), 6) AS chi_square FROM t),
  p AS (SELECT *, {CHI_SQUARE_P} AS p_value FROM c), i AS (SELECT *, row_number() OVER (ORDER BY p_value, model, prompt_type) AS i, count(*) OVER () AS m FROM p), h AS (SELECT *, least(max((m - i + 1) * p_value) OVER (ORDER BY i), 1) AS p_corrected FROM i)
SELECT * EXCLUDE (i, m, p_value, p_corrected), round(p_value, 9) AS p_value, round(p_corrected, 9) AS p_corrected, p_value < 0.05 AS significant, p_corrected < 0.05 AS significant_corrected FROM h"""),
    "macro_f1_by_config": sql(f"""WITH e AS (SELECT {KEYS}, actual_category AS label, 1 AS s, 0 AS p, CAST(actual_category = predicted_category AS INT) AS t FROM predictions
  UNION ALL SELECT {KEYS}, predicted_category, 0, 1, 0 FROM predictions), l AS (SELECT {KEYS}, label, sum(s) AS s, sum(p) AS p, sum(t) AS t FROM e GROUP BY ALL)
SELECT {KEYS}, count(*) AS labels, round(avg(2 * t / (s + p)), 6) AS macro_f1 FROM l GROUP BY {KEYS}"""),
    "rq1_summary": sql(f"""WITH b AS (SELECT * FROM predictions WHERE NOT context_enabled),
  e AS (SELECT model, prompt_type, actual_category AS label, 1 AS s, 0 AS p, CAST(actual_category = predicted_category AS INT) AS t FROM b
  UNION ALL SELECT model, prompt_type, predicted_category, 0, 1, 0 FROM b), l AS (SELECT model, prompt_type, label, sum(s) AS s, sum(p) AS p, sum(t) AS t FROM e GROUP BY ALL),
  mf AS (SELECT model, prompt_type, round(avg(2 * t / (s + p)), 6) AS macro_f1 FROM l GROUP BY ALL), c AS (SELECT model, prompt_type, {CELLS} FROM b GROUP BY ALL)
SELECT model, prompt_type, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, macro_f1 FROM c JOIN mf USING (model, prompt_type)"""),
    "f1_pivot": sql(f"""SELECT model, prompt_type, max(f1) FILTER (NOT context_enabled) AS baseline, max(f1) FILTER (context_enabled) AS context,
  CAST(list_position(['zero_shot', 'zero_shot_cot', 'few_shot_cot'], prompt_type) AS BIGINT) AS prompt_rank FROM (
  SELECT {KEYS}, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM (SELECT {KEYS}, {CELLS} FROM predictions GROUP BY {KEYS})) GROUP BY model, prompt_type"""),
    "category_accuracy": sql(f"SELECT *, round(correct * 100.0 / n, 4) AS accuracy, n - correct AS errors FROM (SELECT actual_category, {CAT} FROM predictions GROUP BY ALL)"),
    "category_accuracy_by_model": sql(f"SELECT *, round(correct * 100.0 / n, 4) AS accuracy, n - correct AS errors FROM (SELECT model, actual_category, {CAT} FROM predictions GROUP BY ALL)"),
    "category_accuracy_sets": sql(f"SELECT actual_category, model, {CAT} FROM predictions GROUP BY GROUPING SETS ((actual_category), (actual_category, model))"),
    "category_confusion": sql("SELECT actual_category, " + ", ".join(f"count(*) FILTER (predicted_category = '{c}') AS \"{c}\"" for c in sorted(CATEGORIES)) + " FROM predictions GROUP BY actual_category"),
    "modal_misclassification": sql("""WITH w AS (SELECT actual_category, predicted_category, count(*) AS n FROM predictions WHERE actual_category <> predicted_category GROUP BY ALL),
  t AS (SELECT actual_category, count(*) AS total FROM predictions GROUP BY ALL)
SELECT actual_category, predicted_category AS wrong, n, round(n * 100.0 / total, 4) AS rate FROM w JOIN t USING (actual_category) QUALIFY row_number() OVER (PARTITION BY actual_category ORDER BY n DESC, predicted_category) = 1"""),
    "misclassification_pairs": sql("SELECT *, round(n * 100.0 / sum(n) OVER (), 4) AS share FROM (SELECT actual_category, predicted_category, count(*) AS n FROM predictions WHERE actual_category <> predicted_category GROUP BY ALL)"),
    "misclassification_volume": sql("SELECT CASE WHEN context_enabled THEN 'context' ELSE 'baseline' END AS setting, actual_category, count(*) AS n FROM predictions WHERE actual_category <> predicted_category GROUP BY ALL"),
    "category_compare": sql("""SELECT actual_category, n_baseline, round(b * 100.0 / n_baseline, 4) AS baseline, n_context, round(c * 100.0 / n_context, 4) AS context, greatest(n_baseline, n_context) AS samples FROM (
  SELECT actual_category, count(*) FILTER (NOT context_enabled) AS n_baseline, count(*) FILTER (NOT context_enabled AND actual_category = predicted_category) AS b,
  count(*) FILTER (context_enabled) AS n_context, count(*) FILTER (context_enabled AND actual_category = predicted_category) AS c FROM predictions GROUP BY ALL)"""),
    "true_n_ci": sql("""WITH a AS (SELECT actual_category, count(*) AS n, round(count(*) FILTER (actual_category = predicted_category) * 100.0 / count(*), 4) AS accuracy, count(DISTINCT id) AS cases FROM predictions GROUP BY ALL)
SELECT *, round(accuracy - 100 * 1.96 * sqrt(accuracy / 100 * (1 - accuracy / 100) / cases), 4) AS lo, round(accuracy + 100 * 1.96 * sqrt(accuracy / 100 * (1 - accuracy / 100) / cases), 4) AS hi FROM a"""),
    "true_n_ci_text": sql("""WITH a AS (SELECT actual_category, round(count(*) FILTER (actual_category = predicted_category) * 100.0 / count(*), 4) AS accuracy, count(DISTINCT id) AS cases FROM predictions GROUP BY ALL)
SELECT actual_category, printf('%.2f [%.2f, %.2f]', accuracy, round(accuracy - 100 * 1.96 * sqrt(accuracy / 100 * (1 - accuracy / 100) / cases), 4), round(accuracy + 100 * 1.96 * sqrt(accuracy / 100 * (1 - accuracy / 100) / cases), 4)) AS text FROM a"""),
    "integrity_suite": sql(f"""WITH g AS (SELECT {KEYS}, count(*) AS n, count(DISTINCT id) AS ids, list_sort(list(DISTINCT id)) AS named, count(*) FILTER (actual IS NULL OR predicted IS NULL) AS nulls FROM predictions GROUP BY {KEYS}),
  o AS (SELECT count(DISTINCT n) = 1 AS a, count(DISTINCT named) = 1 AS b, sum(n - ids) = 0 AS c, sum(nulls) = 0 AS d FROM g)
SELECT 'equal_sizes' AS "check", a AS passed FROM o UNION ALL SELECT 'equal_ids', b FROM o UNION ALL SELECT 'no_repeats', c FROM o UNION ALL SELECT 'no_nulls', d FROM o"""),
    "class_distribution_cases": sql("SELECT actual, n, round(n * 100.0 / sum(n) OVER (), 4) AS percent FROM (SELECT actual, count(DISTINCT id) AS n FROM predictions GROUP BY actual)"),
    "experiment_outcomes": sql("SELECT concat_ws(' | ', model, prompt_type, CASE WHEN context_enabled THEN 'context' ELSE 'baseline' END) AS experiment, count(*) AS n, count(*) FILTER (actual = predicted) AS correct, count(*) FILTER (actual_category = predicted_category) AS category_match FROM predictions GROUP BY 1"),
}
SQL["evaluation_suite"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS part, concat_ws('|', {", ".join(f"CAST({k} AS VARCHAR)" for k in keys)}) AS key, '{m}' AS measure, CAST("{m}" AS DOUBLE) AS value FROM ({SQL[query]}) AS {name}_{m}"""
    for name, (query, keys, measures) in PARTS.items()
    for m in measures
)
