"""Prediction accuracy and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.profile import CALENDAR, months_sql
from fundloom.catalog.registry import d, over, query, r
from fundloom.operators import accuracy, ordering
from fundloom.plans import views
from fundloom.session import materialize, staging_path
from fundloom.sources import sinks

P, T = "predicted_alpha", "actual_alpha"
COMPLETE = {"complete": "SELECT * FROM scored WHERE predicted_alpha IS NOT NULL AND actual_alpha IS NOT NULL"}
CORR = (
    f"covar_pop({P}, {T}) / nullif(stddev_pop(CASE WHEN {T} IS NOT NULL THEN {P} END) "
    f"* stddev_pop(CASE WHEN {P} IS NOT NULL THEN {T} END), 0)"
)
MODELS = ["xgb_prediction", "rf_prediction"]


def _scored(spark, sf):
    return views.predictions_vs_actual(spark, sf)


@query(
    "accuracy_overall",
    over(["scored"], f"""SELECT count(*) AS n, {r(f'avg({T})', 'mean_actual', 8)}, {r(f'avg({P})', 'mean_predicted', 8)},
      {r(f'stddev_samp({T})', 'std_actual', 8)}, {r(f'stddev_samp({P})', 'std_predicted', 8)},
      {r(f'avg({P} - {T})', 'mean_error', 8)}, {r(f'avg(abs({P} - {T}))', 'mae', 8)},
      {r(f'sqrt(avg(({P} - {T}) * ({P} - {T})))', 'rmse', 8)}, {r(CORR, 'correlation', 8)} FROM complete""", COMPLETE),
    digits=8,
)
def accuracy_overall(spark, sf):
    return accuracy.accuracy_overall(_scored(spark, sf))


@query(
    "accuracy_regression",
    over(["scored"], f"""SELECT {r(f'regr_slope({T}, {P})', 'slope', 8)}, {r(f'regr_intercept({T}, {P})', 'intercept', 8)},
      {r(f'regr_r2({T}, {P})', 'r2', 8)} FROM complete""", COMPLETE),
    digits=8,
)
def accuracy_regression(spark, sf):
    return accuracy.accuracy_regression(_scored(spark, sf))


@query(
    "directional_accuracy",
    over(["scored"], f"""SELECT {r(f'avg((({P} > 0) = ({T} > 0))::INT)', 'directional_accuracy', 8)} FROM complete""",
         COMPLETE),
    digits=8,
)
def directional_accuracy(spark, sf):
    return accuracy.directional_accuracy(_scored(spark, sf))


@query(
    "accuracy_by_month",
    over(["scored"], f"""SELECT {d('month_end')}, {r(f'avg({P})', 'mean_predicted', 6)}, {r(f'avg({T})', 'mean_actual', 6)},
      {r(f'avg(abs({P} - {T}))', 'mae', 6)}, count(*) AS n_funds, {r(CORR, 'correlation', 6)}
      FROM scored GROUP BY scored.month_end"""),
    digits=6,
)
def accuracy_by_month(spark, sf):
    return accuracy.accuracy_by_month(_scored(spark, sf))


@query(
    "accuracy_by_month_summary",
    over(["scored"], f"""SELECT {r('avg(c)', 'mean_correlation', 8)}, {r('min(c)', 'min_correlation', 8)},
      {r('max(c)', 'max_correlation', 8)} FROM (SELECT {CORR} AS c FROM scored GROUP BY month_end)"""),
    digits=8,
)
def accuracy_by_month_summary(spark, sf):
    return accuracy.accuracy_by_month_summary(_scored(spark, sf))


@query(
    "accuracy_by_fund",
    over(["scored"], f"""SELECT class_id, {r(f'avg({P})', 'pred_mean', 6)}, {r(f'stddev_samp({P})', 'pred_std', 6)},
      {r(f'avg({T})', 'actual_mean', 6)}, {r(f'stddev_samp({T})', 'actual_std', 6)},
      {r(f'avg(abs({P} - {T}))', 'mean_abs_error', 6)}, count(*) AS n_months, {r(CORR, 'correlation', 6)}
      FROM scored GROUP BY 1"""),
    digits=6,
)
def accuracy_by_fund(spark, sf):
    return accuracy.accuracy_by_fund(_scored(spark, sf))


@query(
    "accuracy_by_fund_summary",
    over(["scored"], f"""SELECT {r('avg(c)', 'mean_correlation', 8)}, {r('stddev_samp(c)', 'std_correlation', 8)},
      {r('quantile_cont(c, 0.5)', 'median_correlation', 8)}
      FROM (SELECT {CORR} AS c FROM scored GROUP BY class_id)"""),
    digits=8,
)
def accuracy_by_fund_summary(spark, sf):
    return accuracy.accuracy_by_fund_summary(_scored(spark, sf))


E_ = "ensemble_prediction"


@query(
    "describe_by_fund",
    over(["predictions"], f"""SELECT class_id, count({E_}) AS n, {r(f'avg({E_})', 'mean', 6)}, {r(f'stddev_samp({E_})', 'std', 6)},
      {r(f'min({E_})', 'min', 6)}, {r(f'max({E_})', 'max', 6)} FROM predictions GROUP BY 1"""),
    digits=6,
)
def describe_by_fund(spark, sf):
    return accuracy.describe_by(views.predictions(spark, sf), "class_id", E_, extremes=True, digits=6)


@query(
    "describe_by_month",
    over(["predictions"], f"""SELECT {d('month_end')}, count({E_}) AS n, {r(f'avg({E_})', 'mean', 6)},
      {r(f'stddev_samp({E_})', 'std', 6)} FROM predictions GROUP BY predictions.month_end"""),
    digits=6,
)
def describe_by_month(spark, sf):
    return accuracy.describe_by(views.predictions(spark, sf), "month_end", E_, extremes=False, digits=6)


@query(
    "distribution_moments",
    over(["predictions"], f"""SELECT {r(f'avg({E_})', 'mean', 8)}, {r(f'stddev_samp({E_})', 'std', 8)},
      {r(f'skewness({E_})', 'skewness', 6)}, {r(f'kurtosis({E_})', 'kurtosis', 6)}, """
      + ", ".join(r(f"quantile_cont({E_}, {q})", n, 8) for n, q in (
          ("q05", 0.05), ("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("q95", 0.95))) + " FROM predictions"),
    digits={"*": 8, "skewness": 6, "kurtosis": 6},
)
def distribution_moments(spark, sf):
    return accuracy.distribution_moments(materialize(views.predictions(spark, sf).select(E_)), E_)


_SUMMARY = f"""count(*) AS total_predictions, count(DISTINCT class_id) AS unique_funds, {d('min(month_end)', 'start')},
  {d('max(month_end)', 'end')}, {r(f'avg({E_})', 'mean', 8)}, {r(f'stddev_samp({E_})', 'std', 8)},
  {r(f'min({E_})', 'min', 8)}, {r(f'max({E_})', 'max', 8)}, {r(f'quantile_cont({E_}, 0.25)', 'q25', 8)},
  {r(f'quantile_cont({E_}, 0.5)', 'median', 8)}, {r(f'quantile_cont({E_}, 0.75)', 'q75', 8)}"""


def _model_corr(m: str) -> str:
    both = f"FILTER ({m} IS NOT NULL AND {E_} IS NOT NULL)"
    return f"covar_pop({m}, {E_}) / (stddev_pop({m}) {both} * stddev_pop({E_}) {both})"


_REPORT = f"{_SUMMARY}, " + ", ".join(
    f"{r(f'avg({m})', f'{m[:-11]}_mean', 8)}, {r(f'stddev_samp({m})', f'{m[:-11]}_std', 8)}, "
    f"{r(_model_corr(m), f'{m[:-11]}_correlation', 8)}" for m in MODELS
)


@query("prediction_report", over(["predictions"], f"SELECT {_REPORT} FROM predictions"), digits=8)
def prediction_report(spark, sf):
    return _flat(accuracy.prediction_report(materialize(views.predictions(spark, sf)), MODELS))


def _flat(report):
    """The report with a column for each statistic of each model."""
    models = [m.removesuffix("_prediction") for m in MODELS]
    parts = {"mean": "mean", "std": "std", "correlation": "correlation_with_ensemble"}
    flat = [
        F.col("individual_models")[m][field].alias(f"{m}_{name}") for m in models for name, field in parts.items()
    ]
    return report.select(*[c for c in report.columns if c != "individual_models"], *flat)


@query(
    "sink_report_json",
    over(["predictions"], f"SELECT 'mean' AS ensemble_method, {_REPORT} FROM predictions"),
    digits=8,
)
def sink_report_json(spark, sf):
    """The report as it is read back from the written document."""
    report = accuracy.prediction_report(materialize(views.predictions(spark, sf)), MODELS)
    path = sinks.sink_report_json(
        report, staging_path(spark, "report"), config=F.struct(F.lit("mean").alias("ensemble_method"))
    )
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in report.schema)
    schema = f"struct<summary: struct<{fields}>, config: struct<ensemble_method: string>>"
    read = spark.read.text(path).select(F.from_json("value", schema).alias("d")).select("d.summary.*", "d.config.ensemble_method")
    return _flat(read)


@query(
    "single_fund_summary",
    over(["predictions"], f"""SELECT {r(f'avg({E_})', 'mean_prediction', 8)}, {r(f'stddev_samp({E_})', 'std_prediction', 8)},
      count(*) AS n_observations, {r(f'arg_max({E_}, month_end)', 'latest_prediction', 8)}
      FROM predictions WHERE class_id = 'C000000003'"""),
    digits=8,
)
def single_fund_summary(spark, sf):
    return accuracy.single_fund_summary(views.predictions(spark, sf), "C000000003")


@query(
    "pivot_error_matrix",
    over(["scored"], months_sql("cells", "class_id"), {"cells":
        f"""SELECT class_id, strftime(month_end, '%Y%m') AS m, {r(f'avg({P} - {T})', 'v', 10)} FROM scored GROUP BY ALL"""}),
    digits=10,
)
def pivot_error_matrix(spark, sf):
    """A column for every month of the calendar."""
    return accuracy.pivot_error_matrix(_scored(spark, sf), CALENDAR)


@query(
    "topk_bottomk_funds",
    over(["predictions"], f"""SELECT class_id, n, {r('mean', digits=7)}, side FROM (
      (SELECT *, 'top' AS side FROM funds ORDER BY mean DESC NULLS LAST, class_id LIMIT 3) UNION ALL
      (SELECT *, 'bottom' AS side FROM funds ORDER BY mean NULLS LAST, class_id LIMIT 3))""",
      {"funds": f"SELECT class_id, count({E_}) AS n, round(avg({E_}), 7) AS mean FROM predictions GROUP BY 1"}),
    digits=7,
)
def topk_bottomk_funds(spark, sf):
    funds = accuracy.describe_by(views.predictions(spark, sf), "class_id", E_, extremes=False, digits=7)
    return ordering.top_and_bottom(funds.select("class_id", "n", "mean"), "mean", "class_id", 3)


VARIABLES = [views.TARGET, *views.FEATURES]


def _stats_sql(extra: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{v}' AS variable, {extra.replace('$', chr(34) + v + chr(34))} FROM characteristics" for v in VARIABLES
    )


@query(
    "panel_summary_stats",
    over(["characteristics"], f"""SELECT variable, {r('mean', digits=5)}, {r('std', digits=5)}, observations, missing,
      {r('lo', 'min', 5)}, {r('hi', 'max', 5)}, {r('median', digits=5)} FROM ({_stats_sql(
        'avg($) AS mean, stddev_samp($) AS std, count($) AS observations, count(*) - count($) AS missing, '
        'min($) AS lo, max($) AS hi, quantile_cont($, 0.5) AS median')})"""),
    digits=5,
)
def panel_summary_stats(spark, sf):
    return accuracy.panel_summary_stats(materialize(views.characteristics(spark, sf)), VARIABLES, digits=5)


@query(
    "scaling_evidence",
    over(["characteristics"], f"""SELECT variable, {r('mean', digits=5)}, {r('std', digits=5)}, abs(mean) < 0.1 AS mean_near_zero,
      abs(std - 1) < 0.1 AS std_near_one, abs(mean) < 0.1 AND abs(std - 1) < 0.1 AS likely_scaled,
      abs(avg(mean) OVER ()) < 0.1 AND abs(avg(std) OVER () - 1) < 0.2 AS table_scaled
      FROM ({_stats_sql('avg($) AS mean, stddev_samp($) AS std')})"""),
    digits=5,
)
def scaling_evidence(spark, sf):
    return accuracy.scaling_evidence(materialize(views.characteristics(spark, sf)), VARIABLES)
