"""Scores of several models side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fundloom.catalog.registry import d, over, query, r, view
from fundloom.functions import stats
from fundloom.operators import scoring
from fundloom.plans import views
from fundloom.session import materialize

MODELS = ["ols", "rf", "xgb"]
COLUMNS = [f"{m}_prediction" for m in MODELS]
KEYS = f"class_id, {d('month_end')}"
WEIGHTS = {"ols_prediction": 2.0, "xgb_prediction": 0.5}


def _wide(spark, sf) -> DataFrame:
    """Three predictions per class and month, the last one unknown for some."""
    return views.predictions(spark, sf).select(
        "class_id", "month_end", "xgb_prediction", "rf_prediction",
        (F.col("return") * 0.5).alias("ols_prediction"),
    )


view(
    "wide",
    """SELECT class_id, month_end, xgb_prediction, rf_prediction, "return" * 0.5::DOUBLE AS ols_prediction
      FROM predictions""",
    ["predictions"],
)
view(
    "long",
    " UNION ALL ".join(
        f"SELECT class_id, month_end, '{m}' AS model, {m}_prediction AS score FROM wide" for m in MODELS
    ),
    ["wide"],
)
_COUNT = " + ".join(f"({c} IS NOT NULL)::INT" for c in COLUMNS)
_SUM = " + ".join(f"coalesce({c}, 0)" for c in COLUMNS)
_ALL = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)
_MEAN = f"CASE WHEN {_COUNT} > 0 THEN ({_SUM}) / ({_COUNT}) END"


@query("stack_model_results", over(["long"], f"SELECT {KEYS}, model, {r('score', digits=10)} FROM long"), digits=10)
def stack_model_results(spark, sf):
    return scoring.stack_model_results(_wide(spark, sf), MODELS, ["class_id", "month_end"])


@query("model_name_map", over(["long"], f"""SELECT service_model, model, count(score) AS n FROM (SELECT *, CASE model
  WHEN 'rf' THEN 'random_forest' WHEN 'xgb' THEN 'gradient_boosting' ELSE model END AS service_model FROM long)
  GROUP BY 1, 2"""))
def model_name_map(spark, sf):
    stacked = scoring.stack_model_results(_wide(spark, sf), MODELS, ["class_id", "month_end"])
    named = scoring.service_model_names(stacked)
    return named.groupBy("service_model", "model").agg(F.count("score").alias("n"))


@query(
    "ensemble_mean",
    over(["wide"], f"""SELECT {KEYS}, {r(_MEAN, 'batch_mean', 10)},
      {r('(ols_prediction + rf_prediction + xgb_prediction) / 3', 'service_mean', 10)} FROM wide"""),
    digits=10,
)
def ensemble_mean(spark, sf):
    return _wide(spark, sf).select(
        "class_id", "month_end",
        scoring.ensemble_mean(COLUMNS).alias("batch_mean"),
        scoring.ensemble_mean(COLUMNS, skip_nulls=False).alias("service_mean"),
    )


@query(
    "ensemble_median",
    over(["wide"], f"""SELECT {KEYS}, {r(f"CASE WHEN {_ALL} THEN list_sort([{', '.join(COLUMNS)}])[2] END", 'median3', 10)},
      {r('(rf_prediction + xgb_prediction) / 2', 'median2', 10)} FROM wide"""),
    digits=10,
)
def ensemble_median(spark, sf):
    return _wide(spark, sf).select(
        "class_id", "month_end",
        scoring.ensemble_median(COLUMNS).alias("median3"),
        scoring.ensemble_median(COLUMNS[1:]).alias("median2"),
    )


@query(
    "ensemble_weighted",
    over(["wide"], f"""SELECT {KEYS}, {r('(ols_prediction * 2 + rf_prediction + xgb_prediction * 0.5) / 3.5', 'weighted', 9)}
      FROM wide"""),
    digits=9,
)
def ensemble_weighted(spark, sf):
    return _wide(spark, sf).select(
        "class_id", "month_end", scoring.ensemble_weighted(COLUMNS, WEIGHTS).alias("weighted")
    )


@query(
    "prediction_spread",
    over(["wide"], f"""SELECT {KEYS}, {r(f'''CASE WHEN {_ALL} THEN sqrt(((ols_prediction - m) ** 2
        + (rf_prediction - m) ** 2 + (xgb_prediction - m) ** 2) / 3) END''', 'prediction_std', 9)},
      {r(f'CASE WHEN {_ALL} THEN least(ols_prediction, rf_prediction, xgb_prediction) END', 'prediction_min', 10)},
      {r(f'CASE WHEN {_ALL} THEN greatest(ols_prediction, rf_prediction, xgb_prediction) END', 'prediction_max', 10)}
      FROM (SELECT *, (ols_prediction + rf_prediction + xgb_prediction) / 3 AS m FROM wide)"""),
    digits={"*": 10, "prediction_std": 9},
)
def prediction_spread(spark, sf):
    out = scoring.prediction_spread(_wide(spark, sf), COLUMNS)
    return out.select("class_id", "month_end", "prediction_std", "prediction_min", "prediction_max")


_SCORED = {
    "known": "SELECT * FROM long WHERE score IS NOT NULL",
    "limits": """SELECT month_end, model, quantile_cont(score, 0.9) AS q, min(score) AS lo, max(score) AS hi FROM known
      GROUP BY 1, 2""",
    "raws": """SELECT k.*, CASE WHEN score > q THEN CASE WHEN q >= 0 THEN score ELSE (score - lo) / nullif(hi - lo, 0) END
      ELSE 0 END AS raw, score > q AS kept FROM known k JOIN limits USING (month_end, model)""",
    "held": """SELECT *, CASE WHEN sum(raw) OVER g <> 0 THEN raw / sum(raw) OVER g
        WHEN sum(kept::INT) OVER g > 0 THEN kept::INT / sum(kept::INT) OVER g ELSE 1.0::DOUBLE / count(*) OVER g END AS weight
      FROM raws WINDOW g AS (PARTITION BY month_end, model)""",
}


def _results(spark, sf) -> DataFrame:
    stacked = materialize(
        scoring.stack_model_results(_wide(spark, sf), MODELS, ["class_id", "month_end"])
    )
    return scoring.score_models(stacked, ["month_end", "model"], "class_id")


@query(
    "score_models",
    over(["long"], f"""SELECT {d('month_end')}, model, class_id AS fund_id, {r('score', 'predicted_alpha', 10)},
      {r('weight', 'portfolio_weight', 9)}, weight > 0 AS in_top_decile FROM held""", _SCORED),
    digits={"*": 9, "predicted_alpha": 10},
)
def score_models(spark, sf):
    return _results(spark, sf)


_PIVOT = ", ".join(
    f"max(CASE WHEN model = '{m}' THEN score END) AS {m}_a, max(CASE WHEN model = '{m}' THEN weight END) AS {m}_w, "
    f"bool_or(weight > 0) FILTER (model = '{m}') AS {m}_t"
    for m in MODELS
)
_WIDE_SCORED = {**_SCORED, "summary": f"SELECT month_end, class_id AS fund_id, {_PIVOT} FROM held GROUP BY 1, 2"}
_A = [f"{m}_a" for m in MODELS]
_ENSEMBLE = f"({' + '.join(f'coalesce({a}, 0)' for a in _A)}) / ({' + '.join(f'({a} IS NOT NULL)::INT' for a in _A)})"
_HELD = " + ".join(f"coalesce({m}_t::INT, 0)" for m in MODELS)


def _pivoted(spark, sf) -> DataFrame:
    return scoring.pivot_model_predictions(_results(spark, sf), MODELS, ["month_end", "fund_id"])


@query(
    "pivot_model_predictions",
    over(["long"], f"SELECT {d('month_end')}, fund_id, " + ", ".join(
        f"{r(f'{m}_a', f'{m}_predicted_alpha', 9)}, {r(f'{m}_w', f'{m}_portfolio_weight', 9)}, "
        f'{m}_t::INT::BIGINT AS "{m}_in_top_decile"' for m in MODELS) + " FROM summary", _WIDE_SCORED),
    digits=9,
)
def pivot_model_predictions(spark, sf):
    flags = {f"{m}_in_top_decile": F.col(f"{m}_in_top_decile").cast("int") for m in MODELS}
    return _pivoted(spark, sf).withColumns(flags)


@query(
    "consensus_top_decile",
    over(["long"], f"""SELECT {d('month_end')}, fund_id, {r(_ENSEMBLE, 'ensemble_predicted_alpha', 10)},
      CAST({_HELD} AS BIGINT) AS models_top_decile_count, {_HELD} >= 1.5 AS consensus_top_decile FROM summary""",
      _WIDE_SCORED),
    digits=10,
)
def consensus_top_decile(spark, sf):
    out = scoring.consensus_top_decile(_pivoted(spark, sf), MODELS)
    return out.select(
        "month_end", "fund_id", "ensemble_predicted_alpha", "models_top_decile_count", "consensus_top_decile"
    )


@query(
    "topk_ensemble",
    over(["predictions"], f"""SELECT class_id AS fund_id, {d('month_end')},
      {r('ensemble_prediction', 'ensemble_predicted_alpha', 10)} FROM predictions
      ORDER BY ensemble_prediction DESC NULLS LAST, class_id, predictions.month_end LIMIT 5"""),
    digits=10,
)
def topk_ensemble(spark, sf):
    pred = views.predictions(spark, sf).select(
        F.col("class_id").alias("fund_id"), "month_end",
        F.col("ensemble_prediction").alias("ensemble_predicted_alpha"),
    )
    return scoring.topk_ensemble(pred)
