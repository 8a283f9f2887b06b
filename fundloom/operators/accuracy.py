"""Prediction accuracy and descriptive reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fundloom.functions.scalars import col, null_double
from fundloom.functions.stats import (
    complete_case_filter, correlation, quantiles_wide, sample_excess_kurtosis, sample_skewness, unpivot_measures,
)
from fundloom.session import materialize

PAIR = ["predicted_alpha", "actual_alpha"]


def _complete(df: DataFrame) -> DataFrame:
    return complete_case_filter(df, PAIR)


def accuracy_overall(df: DataFrame) -> DataFrame:
    p, a = F.col("predicted_alpha"), F.col("actual_alpha")
    error = p - a
    return _complete(df).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(a).alias("mean_actual"),
        F.avg(p).alias("mean_predicted"),
        F.stddev_samp(a).alias("std_actual"),
        F.stddev_samp(p).alias("std_predicted"),
        F.avg(error).alias("mean_error"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        correlation(p, a).alias("correlation"),
    )


def accuracy_regression(df: DataFrame) -> DataFrame:
    """Line of actual on predicted."""
    p, a = F.col("predicted_alpha"), F.col("actual_alpha")
    return _complete(df).agg(
        F.regr_slope(a, p).alias("slope"),
        F.regr_intercept(a, p).alias("intercept"),
        F.regr_r2(a, p).alias("r2"),
    )


def directional_accuracy(df: DataFrame) -> DataFrame:
    same = (F.col("predicted_alpha") > 0) == (F.col("actual_alpha") > 0)
    return _complete(df).agg(F.avg(same.cast("double")).alias("directional_accuracy"))


def accuracy_by_month(df: DataFrame) -> DataFrame:
    error = F.abs(F.col("predicted_alpha") - F.col("actual_alpha"))
    return df.groupBy("month_end").agg(
        F.avg("predicted_alpha").alias("mean_predicted"),
        F.avg("actual_alpha").alias("mean_actual"),
        F.avg(error).alias("mae"),
        F.count("class_id").alias("n_funds"),
        correlation("predicted_alpha", "actual_alpha").alias("correlation"),
    )


def accuracy_by_month_summary(df: DataFrame) -> DataFrame:
    return accuracy_by_month(df).agg(
        F.avg("correlation").alias("mean_correlation"),
        F.min("correlation").alias("min_correlation"),
        F.max("correlation").alias("max_correlation"),
    )


def accuracy_by_fund(df: DataFrame) -> DataFrame:
    error = F.abs(F.col("predicted_alpha") - F.col("actual_alpha"))
    per_fund = df.groupBy("class_id").agg(
        F.avg("predicted_alpha").alias("pred_mean"),
        F.stddev_samp("predicted_alpha").alias("pred_std"),
        F.avg("actual_alpha").alias("actual_mean"),
        F.stddev_samp("actual_alpha").alias("actual_std"),
        F.avg(error).alias("mean_abs_error"),
        F.count("month_end").alias("n_months"),
        correlation("predicted_alpha", "actual_alpha").alias("correlation"),
    )
    return per_fund.orderBy(F.asc_nulls_last("mean_abs_error"), "class_id")


def accuracy_by_fund_summary(df: DataFrame) -> DataFrame:
    funds = materialize(accuracy_by_fund(df))
    spread = funds.agg(
        F.avg("correlation").alias("mean_correlation"),
        F.stddev_samp("correlation").alias("std_correlation"),
    )
    median = quantiles_wide(funds, ["correlation"], {"median_correlation": 0.5}).drop("variable")
    return spread.crossJoin(F.broadcast(median))


def describe_by(df: DataFrame, key: str, measure: str, extremes: bool, digits: int = 4) -> DataFrame:
    m = col(measure)
    aggregates = {"mean": F.avg(m), "std": F.stddev_samp(m)}
    if extremes:
        aggregates |= {"min": F.min(m), "max": F.max(m)}
    return df.groupBy(key).agg(
        F.count(m).alias("n"), *[F.round(v, digits).alias(k) for k, v in aggregates.items()]
    )


def distribution_moments(df: DataFrame, measure: str) -> DataFrame:
    m = col(measure)
    moments = df.agg(
        F.avg(m).alias("mean"),
        F.stddev_samp(m).alias("std"),
        sample_skewness(m).alias("skewness"),
        sample_excess_kurtosis(m).alias("kurtosis"),
    )
    wanted = {"q05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "q95": 0.95}
    cuts = quantiles_wide(df, [measure], wanted).drop("variable")
    return moments.crossJoin(F.broadcast(cuts))


def prediction_summary(pred: DataFrame, measure: str = "ensemble_prediction") -> DataFrame:
    m = col(measure)
    totals = pred.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_distinct("class_id").alias("unique_funds"),
        F.min("month_end").alias("start"),
        F.max("month_end").alias("end"),
        F.avg(m).alias("mean"),
        F.stddev_samp(m).alias("std"),
        F.min(m).alias("min"),
        F.max(m).alias("max"),
    )
    cuts = quantiles_wide(pred, [measure], {"q25": 0.25, "median": 0.5, "q75": 0.75}).drop("variable")
    return totals.crossJoin(F.broadcast(cuts))


def model_summary(pred: DataFrame, models: Sequence[str], ensemble: str = "ensemble_prediction") -> DataFrame:
    """Per model its mean, deviation and correlation with the ensemble."""
    long = unpivot_measures(pred, models, [ensemble])
    return long.groupBy(F.regexp_replace("variable", "_prediction$", "").alias("model")).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        correlation("value", ensemble).alias("correlation_with_ensemble"),
    )


def prediction_report(pred: DataFrame, models: Sequence[str]) -> DataFrame:
    """The summary with one struct of statistics per model, as one row."""
    summary = prediction_summary(pred)
    per_model = model_summary(pred, models).agg(
        F.map_from_entries(
            F.sort_array(
                F.collect_list(F.struct("model", F.struct("mean", "std", "correlation_with_ensemble")))
            )
        ).alias("individual_models")
    )
    return summary.crossJoin(F.broadcast(per_model))


def single_fund_summary(pred: DataFrame, class_id: str, measure: str = "ensemble_prediction") -> DataFrame:
    m = col(measure)
    return pred.where(F.col("class_id") == class_id).agg(
        F.avg(m).alias("mean_prediction"),
        F.stddev_samp(m).alias("std_prediction"),
        F.count(F.lit(1)).alias("n_observations"),
        F.max_by(m, F.col("month_end")).alias("latest_prediction"),
    )


def pivot_error_matrix(df: DataFrame, months: Sequence[Column] | None = None) -> DataFrame:
    """Class x month mean error; months run over the calendar, so the columns are bounded."""
    error = df.withColumn("e", F.col("predicted_alpha") - F.col("actual_alpha"))
    labelled = error.withColumn("label", F.date_format("month_end", "yyyyMM"))
    pivoted = labelled.groupBy("class_id")
    pivoted = pivoted.pivot("label", months) if months else pivoted.pivot("label")
    return pivoted.agg(F.avg("e"))


def panel_summary_stats(df: DataFrame, variables: Sequence[str], digits: int = 3) -> DataFrame:
    """One row per variable: mean, median, deviation, counts and range, as in a summary table.

    The frame is read three times; pass a scan or a materialized frame."""
    long = unpivot_measures(df, variables)
    moments = long.groupBy("variable").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.count("value").alias("observations"),
        F.count(F.when(F.col("value").isNull(), 1)).alias("missing"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    medians = quantiles_wide(df, variables, {"median": 0.5})
    joined = moments.join(F.broadcast(medians), "variable", "left")
    shown = {c: F.round(c, digits) for c in ("mean", "median", "std", "min", "max")}
    return joined.withColumns(shown)


def scaling_evidence(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Whether each variable looks standardised, and whether the table does on the whole."""
    long = unpivot_measures(df, variables)
    stats = long.groupBy("variable").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    flagged = stats.withColumns(
        {
            "mean_near_zero": F.abs("mean") < 0.1,
            "std_near_one": F.abs(F.col("std") - 1.0) < 0.1,
        }
    ).withColumn("likely_scaled", F.col("mean_near_zero") & F.col("std_near_one"))
    verdict = stats.agg(F.avg("mean").alias("m"), F.avg("std").alias("s")).select(
        ((F.abs("m") < 0.1) & (F.abs(F.col("s") - 1.0) < 0.2)).alias("table_scaled")
    )
    return flagged.crossJoin(F.broadcast(verdict))
