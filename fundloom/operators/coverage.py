"""Reports on how complete the panel is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.functions.scalars import col, months_spanned
from fundloom.functions.stats import all_true, quantiles_wide, unpivot_measures
from fundloom.session import materialize

ALPHA = "realized alpha"


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def coverage_by_fund(panel: DataFrame) -> DataFrame:
    """Expected and present month ends per class between its first and last month."""
    per_fund = panel.groupBy("class_id").agg(
        F.min("month_end").alias("first_date"),
        F.max("month_end").alias("last_date"),
        F.count_distinct("month_end").alias("actual_months"),
        F.count("return").alias("has_returns"),
        F.count(col(ALPHA)).alias("has_alpha"),
    )
    expected = months_spanned(F.col("first_date"), F.col("last_date")) + 1
    return per_fund.withColumn("expected_months", expected).withColumns(
        {
            "missing_months": F.col("expected_months") - F.col("actual_months"),
            "coverage_pct": _share(F.col("actual_months"), F.col("expected_months")),
        }
    )


def coverage_summary(panel: DataFrame) -> DataFrame:
    """Distribution of coverage over the funds."""
    funds = materialize(coverage_by_fund(panel))
    gaps = F.when(F.col("missing_months") > 0, F.col("missing_months"))
    summary = funds.agg(
        F.avg("coverage_pct").alias("mean_coverage"),
        F.min("coverage_pct").alias("min_coverage"),
        F.max("coverage_pct").alias("max_coverage"),
        F.count(F.lit(1)).alias("funds"),
        F.count(gaps).alias("funds_with_gaps"),
        F.avg(gaps).alias("mean_missing"),
        F.count(F.when(F.col("coverage_pct") < 50, 1)).alias("funds_below_50"),
    )
    median = quantiles_wide(funds, ["coverage_pct"], {"median_coverage": 0.5}).drop("variable")
    return summary.crossJoin(F.broadcast(median))


def worst_coverage(panel: DataFrame, below: float = 50.0, n: int = 10) -> DataFrame:
    poor = coverage_by_fund(panel).where(F.col("coverage_pct") < below)
    chosen = poor.select("class_id", "expected_months", "actual_months", "coverage_pct")
    return chosen.orderBy("coverage_pct", "class_id").limit(n)


def monthly_counts(panel: DataFrame) -> DataFrame:
    return panel.groupBy("month_end").agg(F.count(F.lit(1)).alias("n"))


def monthly_record_counts(panel: DataFrame) -> DataFrame:
    return monthly_counts(panel).agg(
        F.avg("n").alias("mean_count"),
        F.stddev_samp("n").alias("std_count"),
        F.min("n").alias("min_count"),
        F.max("n").alias("max_count"),
    )


def low_count_months(panel: DataFrame, deviations: float = 2.0) -> DataFrame:
    """Months far below the usual number of records; one row per calendar month is compared."""
    every = Window.partitionBy()
    limit = F.avg("n").over(every) - deviations * F.stddev_samp("n").over(every)
    return monthly_counts(panel).withColumn("threshold", limit).where("n < threshold")


def quarterly_unique_funds(panel: DataFrame) -> DataFrame:
    quarter = F.trunc("month_end", "quarter").alias("quarter")
    return panel.groupBy(quarter).agg(F.count_distinct("class_id").alias("funds"))


def availability_by_month(panel: DataFrame) -> DataFrame:
    counts = panel.groupBy("month_end").agg(
        F.count("return").alias("returns"),
        F.count(col(ALPHA)).alias("alphas"),
        F.count("MKT_RF").alias("factors"),
        F.count("class_id").alias("total_records"),
    )
    return counts.withColumns(
        {
            "pct_with_alpha": _share(F.col("alphas"), F.col("total_records")),
            "pct_with_factors": _share(F.col("factors"), F.col("total_records")),
        }
    )


def availability_by_year(panel: DataFrame) -> DataFrame:
    counts = panel.groupBy(F.year("month_end").alias("year")).agg(
        F.count(F.lit(1)).alias("total"), F.count(col(ALPHA)).alias("with_alpha")
    )
    return counts.withColumn("pct", F.round(_share(F.col("with_alpha"), F.col("total")), 1))


def column_availability(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values and their share per column, from one pass of counts."""
    counted = panel.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(col(c)).alias(c) for c in columns]
    )
    long = unpivot_measures(counted, columns, ["_rows"])
    return long.select(
        "variable",
        F.col("value").cast("bigint").alias("available"),
        F.try_divide("value", "_rows").alias("share"),
    )


def fund_history(panel: DataFrame) -> DataFrame:
    per_fund = panel.groupBy("class_id").agg(
        F.min("month_end").alias("first_month"),
        F.max("month_end").alias("last_month"),
        F.count("month_end").alias("total_months"),
        F.count(col(ALPHA)).alias("months_with_alpha"),
    )
    return per_fund.withColumn(
        "pct_with_alpha", _share(F.col("months_with_alpha"), F.col("total_months"))
    )


def months_before_alpha(panel: DataFrame) -> DataFrame:
    """Distribution over funds of the months between the first row and the first known alpha."""
    known = F.min(F.when(col(ALPHA).isNotNull(), F.col("month_end")))
    per_fund = (
        panel.groupBy("class_id")
        .agg(F.min("month_end").alias("first_month"), known.alias("first_alpha"))
        .where(F.col("first_alpha").isNotNull())
        .withColumn("months", months_spanned(F.col("first_month"), F.col("first_alpha")))
    )
    per_fund = materialize(per_fund)
    spread = per_fund.agg(
        F.count(F.lit(1)).alias("funds"),
        F.avg("months").alias("mean_months"),
        F.min("months").alias("min_months"),
        F.max("months").alias("max_months"),
    )
    median = quantiles_wide(per_fund, ["months"], {"median_months": 0.5}).drop("variable")
    return spread.crossJoin(F.broadcast(median))


def alpha_boundary_months(panel: DataFrame) -> DataFrame:
    has = col(ALPHA).isNotNull()
    edges = panel.agg(
        F.min("month_end").alias("first_month"),
        F.min(F.when(has, F.col("month_end"))).alias("first_alpha"),
        F.max(F.when(~has, F.col("month_end"))).alias("last_without_alpha"),
    )
    return edges.withColumn(
        "months_to_alpha", months_spanned(F.col("first_month"), F.col("first_alpha"))
    )


def funds_with_min_history(panel: DataFrame, months: int = 36) -> DataFrame:
    per_fund = panel.groupBy("class_id").agg(F.count_distinct("month_end").alias("months"))
    return per_fund.agg(
        F.count(F.lit(1)).alias("funds"),
        F.count(F.when(F.col("months") >= months, 1)).alias("funds_with_history"),
        F.max("months").alias("longest"),
    )


def regression_eligibility(panel: DataFrame, needed: Sequence[str], min_obs: int = 30) -> DataFrame:
    complete = all_true([col(c).isNotNull() for c in needed])
    per_fund = panel.groupBy("class_id").agg(F.count(F.when(complete, 1)).alias("n"))
    windows = F.greatest(F.col("n") - (min_obs - 1), F.lit(0))
    return per_fund.agg(
        F.sum("n").alias("complete_rows"),
        F.count(F.when(F.col("n") >= min_obs, 1)).alias("eligible_funds"),
        F.max("n").alias("longest"),
        F.sum(windows).alias("expected_windows"),
    )


def alpha_coverage_by_month(panel: DataFrame, recent_since: str) -> DataFrame:
    """Regressions per month, and the share of recent rows that have one."""
    recent = F.col("month_end") >= F.lit(recent_since).cast("date")
    monthly = panel.groupBy("month_end").agg(
        F.count(col(ALPHA)).alias("n"),
        F.count(F.when(recent, 1)).alias("recent_rows"),
        F.count(F.when(recent, col(ALPHA))).alias("recent_alpha"),
    )
    some = F.when(F.col("n") > 0, F.col("n"))
    return monthly.agg(
        F.count(some).alias("months"),
        F.min(some).alias("min_per_month"),
        F.max(some).alias("max_per_month"),
        F.avg(some).alias("mean_per_month"),
        F.try_divide(F.sum("recent_alpha"), F.sum("recent_rows")).alias("recent_share"),
    )


def panel_coverage(panel: DataFrame, cutoff: str) -> DataFrame:
    """One row: rows, alphas and share over all months and since the cutoff, and months per fund."""
    late = F.col("month_end") >= F.lit(cutoff).cast("date")
    per_fund = panel.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(col(ALPHA)).alias("a"),
        F.count(F.when(late, 1)).alias("late_n"),
        F.count(F.when(late, col(ALPHA))).alias("late_a"),
        F.count_distinct("month_end").alias("months"),
    )
    return per_fund.agg(
        F.sum("n").alias("records"),
        _share(F.sum("a"), F.sum("n")).alias("coverage"),
        _share(F.sum("late_a"), F.sum("late_n")).alias("late_coverage"),
        F.avg("months").alias("months_per_fund"),
    )


def coverage_before_after(before: DataFrame, after: DataFrame, cutoff: str) -> DataFrame:
    old, new = panel_coverage(before, cutoff), panel_coverage(after, cutoff)
    renamed = [d.withColumnsRenamed({c: f"{c}_{s}" for c in d.columns})
               for d, s in ((old, "before"), (new, "after"))]
    both = renamed[0].crossJoin(F.broadcast(renamed[1]))  # one row each
    return both.withColumns(
        {f"{c}_change": F.col(f"{c}_after") - F.col(f"{c}_before") for c in old.columns}
    )


def modal_fund_timeline(panel: DataFrame, n: int = 12) -> DataFrame:
    """First months of the fund with the most rows (smallest id among equals)."""
    most = (
        panel.groupBy("class_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "class_id")
        .limit(1)
    )
    own = panel.join(F.broadcast(most), "class_id", "left_semi")
    return own.select("class_id", "month_end", "return").orderBy("month_end").limit(n)


def fund_index(db: DataFrame) -> DataFrame:
    return db.groupBy("cik", "class_id").agg(
        F.min_by("series_id", F.struct("month_end", "filing_date", "series_id")).alias("series_id"),
        F.min("month_end").alias("first_month"),
        F.max("month_end").alias("last_month"),
        F.count(F.lit(1)).alias("n_months"),
        F.avg("return").alias("avg_return"),
    )


def database_stats(db: DataFrame) -> DataFrame:
    """Size and gaps of the stored returns; only one row per class is looked at a second time."""
    per_class = db.groupBy("class_id").agg(
        F.count_distinct("month_end").alias("months"), F.count(F.lit(1)).alias("n")
    )
    totals = db.agg(
        F.count_distinct("cik").alias("unique_ciks"),
        F.min("month_end").alias("min_month"),
        F.max("month_end").alias("max_month"),
        F.count_distinct("month_end").alias("all_months"),
    )
    return (
        per_class.crossJoin(F.broadcast(totals))
        .groupBy("unique_ciks", "min_month", "max_month", "all_months")
        .agg(
            F.sum("n").alias("total_records"),
            F.count(F.lit(1)).alias("unique_classes"),
            F.avg("months").alias("mean_months_per_fund"),
            F.count(F.when(F.col("months") < F.col("all_months"), 1)).alias("funds_with_gaps"),
        )
        .drop("all_months")
    )


def database_metadata(db: DataFrame, quarters: Column) -> DataFrame:
    """One row describing the stored returns, with the processed quarters as a sorted list.

    The list has one entry per calendar quarter."""
    return db.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("class_id").alias("unique_classes"),
        F.min("month_end").alias("min_month"),
        F.max("month_end").alias("max_month"),
        F.array_join(F.sort_array(F.collect_set(quarters)), ",").alias("quarters_processed"),
    )
