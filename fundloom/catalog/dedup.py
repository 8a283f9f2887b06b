"""Deduplication and duplicate reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, i, over, query, r
from fundloom.operators import coverage, dedup
from fundloom.plans import views

COLS = f"cik, class_id, series_id, {d('month_end')}, {d('filing_date')}, accession, {r('\"return\"', 'return', 10)}"
SHOWN = ["cik", "class_id", "series_id", "month_end", "filing_date", "accession", "return"]


def _first(keys: str, order: str) -> str:
    return over(["filings"], f"""SELECT {COLS} FROM filings
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1""")


@query("dedup_latest_filing", _first("class_id, month_end", "filing_date DESC, accession DESC"), digits=10)
def dedup_latest_filing(spark, sf):
    return dedup.dedup_latest_filing(views.filings(spark, sf)).select(*SHOWN)


@query(
    "dedup_latest_by_registrant",
    _first("cik, class_id, month_end", "filing_date DESC, accession DESC"),
    digits=10,
)
def dedup_latest_by_registrant(spark, sf):
    return dedup.dedup_latest_by_registrant(views.filings(spark, sf)).select(*SHOWN)


@query(
    "dedup_by_priority",
    _first("class_id, month_end", "position, filing_date DESC, accession DESC"),
    digits=10,
)
def dedup_by_priority(spark, sf):
    return dedup.dedup_by_priority(views.filings(spark, sf)).select(*SHOWN)


@query(
    "dedup_mean",
    over(["filings"], f"""SELECT class_id, {d('month_end')}, {r('avg("return")', 'return', 12)},
      min(series_id) AS series_id FROM filings GROUP BY class_id, filings.month_end"""),
    digits=12,
)
def dedup_mean(spark, sf):
    return dedup.dedup_mean(views.filings(spark, sf), ["class_id", "month_end"], "return", ["series_id"])


@query(
    "dedup_predictions_latest",
    over(["predictions"], f"""SELECT class_id, {d('month_end')}, {r('ensemble_prediction * CASE WHEN month(month_end) % 2 = 0 THEN 2 ELSE 1 END', 'ensemble_prediction', 10)},
      CASE WHEN month(month_end) % 2 = 0 THEN '2003-06-30' ELSE '2002-06-30' END AS prediction_timestamp FROM predictions"""),
    digits=10,
)
def dedup_predictions_latest(spark, sf):
    """Two scoring runs, the second over even months only with other values."""
    run = views.predictions(spark, sf).select("class_id", "month_end", "ensemble_prediction")
    first = run.withColumn("prediction_timestamp", F.lit("2002-06-30 12:00:00").cast("timestamp"))
    second = (
        run.where(F.month("month_end") % 2 == 0)
        .withColumn("ensemble_prediction", F.col("ensemble_prediction") * 2)
        .withColumn("prediction_timestamp", F.lit("2003-06-30 12:00:00").cast("timestamp"))
    )
    return dedup.dedup_predictions_latest(first.unionByName(second))


@query(
    "restatement_discrepancies",
    over(["filings"], f"""SELECT class_id, {d('month_end')}, count(DISTINCT "return") AS n_values, count(*) AS n_filings,
      {r('min("return")', 'min_value', 10)}, {r('max("return")', 'max_value', 10)},
      {r('max("return") - min("return")', 'spread', 10)} FROM filings GROUP BY class_id, filings.month_end
      HAVING count(DISTINCT "return") > 1"""),
    digits=10,
)
def restatement_discrepancies(spark, sf):
    return dedup.restatement_discrepancies(views.filings(spark, sf))


@query(
    "duplicate_keys",
    over(["filings"], f"""SELECT count(*) AS duplicate_keys, {r('avg(n)', 'mean_multiplicity')}, {i('max(n)', 'max_multiplicity')}
      FROM (SELECT count(*) AS n FROM filings GROUP BY class_id, month_end HAVING count(*) > 1)"""),
)
def duplicate_keys(spark, sf):
    return dedup.duplicate_summary(views.filings(spark, sf))


@query(
    "fund_index",
    over(["filings"], f"""SELECT cik, class_id, arg_min(series_id, (month_end, filing_date, series_id)) AS series_id,
      {d('min(month_end)', 'first_month')}, {d('max(month_end)', 'last_month')}, count(*) AS n_months,
      {r('avg("return")', 'avg_return', 12)} FROM filings GROUP BY cik, class_id"""),
    digits=12,
)
def fund_index(spark, sf):
    return coverage.fund_index(views.filings(spark, sf))


@query(
    "database_stats",
    over(["filings"], f"""SELECT (SELECT count(*) FROM filings) AS total_records,
      (SELECT count(DISTINCT cik) FROM filings) AS unique_ciks, count(*) AS unique_classes,
      (SELECT strftime(min(month_end), '%Y-%m-%d') FROM filings) AS min_month,
      (SELECT strftime(max(month_end), '%Y-%m-%d') FROM filings) AS max_month,
      {r('avg(months)', 'mean_months_per_fund')},
      {i('sum(CASE WHEN months < (SELECT count(DISTINCT month_end) FROM filings) THEN 1 ELSE 0 END)', 'funds_with_gaps')}
      FROM (SELECT class_id, count(DISTINCT month_end) AS months FROM filings GROUP BY 1)"""),
)
def database_stats(spark, sf):
    return coverage.database_stats(views.filings(spark, sf))
