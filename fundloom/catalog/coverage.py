"""Coverage and availability reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, i, over, query, r
from fundloom.operators import coverage, timeseries
from fundloom.plans import views

FACTORS = ["MKT_RF", "SMB", "HML", "RMW", "CMA", "MOM", "RF"]
A = '"realized alpha"'

BY_FUND = {
    "funds": f"""SELECT *, expected_months - actual_months AS missing_months,
      actual_months * 100.0::DOUBLE / expected_months AS coverage_pct FROM (
        SELECT class_id, min(month_end) AS first_date, max(month_end) AS last_date,
          count(DISTINCT month_end) AS actual_months, count("return") AS has_returns, count({A}) AS has_alpha,
          datediff('month', min(month_end), max(month_end)) + 1 AS expected_months
        FROM gappy_audit GROUP BY 1)"""
}


def _panel(spark, sf):
    return views.gappy(views.audited_panel(spark, sf))


@query(
    "coverage_by_fund",
    over(["gappy_audit"], f"""SELECT class_id, {d('first_date')}, {d('last_date')}, actual_months, has_returns,
      has_alpha, {i('expected_months')}, {i('missing_months')}, {r('coverage_pct')} FROM funds""", BY_FUND),
)
def coverage_by_fund(spark, sf):
    return coverage.coverage_by_fund(_panel(spark, sf))


@query(
    "coverage_summary",
    over(["gappy_audit"], f"""SELECT {r('avg(coverage_pct)', 'mean_coverage')}, {r('min(coverage_pct)', 'min_coverage')},
      {r('max(coverage_pct)', 'max_coverage')}, count(*) AS funds,
      {i('count(CASE WHEN missing_months > 0 THEN 1 END)', 'funds_with_gaps')},
      {r('avg(CASE WHEN missing_months > 0 THEN missing_months END)', 'mean_missing')},
      {i('count(CASE WHEN coverage_pct < 50 THEN 1 END)', 'funds_below_50')},
      {r('quantile_cont(coverage_pct, 0.5)', 'median_coverage')} FROM funds""", BY_FUND),
)
def coverage_summary(spark, sf):
    return coverage.coverage_summary(_panel(spark, sf))


@query(
    "worst_coverage",
    over(["gappy_audit"], f"""SELECT class_id, {i('expected_months')}, actual_months, {r('coverage_pct')} FROM funds
      WHERE coverage_pct < 97.5 ORDER BY funds.coverage_pct, class_id LIMIT 10""", BY_FUND),
)
def worst_coverage(spark, sf):
    return coverage.worst_coverage(_panel(spark, sf), below=97.5)


@query(
    "monthly_record_counts",
    over(["filings"], f"""SELECT {r('avg(n)', 'mean_count')}, {r('stddev_samp(n)', 'std_count')},
      {i('min(n)', 'min_count')}, {i('max(n)', 'max_count')}
      FROM (SELECT count(*) AS n FROM filings GROUP BY month_end)"""),
)
def monthly_record_counts(spark, sf):
    return coverage.monthly_record_counts(views.filings(spark, sf))


@query(
    "low_count_months",
    over(["filings"], f"""SELECT {d('month_end')}, n, {r('threshold')} FROM (
      SELECT *, avg(n) OVER () - 2 * stddev_samp(n) OVER () AS threshold
      FROM (SELECT month_end, count(*) AS n FROM filings GROUP BY 1)) WHERE n < threshold"""),
)
def low_count_months(spark, sf):
    return coverage.low_count_months(views.filings(spark, sf))


@query(
    "quarterly_unique_funds",
    over(["filings"], f"""SELECT {d("date_trunc('quarter', month_end)", 'quarter')}, count(DISTINCT class_id) AS funds
      FROM filings GROUP BY 1"""),
)
def quarterly_unique_funds(spark, sf):
    return coverage.quarterly_unique_funds(views.filings(spark, sf))


@query(
    "availability_by_month",
    over(["gappy_audit"], f"""SELECT {d('month_end')}, count("return") AS returns, count({A}) AS alphas,
      count(MKT_RF) AS factors, count(*) AS total_records, {r(f'count({A}) * 100.0 / count(*)', 'pct_with_alpha')},
      {r('count(MKT_RF) * 100.0 / count(*)', 'pct_with_factors')} FROM gappy_audit GROUP BY gappy_audit.month_end"""),
)
def availability_by_month(spark, sf):
    return coverage.availability_by_month(_panel(spark, sf))


@query(
    "availability_by_year",
    over(["gappy_audit"], f"""SELECT year(month_end) AS year, count(*) AS total, count({A}) AS with_alpha,
      {r(f'count({A}) * 100.0::DOUBLE / count(*)', 'pct', 1)} FROM gappy_audit GROUP BY 1"""),
    digits=1,
)
def availability_by_year(spark, sf):
    return coverage.availability_by_year(_panel(spark, sf))


@query(
    "column_availability",
    over(["gappy_audit"], " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS available, {r(f'count({c}) / count(*)', 'share')} FROM gappy_audit"
        for c in FACTORS)),
)
def column_availability(spark, sf):
    return coverage.column_availability(_panel(spark, sf), FACTORS)


@query(
    "fund_history",
    over(["gappy_audit"], f"""SELECT class_id, {d('min(month_end)', 'first_month')}, {d('max(month_end)', 'last_month')},
      count(*) AS total_months, count({A}) AS months_with_alpha, {r(f'count({A}) * 100.0 / count(*)', 'pct_with_alpha')}
      FROM gappy_audit GROUP BY 1"""),
)
def fund_history(spark, sf):
    return coverage.fund_history(_panel(spark, sf))


@query(
    "months_before_alpha",
    over(["gappy_audit"], f"""SELECT count(*) AS funds, {r('avg(months)', 'mean_months')}, {i('min(months)', 'min_months')},
      {i('max(months)', 'max_months')}, {r('quantile_cont(months, 0.5)', 'median_months')} FROM (
        SELECT datediff('month', min(month_end), min(CASE WHEN {A} IS NOT NULL THEN month_end END)) AS months
        FROM gappy_audit GROUP BY class_id) WHERE months IS NOT NULL"""),
)
def months_before_alpha(spark, sf):
    return coverage.months_before_alpha(_panel(spark, sf))


@query(
    "alpha_boundary_months",
    over(["gappy_audit"], f"""SELECT {d('a', 'first_month')}, {d('b', 'first_alpha')}, {d('c', 'last_without_alpha')},
      {i("datediff('month', a, b)", 'months_to_alpha')} FROM (SELECT min(month_end) AS a,
        min(CASE WHEN {A} IS NOT NULL THEN month_end END) AS b, max(CASE WHEN {A} IS NULL THEN month_end END) AS c
        FROM gappy_audit)"""),
)
def alpha_boundary_months(spark, sf):
    return coverage.alpha_boundary_months(_panel(spark, sf))


@query(
    "funds_with_min_history",
    over(["gappy_panel"], """SELECT count(*) AS funds, count(CASE WHEN m >= 36 THEN 1 END) AS funds_with_history,
      max(m) AS longest FROM (SELECT count(DISTINCT month_end) AS m FROM gappy_panel GROUP BY class_id)"""),
)
def funds_with_min_history(spark, sf):
    return coverage.funds_with_min_history(views.gappy(views.panel(spark, sf)))


@query(
    "regression_eligibility",
    over(["gappy_audit"], f"""SELECT {i('sum(n)', 'complete_rows')}, count(CASE WHEN n >= 30 THEN 1 END) AS eligible_funds,
      max(n) AS longest, {i('sum(greatest(n - 29, 0))', 'expected_windows')} FROM (SELECT count(CASE WHEN "return" IS NOT NULL
        AND {' AND '.join(f'{c} IS NOT NULL' for c in FACTORS)} THEN 1 END) AS n FROM gappy_audit GROUP BY class_id)"""),
)
def regression_eligibility(spark, sf):
    return coverage.regression_eligibility(_panel(spark, sf), ["return", *FACTORS])


@query(
    "alpha_coverage_by_month",
    over(["gappy_audit"], f"""SELECT count(*) AS months, min(n) AS min_per_month, max(n) AS max_per_month,
      {r('avg(n)', 'mean_per_month')}, {r(f'''(SELECT count({A}) / count(*) FROM gappy_audit
        WHERE month_end >= DATE '2000-12-31')''', 'recent_share')}
      FROM (SELECT count({A}) AS n FROM gappy_audit GROUP BY month_end) WHERE n > 0"""),
)
def alpha_coverage_by_month(spark, sf):
    return coverage.alpha_coverage_by_month(_panel(spark, sf), "2000-12-31")


def _coverage_sql(source: str, suffix: str) -> str:
    return f"""SELECT CAST(sum(n) AS BIGINT) AS records_{suffix}, sum(a) * 100.0 / sum(n) AS coverage_{suffix},
      sum(la) * 100.0 / sum(ln) AS late_coverage_{suffix}, avg(m) AS months_per_fund_{suffix} FROM (
      SELECT count(*) AS n, count({A}) AS a, count(CASE WHEN month_end >= DATE '1999-01-31' THEN 1 END) AS ln,
        count(CASE WHEN month_end >= DATE '1999-01-31' THEN {A} END) AS la, count(DISTINCT month_end) AS m
      FROM {source} GROUP BY class_id)"""


_MEASURES = ("coverage", "late_coverage", "months_per_fund")


@query(
    "coverage_before_after",
    over(
        ["gappy_audit"],
        "SELECT records_before, records_after, records_after - records_before AS records_change, "
        + ", ".join(
            f"{r(f'{m}_before')}, {r(f'{m}_after')}, {r(f'{m}_after - {m}_before', f'{m}_change')}" for m in _MEASURES
        )
        + " FROM old, new",
        {
            "sparse": "SELECT * FROM gappy_audit WHERE month(month_end) % 2 = 0",
            "old": _coverage_sql("sparse", "before"),
            "new": _coverage_sql("gappy_audit", "after"),
        },
    ),
)
def coverage_before_after(spark, sf):
    """The panel with every second month against the whole one."""
    after = _panel(spark, sf)
    return coverage.coverage_before_after(after.where(F.month("month_end") % 2 == 0), after, "1999-01-31")


@query(
    "modal_fund_timeline",
    over(["gappy_panel"], f"""SELECT class_id, {d('month_end')}, {r('"return"', 'return')} FROM gappy_panel WHERE class_id =
      (SELECT class_id FROM gappy_panel GROUP BY 1 ORDER BY count(*) DESC, class_id LIMIT 1) ORDER BY gappy_panel.month_end LIMIT 12"""),
)
def modal_fund_timeline(spark, sf):
    return coverage.modal_fund_timeline(views.gappy(views.panel(spark, sf)))


@query(
    "month_gaps",
    over(["gappy_panel"], f"""SELECT class_id, count(*) AS n_steps, {i('sum((days > 32)::INT)', 'n_gap')},
      {i('sum((days BETWEEN 25 AND 35)::INT)', 'n_normal')}, {i('sum((days > 60)::INT)', 'n_large')},
      {i('max(days)', 'max_days')} FROM (SELECT class_id,
        month_end - lag(month_end) OVER (PARTITION BY class_id ORDER BY month_end) AS days FROM gappy_panel)
      WHERE days IS NOT NULL GROUP BY 1"""),
)
def month_gaps(spark, sf):
    return timeseries.month_gap_summary(views.gappy(views.panel(spark, sf)))
