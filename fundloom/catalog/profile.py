"""Column profiles, availability of features, pivots of returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, i, over, query, r
from fundloom.functions import stats
from fundloom.operators import coverage, ordering, portfolio, profile, timeseries
from fundloom.plans import views
from fundloom.session import materialize

COLUMNS = ["class_id", "series_id", "month_end", "return", "sales", "cash", "n"]
TYPES = ["string", "string", "date", "double", "double", "double", "bigint"]


def _column_sql(c: str, t: str) -> str:
    dates = (
        "strftime(min(month_end), '%Y-%m-%d'), strftime(max(month_end), '%Y-%m-%d')" if t == "date" else "NULL, NULL"
    )
    return (
        f"""SELECT '{c}', '{t}', count("{c}"), round((count(*) - count("{c}")) * 100.0::DOUBLE / count(*), 6),
        count(DISTINCT "{c}"), {dates} FROM panel"""
    )


@query(
    "column_profile",
    over(["panel"], """SELECT * FROM ("""
         + " UNION ALL ".join(_column_sql(c, t) for c, t in zip(COLUMNS, TYPES))
         + """) AS t("column", "type", non_null, null_pct, distinct_values, min_date, max_date)"""),
)
def column_profile(spark, sf):
    return profile.column_profile(views.panel(spark, sf).select(*COLUMNS))


TEXT = ["o_orderpriority", "o_orderstatus", "class_id"]


@query(
    "top_values",
    over(["filings"], " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", value, n, {i('row_number() OVER (ORDER BY n DESC, value)', 'place')} FROM
        (SELECT {c} AS value, count(*) AS n FROM {t} GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, value) <= 5"""
        for c, t in (("o_orderpriority", "orders"), ("o_orderstatus", "orders"), ("class_id", "filings")))),
)
def top_values(spark, sf):
    orders = views.table(spark, sf, "orders").withColumn("class_id", views.class_key("o_custkey"))
    return profile.top_values(orders.select(*TEXT))


@query(
    "high_missing_columns",
    over(["panel"], f"""SELECT "column", {r('missing_ratio')}, n_rows FROM ("""
         + " UNION ALL ".join(
             f"""SELECT '{c}' AS "column", 1 - count("{c}") / count(*) AS missing_ratio, count(*) AS n_rows FROM panel"""
             for c in COLUMNS)
         + """) WHERE missing_ratio > 0.5"""),
)
def high_missing_columns(spark, sf):
    return profile.high_missing_columns(views.panel(spark, sf).select(*COLUMNS))


_OFFERED = {"total net assets": "total_investments", "flows": "net_flow", "expense ratio": "net_expense_ratio"}


@query(
    "feature_compatibility",
    over(["panel"], "SELECT * FROM ("
         + " UNION ALL ".join(
             f"""SELECT '{f}', {f"'{_OFFERED[f]}'" if f in _OFFERED else 'NULL'}, {'TRUE' if f in _OFFERED else 'FALSE'},
             'too few', {dict([("total_investments", "count(total_investments)"),
                               ("net_flow", "count(sales + reinvest - redemptions)"),
                               ("net_expense_ratio", "count(avg_tax)")]).get(_OFFERED.get(f), "count(NULL)")} FROM panel"""
             for f in profile.FEATURE_ALIASES)
         + """) AS t(feature, source, available, verdict, known)"""),
)
def feature_compatibility(spark, sf):
    """The verdict on the schema with the number of known values each feature would have."""
    etl = timeseries.net_flow(views.panel(spark, sf)).withColumnRenamed("avg_tax", "net_expense_ratio")
    verdict = profile.feature_compatibility(spark, etl.columns)
    found = profile.first_available_columns(etl)
    known = coverage.column_availability(found, list(profile.FEATURE_ALIASES))
    counted = known.select(F.col("variable").alias("feature"), F.col("available").alias("known"))
    return verdict.join(counted, "feature").select("feature", "source", "available", "verdict", "known")


#: The months that the wide forms have a column for: the calendar of the given tables.
CALENDAR = [f"{y}{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


def months_sql(cells: str, key: str) -> str:
    """One column for each month of the calendar, from cells (key, m, v)."""
    columns = ", ".join(f"max(CASE WHEN m = '{m}' THEN v END) AS \"{m}\"" for m in CALENDAR)
    return f"SELECT {key}, {columns} FROM {cells} GROUP BY {key}"


@query(
    "pivot_returns_wide",
    over(["returns"], months_sql("cells", "fundno"), {"cells":
        f"""SELECT fundno, strftime("Date", '%Y%m') AS m, {r('avg(mret)', 'v')} FROM returns GROUP BY ALL"""}),
)
def pivot_returns_wide(spark, sf):
    """A column for every month of the calendar."""
    return portfolio.pivot_returns_wide(views.returns(spark, sf), CALENDAR)


@query(
    "generated_fund_ids",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
      'fund_' || (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1)
      AS fund_id FROM lineitem""",
)
def generated_fund_ids(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = views.table(spark, sf, "lineitem").select(*order)
    numbered = ordering.generated_fund_ids(rows, [F.col(c) for c in order])
    return numbered.select("l_orderkey", "l_linenumber", "l_partkey", "fund_id")


@query(
    "rank_and_decile",
    over(["predictions"], f"""SELECT strftime(month_end, '%Y-%m-%d') AS month_end, class_id AS fund_id,
      {r('ensemble_prediction', 'expected_alpha', 10)},
      rank() OVER (PARTITION BY predictions.month_end ORDER BY ensemble_prediction DESC) AS rank,
      ntile(10) OVER (PARTITION BY predictions.month_end ORDER BY ensemble_prediction DESC, class_id) AS decile
      FROM predictions WHERE ensemble_prediction IS NOT NULL"""),
    digits=10,
)
def rank_and_decile(spark, sf):
    return ordering.rank_and_decile(views.predictions(spark, sf), "month_end", "class_id", "ensemble_prediction")


_CHECKED = ["class_id", "month_end", "return", "avg_tax", "MKT_RF", "sales", "redemptions", "realized alpha", "filing_date"]


@query(
    "spot_check_sample",
    over(["audited_panel"], f"""SELECT class_id, {d('audited_panel.month_end', 'month_end')}, {r('"return"', 'return')},
      {r('avg_tax')}, {r('"MKT_RF"', 'MKT_RF')}, {r('sales', digits=4)}, {r('redemptions', digits=4)},
      {r('"realized alpha"', 'realized alpha')}, {d('filing_date')} FROM audited_panel
      ORDER BY md5(class_id || '|' || CAST(audited_panel.month_end AS VARCHAR) || '|1011') LIMIT 50"""),
    digits={"*": 6, "sales": 4, "redemptions": 4},
)
def spot_check_sample(spark, sf):
    rows = views.audited_panel(spark, sf).select(*_CHECKED)
    return ordering.spot_check_sample(rows, ["class_id", "month_end"], 50)


_EXACT = {"mtna_lag_1": 11, "beta_value_tstat_lag_1": 12}  # quotients and squares of short decimals


@query(
    "required_columns_check",
    over(["characteristics"], 'SELECT fundno, "Date", ' + ", ".join(
        r(f'"{f}"', f, _EXACT.get(f, 9)) for f in views.FEATURES) + " FROM characteristics"),
    digits={"*": 9, **_EXACT},
)
def required_columns_check(spark, sf):
    """The characteristics after their contract was checked; a missing column stops the job instead."""
    chars = profile.require_columns(views.characteristics(spark, sf), ["fundno", "Date", *views.FEATURES])
    return chars.select("fundno", "Date", *views.FEATURES)
