"""Projections, coercions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, i, over, query, r
from fundloom.functions import scalars as S, stats
from fundloom.operators import features, joins, profile, timeseries
from fundloom.plans import views
from fundloom.session import materialize, staging_path
from fundloom.sources import sinks


def _orders(spark, sf):
    return views.table(spark, sf, "orders")


@query("strip_float_suffix", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS fundno FROM orders""")
def strip_float_suffix(spark, sf):
    as_float = F.col("o_custkey").cast("double").cast("string")
    return _orders(spark, sf).select("o_orderkey", S.strip_float_suffix(as_float).alias("fundno"))


@query(
    "coerce_month_start",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN {d("date_trunc('month', o_orderdate)").split(' AS ')[0]}
      END AS month_start FROM orders""",
)
def coerce_month_start(spark, sf):
    key, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    spelled = (
        F.when(key == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key == 1, F.date_format(day, "yyyyMMdd"))
        .when(key == 2, F.date_format(day, "yyyyMM"))
        .otherwise(F.concat(F.lit("c."), F.date_format(day, "yyyy")))
    )
    return _orders(spark, sf).select("o_orderkey", S.coerce_month_start(spelled).alias("month_start"))


@query(
    "yyyymm_keys",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS "period", {i('year(o_orderdate)', 'year')},
      {i('month(o_orderdate)', 'month')}, {d('last_day(o_orderdate)', 'month_end')} FROM orders""",
)
def yyyymm_keys(spark, sf):
    period = S.yyyymm(F.date_format("o_orderdate", "yyyyMMdd"))
    return _orders(spark, sf).select(
        "o_orderkey",
        period.alias("period"),
        F.substring(period, 1, 4).cast("int").alias("year"),
        F.substring(period, 5, 2).cast("int").alias("month"),
        S.yyyymm_to_month_end(period).alias("month_end"),
    )


@query(
    "split_composite_key",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS fund,
      CASE WHEN o_orderkey % 3 <> 2 THEN strftime(o_orderdate, '%Y%m') END AS date FROM orders""",
)
def split_composite_key(spark, sf):
    key, month = F.col("o_orderkey") % 3, F.date_format("o_orderdate", "yyyyMM")
    joined = (
        F.when(key == 0, F.concat_ws(".", F.col("o_custkey").cast("string"), month))
        .when(key == 1, F.concat_ws("_", F.col("o_custkey").cast("string"), month))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    fund, date = S.split_composite_key(joined)
    return _orders(spark, sf).select("o_orderkey", fund.alias("fund"), date.alias("date"))


def _written_price():
    key, price = F.col("o_orderkey") % 6, F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return (
        F.when(key == 0, F.lit("N/A"))
        .when(key == 1, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(key == 2, F.concat(F.lit("-"), price))
        .when(key == 3, F.lit("null"))
        .when(key == 4, F.concat(price, F.lit("d")))
        .otherwise(price)
    )


_READ = "CASE o_orderkey % 6 WHEN 1 THEN o_totalprice WHEN 2 THEN -o_totalprice WHEN 5 THEN o_totalprice END"


@query("to_numeric_or_null", f"SELECT o_orderkey, {r(_READ, 'value', 2)} FROM orders", digits=2)
def to_numeric_or_null(spark, sf):
    return _orders(spark, sf).select("o_orderkey", S.to_numeric_or_null(_written_price()).alias("value"))


@query("safe_float_default", f"SELECT o_orderkey, {r(f'coalesce({_READ}, 0)', 'value', 2)} FROM orders", digits=2)
def safe_float_default(spark, sf):
    return _orders(spark, sf).select("o_orderkey", S.safe_float_default(_written_price()).alias("value"))


@query("pct_to_decimal", f"SELECT l_orderkey, l_linenumber, {r('l_discount / 100', 'fraction')} FROM lineitem")
def pct_to_decimal(spark, sf):
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", S.pct_to_decimal("l_discount").alias("fraction")
    )


@query(
    "pad_registrant_id",
    """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded,
      CAST(c_custkey AS VARCHAR) AS bare FROM customer""",
)
def pad_registrant_id(spark, sf):
    written = F.when(F.col("c_custkey") % 2 == 0, F.lpad(F.col("c_custkey").cast("string"), 8, "0")).otherwise(
        F.col("c_custkey").cast("string")
    )
    return views.table(spark, sf, "customer").select(
        "c_custkey",
        S.pad_registrant_id(written).alias("padded"),
        S.unpad_registrant_id(S.pad_registrant_id(written)).alias("bare"),
    )


@query(
    "month_offset_by_tag",
    f"""SELECT l_orderkey, l_linenumber, {i('CASE WHEN l_linenumber % 5 < 3 THEN -(l_linenumber % 5) END', 'month_offset')},
      {d('''CAST(last_day(CAST(date_trunc('month', l_shipdate) - to_months(CAST(
        CASE WHEN l_linenumber % 5 < 3 THEN l_linenumber % 5 ELSE 0 END AS INTEGER)) AS DATE)) AS DATE)''', 'month_end')}
      FROM lineitem""",
)
def month_offset_by_tag(spark, sf):
    tag = F.concat(F.lit("x:MonthlyReturn"), (F.col("l_linenumber") % 5 + 1).cast("string"))
    offset = S.tag_month_offset(tag)
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        offset.alias("month_offset"),
        S.month_end_shift(F.to_date("l_shipdate"), F.coalesce(offset, F.lit(0))).alias("month_end"),
    )


@query(
    "first_available_column",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, cik, {r('total_investments', 'total net assets', 4)},
      {r('avg_tax', 'expense ratio', 4)}, {r('sales + reinvest - redemptions', 'flows', 4)},
      CAST(NULL AS DOUBLE) AS "R2" FROM panel"""),
    digits=4,
)
def first_available_column(spark, sf):
    etl = timeseries.net_flow(views.panel(spark, sf)).withColumnRenamed("avg_tax", "net_expense_ratio")
    found = profile.first_available_columns(etl)
    return found.select("class_id", "month_end", "cik", "total net assets", "expense ratio", "flows", "R2")


@query(
    "paper_column_names",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, {r('total_investments', 'total net assets', 4)},
      {r('sales + reinvest - redemptions', 'flows', 4)}, {r('avg_tax', 'expense ratio', 4)} FROM panel"""),
    digits=4,
)
def paper_column_names(spark, sf):
    etl = timeseries.net_flow(views.panel(spark, sf)).withColumnRenamed("avg_tax", "net_expense_ratio")
    return profile.paper_column_names(
        etl.select("class_id", "month_end", "total_investments", "net_flow", "net_expense_ratio")
    )


@query(
    "typed_null_columns",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, {r('total_investments', digits=4)},
      CAST(NULL AS DOUBLE) AS net_expense_ratio, CAST(NULL AS DOUBLE) AS turnover_pct FROM panel"""),
    digits=4,
)
def typed_null_columns(spark, sf):
    narrow = views.panel(spark, sf).select("class_id", "month_end", "total_investments")
    return profile.typed_null_columns(narrow, ["total_investments", "net_expense_ratio", "turnover_pct"])


@query(
    "filter_valid_classes",
    over(["panel"], f"""SELECT class_id, series_id, {d('month_end')} FROM panel
      WHERE series_id IN (SELECT 'S' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') FROM nation WHERE n_regionkey < 2)"""),
)
def filter_valid_classes(spark, sf):
    mapping = views.expense_ratios(spark, sf).select("class_id", "series_id")
    nation = views.table(spark, sf, "nation").where("n_regionkey < 2")
    series = nation.select(views.series_key("n_nationkey").alias("series_id"))
    panel = views.panel(spark, sf).select("class_id", "series_id", "month_end")
    return joins.filter_valid_classes(panel, mapping, series)


def stored_returns(spark, sf):
    """The returns database as files: one folder a year, sorted by registrant and class."""
    rows = views.panel(spark, sf).select("class_id", "cik", "month_end", "return")
    path = sinks.sink_sorted(
        rows.withColumn("year", F.year("month_end")), staging_path(spark, "returns_db"), "year", ["cik", "class_id"]
    )
    return spark.read.parquet(path)


@query(
    "lookup_fund_returns",
    over(["panel"], f"""SELECT class_id, cik, {d('month_end')}, {r('"return"', 'return')} FROM panel
      WHERE cik = '0000000003' AND month_end BETWEEN DATE '1996-02-29' AND DATE '2000-01-31'"""),
)
def lookup_fund_returns(spark, sf):
    db = stored_returns(spark, sf)
    found = joins.lookup_fund_returns(db, cik="3", start="1996-02-29", end="2000-01-31")
    return found.select("class_id", "cik", "month_end", "return")


@query(
    "filter_single_fund",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, {r('"return"', 'return')} FROM panel
      WHERE class_id = 'C000000004'"""),
)
def filter_single_fund(spark, sf):
    stored = materialize(views.panel(spark, sf).select("class_id", "month_end", "return"))
    return joins.filter_single_fund(stored, "C000000004")


@query(
    "complete_case_filter",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, {r('"return"', 'return')}, {r('sales', digits=2)} FROM panel
      WHERE "return" IS NOT NULL AND sales IS NOT NULL AND redemptions IS NOT NULL"""),
    digits={"*": 6, "sales": 2},
)
def complete_case_filter(spark, sf):
    kept = stats.complete_case_filter(views.panel(spark, sf), ["return", "sales", "redemptions"])
    return kept.select("class_id", "month_end", "return", "sales")


@query(
    "finite_check",
    over(["panel"], """SELECT c AS "column", flag AS has_infinite FROM (SELECT
        coalesce(bool_or("return" > 0.095), FALSE) AS a, FALSE AS b FROM panel) t,
        LATERAL (SELECT unnest(['return', 'cash']) AS c, unnest([t.a, t.b]) AS flag)"""),
)
def finite_check(spark, sf):
    spiked = F.when(F.col("return") > 0.095, F.lit(float("inf"))).otherwise(F.col("return"))
    panel = views.panel(spark, sf).withColumn("return", spiked)
    return profile.infinite_columns(panel, ["return", "cash"])


@query(
    "extreme_return_flag",
    over(["filings"], """SELECT accession, "return" * 20 > 0.5 OR "return" * 20 < -0.5 AS is_extreme FROM filings
      WHERE "return" IS NOT NULL"""),
)
def extreme_return_flag(spark, sf):
    filed = views.filings(spark, sf).withColumn("scaled", F.col("return") * 20)
    return filed.where(F.col("scaled").isNotNull()).select("accession", S.extreme_return("scaled").alias("is_extreme"))


_GAPPED = ["class_id", "month_end", "return", "sales", "reinvest", "redemptions", "cash"]


@query(
    "row_missing_ratio_filter",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, {r('"return"', 'return')}, {r('sales', digits=2)},
      {r('reinvest', digits=2)}, {r('redemptions', digits=2)}, {r('cash', digits=2)} FROM panel
      WHERE (("return" IS NULL)::INT + (sales IS NULL)::INT + (reinvest IS NULL)::INT + (redemptions IS NULL)::INT
        + (cash IS NULL)::INT) / 7.0 <= 0.25"""),
    digits={"*": 2, "return": 6},
)
def row_missing_ratio_filter(spark, sf):
    return features.row_missing_ratio_filter(views.panel(spark, sf).select(*_GAPPED), 0.25)


@query(
    "net_flow",
    over(["panel"], f"""SELECT class_id, {d('month_end')}, {r('sales + reinvest - redemptions', 'net_flow', 2)}
      FROM panel"""),
    digits=2,
)
def net_flow(spark, sf):
    return timeseries.net_flow(views.panel(spark, sf)).select("class_id", "month_end", "net_flow")


@query(
    "prediction_error",
    over(["scored"], f"""SELECT class_id, {d('month_end')}, {r('predicted_alpha - actual_alpha', 'prediction_error', 10)},
      {r('abs(predicted_alpha - actual_alpha)', 'abs_error', 10)} FROM scored"""),
    digits=10,
)
def prediction_error(spark, sf):
    out = joins.prediction_error(views.predictions_vs_actual(spark, sf))
    return out.select("class_id", "month_end", "prediction_error", "abs_error")


@query(
    "value_added",
    over(["panel", "predictions", "expense_ratios"], f"""SELECT class_id, {d('month_end')},
      {r('tna_lag', digits=4)}, {r('(actual_alpha - ratio) * tna_lag', 'value_added', 3)} FROM (
        SELECT p.class_id, p.month_end, actual_alpha, ratio,
          lag(p.total_investments) OVER (PARTITION BY p.class_id ORDER BY p.month_end) AS tna_lag
        FROM panel p LEFT JOIN predictions q USING (class_id, month_end)
        LEFT JOIN (SELECT class_id, min(net_expense_ratio) AS ratio FROM expense_ratios GROUP BY 1) e USING (class_id))"""),
    digits={"tna_lag": 4, "value_added": 3},
)
def value_added(spark, sf):
    panel = materialize(views.scored_panel(spark, sf))
    alpha = panel.select("class_id", "month_end", F.col("actual_alpha").alias("alpha_hat"))
    assets = panel.select("class_id", "month_end", F.col("total_investments").alias("tna"))
    out = joins.value_added(
        panel.drop("actual_alpha").join(alpha, ["class_id", "month_end"], "left"),
        views.expense_ratios(spark, sf),
        assets,
    )
    return out.select("class_id", "month_end", "tna_lag", "value_added")
