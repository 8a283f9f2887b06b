"""Joins, set operations and spines."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, over, query, r, view
from fundloom.catalog.sources import quarters
from fundloom.functions.scalars import quarter_key
from fundloom.operators import dedup, joins, timeseries
from fundloom.plans import views
from fundloom.session import materialize

KEYS = f"class_id, {d('month_end')}"


@query(
    "join_factors",
    over(["panel", "factors"], f"""SELECT {KEYS}, {r('"return"', 'return')}, {r('MKT_RF', digits=10)},
      {r('MOM', digits=10)} FROM panel LEFT JOIN factors USING (month_end)"""),
    digits=10,
)
def join_factors(spark, sf):
    out = joins.join_factors(views.panel(spark, sf), views.factors(spark, sf))
    return out.select("class_id", "month_end", "return", "MKT_RF", "MOM")


@query("join_series_mapping", over(["panel"], f"SELECT {KEYS}, series_id FROM panel"))
def join_series_mapping(spark, sf):
    mapping = views.expense_ratios(spark, sf).select("class_id", "series_id")
    return joins.join_series_mapping(views.panel(spark, sf), mapping).select(
        "class_id", "month_end", "series_id"
    )


@query(
    "join_expense_by_class",
    over(["panel", "expense_ratios"], f"""SELECT one_per_class, {KEYS}, {r('net_expense_ratio', digits=8)} FROM (
      SELECT TRUE AS one_per_class, p.class_id, month_end, net_expense_ratio FROM panel p LEFT JOIN
        (SELECT class_id, min(net_expense_ratio) AS net_expense_ratio FROM expense_ratios GROUP BY 1) e USING (class_id)
      UNION ALL SELECT FALSE, p.class_id, month_end, e.net_expense_ratio FROM panel p LEFT JOIN
        (SELECT DISTINCT class_id, net_expense_ratio FROM expense_ratios WHERE net_expense_ratio IS NOT NULL) e
        USING (class_id))"""),
    digits=8,
)
def join_expense_by_class(spark, sf):
    panel = views.panel(spark, sf).select("class_id", "month_end")
    records = views.expense_ratios(spark, sf)
    one, many = [
        joins.join_expense_by_class(panel, records, single).withColumn("one_per_class", F.lit(single))
        for single in (True, False)
    ]
    return one.unionByName(many)


@query(
    "join_turnover_by_series",
    over(["panel", "expense_ratios"], f"""SELECT {KEYS}, series_id, {r('turnover_pct', digits=4)} FROM panel LEFT JOIN
      (SELECT series_id, min(turnover_pct) AS turnover_pct FROM expense_ratios GROUP BY 1) t USING (series_id)"""),
    digits=4,
)
def join_turnover_by_series(spark, sf):
    panel = views.panel(spark, sf).select("class_id", "month_end", "series_id")
    return joins.join_turnover_by_series(panel, views.expense_ratios(spark, sf))


@query(
    "join_manager_class_or_registrant",
    over(["panel", "managers", "managers_by_registrant"], f"""SELECT by_class, {KEYS}, {r('manager_tenure')}, {r('fund_age')}
      FROM (SELECT TRUE AS by_class, class_id, month_end, manager_tenure, fund_age
        FROM panel LEFT JOIN (SELECT class_id, manager_tenure, fund_age FROM managers) m USING (class_id)
      UNION ALL SELECT FALSE, class_id, month_end, manager_tenure, fund_age FROM panel LEFT JOIN
        (SELECT cik, manager_tenure, fund_age FROM managers_by_registrant
         QUALIFY row_number() OVER (PARTITION BY cik ORDER BY record) = 1) m USING (cik))"""),
)
def join_manager_class_or_registrant(spark, sf):
    panel = views.panel(spark, sf).select("class_id", "month_end", "cik")
    shown = ["by_class", "class_id", "month_end", "manager_tenure", "fund_age"]
    one, other = [
        joins.join_manager(panel, views.managers(spark, sf, known))
        .withColumn("by_class", F.lit(known))
        .select(*shown)
        for known in (True, False)
    ]
    return one.unionByName(other)


@query(
    "join_regression_stats",
    over(["panel", "predictions"], f"""SELECT {KEYS}, {r('actual_alpha', 'alpha_hat', 9)} FROM panel LEFT JOIN
      (SELECT class_id, month_end, actual_alpha FROM predictions WHERE actual_alpha IS NOT NULL) s
      USING (class_id, month_end)"""),
    digits=9,
)
def join_regression_stats(spark, sf):
    stats = views.predictions(spark, sf).where("actual_alpha is not null").select(
        "class_id", "month_end", F.col("actual_alpha").alias("alpha_hat")
    )
    return joins.join_regression_stats(views.panel(spark, sf).select("class_id", "month_end"), stats)


def _with_expense(spark, sf):
    return joins.join_expense_by_class(
        views.panel(spark, sf).select("class_id", "month_end", "cik"), views.expense_ratios(spark, sf)
    )


view(
    "with_expense",
    """SELECT class_id, month_end, cik, net_expense_ratio FROM panel LEFT JOIN
      (SELECT class_id, min(net_expense_ratio) AS net_expense_ratio FROM expense_ratios GROUP BY 1) e
      USING (class_id)""",
    ["panel", "expense_ratios"],
)


@query(
    "join_fee_overrides",
    over(["with_expense", "overrides"], f"""SELECT {KEYS}, cik, {r('w.net_expense_ratio', 'net_expense_ratio_x', 8)},
      {r('o.net_expense_ratio', 'net_expense_ratio_y', 8)}, {r('manager_tenure')}, {r('fund_age')}
      FROM with_expense w LEFT JOIN overrides o USING (class_id)"""),
    digits=8,
)
def join_fee_overrides(spark, sf):
    return joins.join_fee_overrides(_with_expense(spark, sf), views.overrides(spark, sf))


def _overridable(spark, sf):
    return joins.join_manager(_with_expense(spark, sf), views.managers(spark, sf))


view(
    "overridable",
    """SELECT w.*, manager_tenure, fund_age FROM with_expense w LEFT JOIN
      (SELECT class_id, manager_tenure, fund_age FROM managers) m USING (class_id)""",
    ["with_expense", "managers"],
)


@query(
    "apply_overrides",
    over(["overridable", "overrides"], f"""SELECT {KEYS}, cik,
      {r('coalesce(p.net_expense_ratio, o.net_expense_ratio)', 'net_expense_ratio', 8)},
      {r('coalesce(p.manager_tenure, o.manager_tenure)', 'manager_tenure')},
      {r('coalesce(p.fund_age, o.fund_age)', 'fund_age')}
      FROM overridable p LEFT JOIN overrides o USING (class_id)"""),
    digits=8,
)
def apply_overrides(spark, sf):
    return joins.apply_overrides(_overridable(spark, sf), views.overrides(spark, sf))


@query(
    "missing_data_template",
    over(["overridable"], """SELECT * FROM (SELECT class_id, cik, bool_or(net_expense_ratio IS NULL) AS needs_net_expense_ratio,
      bool_or(manager_tenure IS NULL) AS needs_manager_tenure, bool_or(fund_age IS NULL) AS needs_fund_age
      FROM overridable GROUP BY 1, 2) WHERE needs_net_expense_ratio OR needs_manager_tenure OR needs_fund_age"""),
)
def missing_data_template(spark, sf):
    return joins.missing_data_template(_overridable(spark, sf))


@query(
    "join_num_sub",
    f"""SELECT l_orderkey + l_linenumber AS adsh, l_orderkey, l_linenumber AS line, o_custkey AS cik, {d('o_orderdate', 'period')},
      {d('o_orderdate + INTERVAL 60 DAY', 'filed')}
      FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem)
      LEFT JOIN orders ON l_orderkey + l_linenumber = o_orderkey""",
)
def join_num_sub(spark, sf):
    """Facts by a key that some submissions lack: the order after as many as the line has before it."""
    numbers = views.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") + F.col("l_linenumber")).alias("adsh"), F.col("l_orderkey"), F.col("l_linenumber").alias("line")
    )
    submissions = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("adsh"),
        F.col("o_custkey").alias("cik"),
        F.to_date("o_orderdate").alias("period"),
        F.date_add(F.to_date("o_orderdate"), 60).alias("filed"),
    )
    return joins.join_num_sub(numbers, submissions)


def _stored(spark, sf, base):
    """Stored returns: two months in three of the panel, shifted in value, and months the panel lacks."""
    at = views.month_number("month_end")
    return base.where((F.col("l_suppkey") + at) % 3 != 0).select(
        views.class_key("l_suppkey").alias("class_id"),
        "month_end",
        F.when(
            (F.col("l_suppkey") + at) % 5 != 0,
            F.round(F.col("sum_discount") / F.col("n"), 6) + F.lit(0.01),
        ).alias("return"),
    )


view(
    "stored",
    """SELECT 'C' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS class_id, month_end,
      CASE WHEN (l_suppkey + year(month_end) * 12 + month(month_end)) % 5 <> 0
        THEN round(sum_discount / n, 6) + 0.01::DOUBLE END AS "return"
      FROM supplier_month WHERE (l_suppkey + year(month_end) * 12 + month(month_end)) % 3 <> 0""",
    ["supplier_month"],
)


@query(
    "merge_returns_prefer_db",
    over(["panel", "stored"], f"""SELECT p.class_id, {d('p.month_end', 'month_end')},
      {r('coalesce(s."return", p."return")', 'return', 8)},
      CASE WHEN s."return" IS NULL THEN 'pilot' ELSE 'database' END AS return_source
      FROM panel p LEFT JOIN stored s ON p.class_id = s.class_id AND p.month_end = s.month_end"""),
    digits=8,
)
def merge_returns_prefer_db(spark, sf):
    base = materialize(views.supplier_month(spark, sf))
    panel = views.panel(spark, sf, base).select("class_id", "month_end", "return")
    return joins.merge_returns_prefer_db(panel, _stored(spark, sf, base))


@query(
    "outer_merge_returns",
    over(
        ["panel", "stored"],
        f"""SELECT class_id, {d('month_end')}, {r('ret', 'return', 8)},
          coalesce(last_value(cik IGNORE NULLS) OVER past, first_value(cik IGNORE NULLS) OVER future) AS cik,
          coalesce(last_value(series_id IGNORE NULLS) OVER past, first_value(series_id IGNORE NULLS) OVER future) AS series_id
          FROM merged
          WINDOW past AS (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            future AS (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        {
            "shifted": "SELECT * FROM panel",
            "reach": """SELECT class_id, CAST(min(month_end) - INTERVAL 7 MONTH AS DATE) AS since, max(month_end) AS until
              FROM shifted GROUP BY 1""",
            "inside": """SELECT s.* FROM stored s JOIN reach r ON s.class_id = r.class_id
              AND s.month_end BETWEEN r.since AND r.until""",
            "spine": """SELECT * FROM (SELECT class_id, since, until, CAST(last_day(unnest(generate_series(
                date_trunc('month', since), until, INTERVAL 1 MONTH))) AS DATE) AS month_end
              FROM reach WHERE class_id IN (SELECT class_id FROM inside)) WHERE month_end BETWEEN since AND until""",
            "added": """SELECT s.class_id, s.month_end, i."return" AS stored_return FROM spine s LEFT JOIN inside i
              USING (class_id, month_end)""",
            "merged": """SELECT coalesce(p.class_id, a.class_id) AS class_id, coalesce(p.month_end, a.month_end) AS month_end,
              coalesce(a.stored_return, p."return") AS ret, cik, series_id FROM shifted p FULL JOIN added a
              ON p.class_id = a.class_id AND p.month_end = a.month_end""",
        },
    ),
    digits=8,
)
def outer_merge_returns(spark, sf):
    base = materialize(views.supplier_month(spark, sf))
    narrow = views.panel(spark, sf, base).select("class_id", "month_end", "return", "cik", "series_id")
    return joins.outer_merge_returns(narrow, _stored(spark, sf, base), extra_months=7)


@query(
    "join_pred_actual_inner",
    over(["predictions"], f"""SELECT {KEYS}, {r('ensemble_prediction', 'predicted_alpha', 10)},
      {r('actual_alpha', digits=10)}, {r('ensemble_prediction - actual_alpha', 'prediction_error', 10)},
      {r('abs(ensemble_prediction - actual_alpha)', 'abs_error', 10)} FROM predictions"""),
    digits=10,
)
def join_pred_actual_inner(spark, sf):
    scored = materialize(views.scored_panel(spark, sf))
    return joins.join_pred_actual_inner(
        views.predictions(spark, sf, scored), views.audited_panel(spark, sf, scored)
    )


@query(
    "join_pred_panel_left",
    over(["predictions", "panel"], f"""SELECT {KEYS}, {r('ensemble_prediction', digits=10)},
      {r('total_investments', digits=4)}, series_id FROM predictions LEFT JOIN
      (SELECT class_id, month_end, total_investments, series_id FROM panel) p USING (class_id, month_end)"""),
    digits={"ensemble_prediction": 10, "total_investments": 4},
)
def join_pred_panel_left(spark, sf):
    out = joins.join_pred_panel_left(views.predictions(spark, sf), views.panel(spark, sf))
    return out.select("class_id", "month_end", "ensemble_prediction", "total_investments", "series_id")


SPINE_SQL = {
    "inside": """SELECT * FROM gappy_panel WHERE month_end BETWEEN DATE '1996-01-15' AND DATE '2001-03-31'""",
    "spine": """SELECT class_id, CAST(last_day(m) AS DATE) AS month_end FROM (SELECT DISTINCT class_id FROM inside),
      (SELECT unnest(generate_series(DATE '1996-01-01', DATE '2001-03-31', INTERVAL 1 MONTH)) AS m)""",
    "filled": """SELECT s.class_id, s.month_end, "return" AS ret FROM spine s LEFT JOIN inside USING (class_id, month_end)""",
}


def spine(spark, sf):
    returns = views.gappy(views.panel(spark, sf)).select("class_id", "month_end", "return")
    return joins.calendar_spine_fill(returns, "1996-01-15", "2001-03-31")


@query("calendar_spine_fill", over(["gappy_panel"], f"SELECT {KEYS}, {r('ret', 'return')} FROM filled", SPINE_SQL))
def calendar_spine_fill(spark, sf):
    return spine(spark, sf)


@query(
    "semi_funds_in_cross_section",
    over(["returns", "characteristics"], f"""SELECT fundno, {d('"Date"', 'Date')}, {r('mret')} FROM returns
      WHERE "Date" BETWEEN DATE '1998-01-01' AND DATE '1998-09-01' AND fundno IN (SELECT fundno FROM characteristics
        WHERE characteristics."Date" = '199809' AND alpha6_1mo_12m IS NOT NULL)"""),
)
def semi_funds_in_cross_section(spark, sf):
    section = views.characteristics(spark, sf).where(
        (F.col("Date") == "199809") & F.col(views.TARGET).isNotNull()
    )
    return joins.semi_funds_in_cross_section(views.returns(spark, sf), section, "1998-01-01", "1998-09-01")


@query(
    "semi_train_dates",
    over(["characteristics"], f"""SELECT fundno, "Date", {r('alpha6_1mo_12m', digits=9)} FROM characteristics
      WHERE "Date" < '199812' AND (SELECT count(DISTINCT "Date") FROM characteristics WHERE "Date" < '199812') >= 10"""),
    digits=9,
)
def semi_train_dates(spark, sf):
    chars = views.characteristics(spark, sf).select("fundno", "Date", views.TARGET)
    return timeseries.semi_train_dates(chars, "199812")


@query(
    "anti_processed_quarters",
    over(["quarters"], "SELECT quarter FROM quarters WHERE quarter NOT IN (SELECT DISTINCT year(o_orderdate) || 'q' || quarter(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-05-01')"),
)
def anti_processed_quarters(spark, sf):
    orders = views.table(spark, sf, "orders")
    early = orders.where(F.col("o_orderdate") < F.lit("1999-05-01").cast("timestamp"))
    return joins.anti_processed_quarters(quarters(spark, sf), early.select(quarter_key("o_orderdate").alias("quarter")).distinct())


@query(
    "anti_missing_months",
    over(["gappy_panel"], f"""SELECT class_id, {d('month_end')} FROM (
      SELECT class_id, CAST(last_day(unnest(generate_series(date_trunc('month', min(month_end)), max(month_end),
        INTERVAL 1 MONTH))) AS DATE) AS month_end FROM gappy_panel GROUP BY class_id)
      WHERE (class_id, month_end) NOT IN (SELECT (class_id, month_end) FROM gappy_panel)"""),
)
def anti_missing_months(spark, sf):
    return joins.anti_missing_months(views.gappy(views.panel(spark, sf)))


@query(
    "cross_series_class",
    """SELECT cik, series_id, class_id, tenure FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS cik,
        CAST(c_nationkey AS BIGINT) AS tenure,
        unnest(CASE WHEN c_custkey % 3 = 0 THEN [NULL] ELSE ['S' || c_custkey, 'S' || (c_custkey + 1)] END) AS series_id
      FROM customer), LATERAL (SELECT unnest(CASE WHEN c_custkey % 4 = 0 THEN [NULL]
        ELSE ['C1', 'C2', 'C3'] END) AS class_id)""",
)
def cross_series_class(spark, sf):
    key = F.col("c_custkey")
    series = F.array(F.concat(F.lit("S"), key.cast("string")), F.concat(F.lit("S"), (key + 1).cast("string")))
    funds = views.table(spark, sf, "customer").select(
        key.cast("string").alias("cik"),
        F.col("c_nationkey").alias("tenure"),
        F.when(key % 3 != 0, series).alias("series_ids"),
        F.when(key % 4 != 0, F.array(*[F.lit(c) for c in ("C1", "C2", "C3")]))
        .otherwise(F.array().cast("array<string>"))
        .alias("class_ids"),
    )
    return joins.cross_series_class(funds)


@query(
    "fill_ids_both_ways",
    over(
        ["panel"],
        f"""SELECT class_id, {d('month_end')}, coalesce(last_value(cik IGNORE NULLS) OVER past,
          first_value(cik IGNORE NULLS) OVER future) AS cik
          FROM (SELECT class_id, month_end, CASE WHEN month(month_end) IN (2, 5, 6, 11) THEN cik || '-' || month(month_end) END AS cik
            FROM panel)
          WINDOW past AS (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            future AS (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    ),
)
def fill_ids_both_ways(spark, sf):
    known = F.month("month_end").isin(2, 5, 6, 11)
    stamped = F.concat_ws("-", "cik", F.month("month_end").cast("string"))
    gaps = views.panel(spark, sf).select("class_id", "month_end", F.when(known, stamped).alias("cik"))
    return joins.fill_ids_both_ways(gaps, ["cik"])


@query(
    "union_filings",
    over(["filings", "panel"], f"""SELECT class_id, {d('month_end')}, {r('"return"', 'return', 10)}, accession,
      CAST(NULL AS DOUBLE) AS sales FROM filings UNION ALL
      SELECT class_id, {d('month_end')}, {r('"return"', 'return', 10)}, NULL, {r('sales', digits=2)} FROM panel"""),
    digits={"*": 10, "sales": 2},
)
def union_filings(spark, sf):
    filed = views.filings(spark, sf).select("class_id", "month_end", "return", "accession")
    panel = views.panel(spark, sf).select("class_id", "month_end", "return", "sales")
    return dedup.union_filings([filed, panel])


@query(
    "incremental_upsert",
    over(["filings"], f"""SELECT cik, class_id, {d('month_end')}, {d('filing_date')}, accession,
      {r('v', 'return', 10)} FROM (
        SELECT *, row_number() OVER (PARTITION BY cik, class_id, month_end ORDER BY filing_date DESC, accession DESC) AS pick
        FROM (SELECT *, "return" AS v FROM filings WHERE position <= 3 UNION ALL
          SELECT *, "return" + 1 AS v FROM filings WHERE position > 3)) WHERE pick = 1"""),
    digits=10,
)
def incremental_upsert(spark, sf):
    filed = views.filings(spark, sf)
    existing = filed.where("position <= 3")
    new = filed.where("position > 3").withColumn("return", F.col("return") + 1)
    out = dedup.incremental_upsert(existing, new)
    return out.select("cik", "class_id", "month_end", "filing_date", "accession", "return")


@query("distinct_pairs", over(["panel"], "SELECT DISTINCT class_id, series_id FROM panel"))
def distinct_pairs(spark, sf):
    return views.panel(spark, sf).select("class_id", "series_id").distinct()
