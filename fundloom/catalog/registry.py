"""Registration of queries, presentation of results, and the SQL form of the views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame, digits: int | dict[str, int] = 6) -> DataFrame:
    """Doubles rounded, dates as text, integers as bigint: the form compared with SQL."""
    per_column = digits if isinstance(digits, dict) else {}
    default = per_column.get("*", 6) if per_column else digits
    shown = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), per_column.get(field.name, default))
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        shown.append(c.alias(field.name))
    return df.select(*shown)


def query(name: str, sql: str | None = None, digits: int | dict[str, int] = 6):
    """Register a query under `name` with the SQL it must agree with."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir), digits)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    """SQL for a rounded double without negative zero."""
    return f'round({expr}, {digits}) + 0.0::DOUBLE AS "{name or expr}"'


def d(expr: str, name: str | None = None) -> str:
    """SQL for a date as text."""
    return f'strftime({expr}, \'%Y-%m-%d\') AS "{name or expr}"'


def i(expr: str, name: str | None = None) -> str:
    """SQL for an integer."""
    return f'CAST({expr} AS BIGINT) AS "{name or expr}"'


VIEW_SQL: dict[str, str] = {}
VIEW_NEEDS: dict[str, list[str]] = {}


def view(name: str, sql: str, needs: list[str] | None = None) -> None:
    VIEW_SQL[name], VIEW_NEEDS[name] = sql, needs or []


def over(views: list[str], body: str, more: dict[str, str] | None = None) -> str:
    """SQL text: the named views and what they need, extra CTEs, then the body."""
    ordered: list[str] = []

    def visit(v: str) -> None:
        for n in VIEW_NEEDS[v]:
            visit(n)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        visit(v)
    ctes = [f"{v} AS ({VIEW_SQL[v]})" for v in ordered]
    ctes += [f"{n} AS ({s})" for n, s in (more or {}).items()]
    return ("WITH RECURSIVE " + ",\n".join(ctes) + "\n" if ctes else "") + body


view(
    "supplier_month",
    """SELECT l_suppkey, CAST(last_day(CAST(l_shipdate AS DATE)) AS DATE) AS month_end, count(*) AS n,
      sum(l_discount) AS sum_discount, sum(l_tax) AS sum_tax, sum(l_quantity) AS sum_quantity,
      round(sum(l_extendedprice * (1 - l_discount)), 4) AS net_price,
      round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END), 2) AS sales,
      round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS redemptions,
      round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 2) AS reinvest
    FROM lineitem GROUP BY 1, 2""",
)
view(
    "panel",
    """SELECT 'C' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS class_id,
      'S' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS series_id,
      lpad(CAST(s_nationkey AS VARCHAR), 10, '0') AS cik, month_end,
      CAST(month_end + 60 AS DATE) AS filing_date,
      CASE WHEN (l_suppkey * 7 + year(month_end) * 12 + month(month_end)) % 17 <> 0
        THEN round(sum_discount / n - sum_tax / n, 6) + 0.0::DOUBLE END AS "return",
      sales, reinvest, redemptions, net_price AS total_investments,
      CASE WHEN month(month_end) % 3 = 0 THEN sum_quantity END AS cash,
      round(sum_tax / n, 6) AS avg_tax, round(sum_discount / n, 6) AS avg_discount, n
    FROM supplier_month JOIN supplier ON l_suppkey = s_suppkey""",
    ["supplier_month"],
)
_GAP = "(CAST(class_id[2:] AS BIGINT) * 5 + year(month_end) * 12 + month(month_end)) % 29 <> 0"
view("gappy_panel", f"SELECT * FROM panel WHERE {_GAP}", ["panel"])
view(
    "factor_sums",
    "SELECT month_end, sum(n) AS n, sum(sum_discount) AS d, sum(sum_tax) AS t, "
    + ", ".join(
        f"sum(CASE WHEN n_regionkey = {k} THEN sum_discount - sum_tax END) AS s{k}, "
        f"sum(CASE WHEN n_regionkey = {k} THEN n END) AS n{k}"
        for k in range(5)
    )
    + """ FROM supplier_month JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON n_nationkey = s_nationkey GROUP BY 1""",
    ["supplier_month"],
)
view(
    "factors",
    """SELECT *, lag(MKT_RF) OVER (ORDER BY month_end) AS MOM FROM (
      SELECT month_end, round((d - t) / n - t / n / 100, 10) + 0.0::DOUBLE AS MKT_RF,
        round(s1 / n1 - s0 / n0, 10) + 0.0::DOUBLE AS SMB, round(s2 / n2 - s0 / n0, 10) + 0.0::DOUBLE AS HML,
        round(s3 / n3 - s0 / n0, 10) + 0.0::DOUBLE AS RMW, round(s4 / n4 - s0 / n0, 10) + 0.0::DOUBLE AS CMA,
        round(t / n / 100, 10) AS RF FROM factor_sums)""",
    ["factor_sums"],
)
view(
    "filings",
    """SELECT lpad(CAST(o_custkey % 25 AS VARCHAR), 10, '0') AS cik,
      'C' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS class_id,
      'S' || lpad(CAST(o_custkey % 25 AS VARCHAR), 4, '0') AS series_id,
      CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS month_end,
      CAST(o_orderdate AS DATE) AS filing_date,
      CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS report_period,
      CASE WHEN o_custkey % 13 <> 0 THEN o_totalprice / 1e7 END AS "return",
      o_orderkey AS accession, CAST(o_orderpriority[1] AS INTEGER) AS position
    FROM orders""",
)
view(
    "expense_ratios",
    """SELECT * FROM expense_first UNION ALL
      SELECT class_id, series_id, round(net_expense_ratio + 0.001, 8), turnover_pct, context_ref
      FROM expense_first WHERE class_id LIKE '%4'""",
    ["expense_first"],
)
view(
    "expense_first",
    """SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS class_id,
      'S' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS series_id,
      CASE WHEN s_suppkey % 7 <> 0 THEN round(abs(s_acctbal) / 1e6, 8) END AS net_expense_ratio,
      CASE WHEN s_suppkey % 3 <> 0 THEN round(s_nationkey / 100.0::DOUBLE + 0.1::DOUBLE, 4) END AS turnover_pct,
      'fund_level' AS context_ref FROM supplier""",
)
for _kind, _cls in (
    ("managers", "'C' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')"),
    ("managers_by_registrant", "CAST(NULL AS VARCHAR)"),
):
    view(
        _kind,
        f"""SELECT lpad(CAST(s_nationkey AS VARCHAR), 10, '0') AS cik, {_cls} AS class_id,
          CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 23 AS DOUBLE) END AS manager_tenure,
          round((s_suppkey % 41) / 2.0::DOUBLE, 1) AS fund_age, s_suppkey AS record FROM supplier""",
    )
view(
    "overrides",
    """SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS class_id, 0.0075::DOUBLE AS net_expense_ratio,
      4.0::DOUBLE AS manager_tenure, 12.5::DOUBLE AS fund_age FROM supplier WHERE s_suppkey % 2 = 0""",
)
FEATURE_SQL = {
    "alpha6_1mo_12m_lag_1": "alpha",
    "alpha6_tstat_lag_1": "alpha / nullif(spread, 0)",
    "mtna_lag_1": "tna",
    "exp_ratio_lag_1": "tax",
    "age_lag_1": "CAST(row_number() OVER h AS DOUBLE)",
    "flow_12m_lag_1": "sales - redemptions",
    "mgr_tenure_lag_1": "rows_",
    "turn_ratio_lag_1": "redemptions / nullif(tna, 0)",
    "flow_vol_12m_lag_1": "abs(sales - reinvest)",
    "value_added_12m_lag_1": "(alpha - tax) * tna",
    "beta_market_tstat_lag_1": "discount",
    "beta_profit_tstat_lag_1": "tax / nullif(tna, 0)",
    "beta_invest_tstat_lag_1": "cash",
    "beta_size_tstat_lag_1": "spread",
    "beta_value_tstat_lag_1": "discount * discount",
    "beta_mom_tstat_lag_1": "alpha - lag(alpha) OVER h",
    "R2_lag_1": "known / nullif(rows_, 0)",
}
view(
    "quarterly",
    """SELECT class_id AS fundno,
      CAST(last_day(CAST(date_trunc('quarter', month_end) + INTERVAL 2 MONTH AS DATE)) AS DATE) AS quarter_end,
      round(avg("return"), 9) + 0.0::DOUBLE AS alpha,
      max("return") - min("return") AS spread,
      round(avg(total_investments), 5) / 1e6 AS tna, round(avg(avg_tax), 9) AS tax,
      round(avg(avg_discount), 9) AS discount, round(sum(sales), 2) / 1e6 AS sales,
      round(sum(redemptions), 2) / 1e6 AS redemptions, round(sum(reinvest), 2) / 1e6 AS reinvest,
      sum(cash) / 1e3 AS cash, CAST(sum(n) AS DOUBLE) AS rows_,
      CAST(count("return") AS DOUBLE) AS known FROM panel GROUP BY 1, 2""",
    ["panel"],
)
view(
    "quarterly_values",
    "SELECT fundno, quarter_end, alpha, "
    + ", ".join(f'{e} AS "now_{f}"' for f, e in FEATURE_SQL.items())
    + " FROM quarterly WINDOW h AS (PARTITION BY fundno ORDER BY quarter_end)",
    ["quarterly"],
)
view(
    "characteristics",
    "SELECT fundno, strftime(quarter_end, '%Y%m') AS \"Date\", alpha AS alpha6_1mo_12m, "
    + ", ".join(f'lag("now_{f}") OVER h AS "{f}"' for f in FEATURE_SQL)
    + " FROM quarterly_values WINDOW h AS (PARTITION BY fundno ORDER BY quarter_end)",
    ["quarterly_values"],
)
view(
    "training_rows",
    "SELECT * FROM characteristics WHERE alpha6_1mo_12m IS NOT NULL AND "
    + " AND ".join(f'"{f}" IS NOT NULL' for f in FEATURE_SQL),
    ["characteristics"],
)
view(
    "returns",
    """SELECT class_id AS fundno, CAST(date_trunc('month', month_end) AS DATE) AS "Date",
      "return" AS mret FROM panel""",
    ["panel"],
)
view(
    "predictions",
    """SELECT *, (xgb_prediction + rf_prediction) / 2 AS ensemble_prediction FROM (
      SELECT class_id, month_end, cik, "return",
        round(avg("return") OVER (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 9)
          + 0.0::DOUBLE AS xgb_prediction,
        round(avg("return") OVER (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 9)
          + 0.0::DOUBLE AS rf_prediction,
        CASE WHEN count(CASE WHEN "return" - RF IS NOT NULL AND MKT_RF IS NOT NULL THEN 1 END) OVER y >= 8
          THEN round(regr_intercept("return" - RF, MKT_RF) OVER y, 9) + 0.0::DOUBLE END AS actual_alpha
      FROM panel LEFT JOIN factors USING (month_end)
      WINDOW y AS (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))""",
    ["panel", "factors"],
)
view(
    "scored",
    """SELECT class_id, month_end, ensemble_prediction AS predicted_alpha, actual_alpha,
      xgb_prediction, rf_prediction FROM predictions WHERE ensemble_prediction IS NOT NULL""",
    ["predictions"],
)
view(
    "audited_panel",
    """SELECT panel.*, actual_alpha AS "realized alpha", MKT_RF, SMB, HML, RMW, CMA, RF, MOM
      FROM panel LEFT JOIN predictions USING (class_id, month_end)
      LEFT JOIN factors USING (month_end)""",
    ["panel", "factors", "predictions"],
)
view("gappy_audit", f"SELECT * FROM audited_panel WHERE {_GAP}", ["audited_panel"])
