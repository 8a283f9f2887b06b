"""Windows over the months of a class."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.joins import SPINE_SQL, spine
from fundloom.catalog.registry import d, i, over, query, r
from fundloom.operators import joins, regression, timeseries
from fundloom.plans import views
from fundloom.session import materialize

KEYS = f"class_id, {d('month_end')}"
W = "OVER (PARTITION BY class_id ORDER BY month_end)"


@query(
    "lag_realized_alpha",
    over(["predictions"], f"""SELECT {KEYS}, {r('actual_alpha', 'alpha_hat', 10)},
      {r(f'lag(actual_alpha) {W}', 'realized_alpha_lagged', 10)} FROM predictions"""),
    digits=10,
)
def lag_realized_alpha(spark, sf):
    alpha = views.predictions(spark, sf).select(
        "class_id", "month_end", F.col("actual_alpha").alias("alpha_hat")
    )
    return timeseries.lag_realized_alpha(alpha)


@query(
    "lag_tna",
    over(["panel"], f"SELECT {KEYS}, {r(f'lag(total_investments) {W}', 'tna_lag', 4)} FROM panel"),
    digits=4,
)
def lag_tna(spark, sf):
    return timeseries.lag_tna(views.panel(spark, sf)).select("class_id", "month_end", "tna_lag")


FLOW_FRAME = "OVER (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"


@query(
    "rolling_flow_volatility",
    over(["panel"], f"""SELECT {KEYS}, {r('flow', 'net_flow', 2)},
      {r(f'CASE WHEN count(flow) {FLOW_FRAME} >= 3 THEN stddev_samp(flow) {FLOW_FRAME} END', 'vol_of_flows', 3)}
      FROM (SELECT *, sales + reinvest - redemptions AS flow FROM panel)"""),
    digits={"net_flow": 2, "vol_of_flows": 3},
)
def rolling_flow_volatility(spark, sf):
    out = timeseries.rolling_flow_volatility(timeseries.net_flow(views.panel(spark, sf)))
    return out.select("class_id", "month_end", "net_flow", "vol_of_flows")


@query(
    "panel_flows",
    over(["panel"], f"""SELECT {KEYS}, {r('flow', 'net_flow', 2)},
      {r(f'CASE WHEN count(flow) {FLOW_FRAME} >= 3 THEN stddev_samp(flow) {FLOW_FRAME} END', 'vol_of_flows', 3)},
      {r(f'lag(total_investments) {W}', 'tna_lag', 4)}
      FROM (SELECT *, sales + reinvest - redemptions AS flow FROM panel)"""),
    digits={"net_flow": 2, "vol_of_flows": 3, "tna_lag": 4},
)
def panel_flows(spark, sf):
    """Net flow, its volatility and lagged assets: all windows share one shuffle and one sort."""
    flows = timeseries.rolling_flow_volatility(timeseries.net_flow(views.panel(spark, sf)))
    return timeseries.lag_tna(flows).select("class_id", "month_end", "net_flow", "vol_of_flows", "tna_lag")


_ONE = "OVER (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)"


@query(
    "rolling_single_factor",
    over(["panel", "factors"], f"""SELECT {KEYS}, n_obs, {r('alpha_hat')}, {r('market_beta', digits=5)}, {r('"R2"', 'R2')} FROM (
      SELECT class_id, month_end, count(*) {_ONE} AS rows_, count(y) {_ONE} AS n_obs,
        regr_intercept(y, MKT_RF) {_ONE} AS alpha_hat, regr_slope(y, MKT_RF) {_ONE} AS market_beta,
        regr_r2(y, MKT_RF) {_ONE} AS "R2"
      FROM (SELECT *, "return" - RF AS y FROM panel LEFT JOIN factors USING (month_end)))
      WHERE rows_ >= 30 AND n_obs >= 30"""),
    digits={"*": 6, "market_beta": 5},
)
def rolling_single_factor(spark, sf):
    return regression.rolling_single_factor(
        _with_factors(spark, sf)
    )


def sweep_ctes(source: str, size: int, keep: str) -> dict[str, str]:
    """SQL for least squares on Gram columns g_a_b (a <= b) of [1, factors, y]: the sweep operator over all
    but the last row leaves coefficients in column y, minus the inverse in the block, the residual sum in (y, y)."""
    def g(a: int, b: int) -> str:
        return f"g_{min(a, b)}_{max(a, b)}"

    ctes, previous = {}, source
    for k in range(size - 1):
        cells = []
        for a in range(size):
            for b in range(a, size):
                if a == k and b == k:
                    e = f"-1 / {g(k, k)}"
                elif a == k or b == k:
                    e = f"{g(a, b)} / {g(k, k)}"
                else:
                    e = f"{g(a, b)} - {g(a, k)} * {g(k, b)} / {g(k, k)}"
                cells.append(f"{e} AS g_{a}_{b}")
        ctes[f"sweep{k}"] = f"SELECT {keep}, {', '.join(cells)} FROM {previous}"
        previous = f"sweep{k}"
    return ctes


def _with_factors(spark, sf):
    """The panel next to its factors; both come from one scan of the line items."""
    base = materialize(views.supplier_month(spark, sf))
    return joins.join_factors(views.panel(spark, sf, base), views.factors(spark, sf, base))


SIZE = len(regression.FACTORS) + 2
_TERMS = ["1.0::DOUBLE", *regression.FACTORS, '"return" - RF']
_READY = " AND ".join(f'"{c}" IS NOT NULL' for c in ["return", "RF", *regression.FACTORS])
_PAIRS = [(a, b) for a in range(SIZE) for b in range(a, SIZE)]
REGRESSION = {
    "joined": f"""SELECT class_id, month_end, {_READY} AS ok, {', '.join(f'{t} AS t{k}' for k, t in enumerate(_TERMS))}
      FROM panel LEFT JOIN factors USING (month_end)""",
    "moments": f"""SELECT class_id, month_end, count(*) {_ONE} AS rows_, count(CASE WHEN ok THEN 1 END) {_ONE} AS n_obs,
      {', '.join(f'sum(CASE WHEN ok THEN t{a} * t{b} END) {_ONE} AS g_{a}_{b}' for a, b in _PAIRS)} FROM joined""",
    "usable": """SELECT *, g_7_7 AS yy, g_0_7 AS sum_y FROM moments WHERE rows_ >= 30 AND n_obs >= 30""",
    **sweep_ctes("usable", SIZE, "class_id, month_end, n_obs, yy, sum_y"),
}
_S2 = f"(g_7_7 / (n_obs - {SIZE - 1}))"
STATS = ", ".join(
    ["g_0_7 AS alpha_hat", f"1 - g_7_7 / (yy - sum_y * sum_y / n_obs) AS \"R2\""]
    + [f"g_{k}_7 / sqrt({_S2} * -g_{k}_{k}) AS {name}" for k, name in enumerate(regression.OUTPUTS[1:-1])]
)

def regression_over(views_needed: list[str], body: str, more: dict[str, str] | None = None) -> str:
    return over(
        ["panel", "factors", *views_needed],
        body,
        {**REGRESSION, "stats": f"SELECT class_id, month_end, {STATS} FROM sweep{SIZE - 2}", **(more or {})},
    )


@query(
    "rolling_factor_regression",
    regression_over([], f"""SELECT {KEYS}, {r('alpha_hat')}, {r('"R2"', 'R2')}, """
                    + ", ".join(r(c, digits=4) for c in regression.OUTPUTS[1:-1]) + " FROM stats"),
    digits={"*": 4, "alpha_hat": 6, "R2": 6},
)
def rolling_factor_regression(spark, sf):
    return regression.rolling_factor_regression(_with_factors(spark, sf))


def _filled(sql: str) -> str:
    return over(["gappy_panel"], f"SELECT {KEYS}, {r(sql, 'return', 9)} FROM filled", SPINE_SQL)


_PAST = "OVER (PARTITION BY class_id ORDER BY month_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("fill_forward", _filled(f"last_value(ret IGNORE NULLS) {_PAST}"), digits=9)
def fill_forward(spark, sf):
    return timeseries.fill_forward(spine(spark, sf))


@query("fill_zero", _filled("coalesce(ret, 0)"), digits=9)
def fill_zero(spark, sf):
    return timeseries.fill_zero(spine(spark, sf))


_LINEAR = {
    **SPINE_SQL,
    "placed": "SELECT *, row_number() OVER (PARTITION BY class_id ORDER BY month_end) AS pos FROM filled",
    "neighbours": """SELECT p.class_id, p.month_end, p.pos, p.ret, (SELECT max(q.pos) FROM placed q WHERE
        q.class_id = p.class_id AND q.pos <= p.pos AND q.ret IS NOT NULL) AS before,
      (SELECT min(q.pos) FROM placed q WHERE q.class_id = p.class_id AND q.pos >= p.pos AND q.ret IS NOT NULL) AS after
      FROM placed p""",
    "ends": """SELECT n.*, b.ret AS v0, a.ret AS v1 FROM neighbours n
      LEFT JOIN placed b ON b.class_id = n.class_id AND b.pos = n.before
      LEFT JOIN placed a ON a.class_id = n.class_id AND a.pos = n.after""",
}
_LINE = "CASE WHEN after IS NULL THEN v0 ELSE v0 + (v1 - v0) * (pos - before) / (after - before) END"


@query(
    "fill_linear",
    over(["gappy_panel"], f"""SELECT {KEYS}, {r(f'coalesce(ret, {_LINE})', 'return', 9)},
      {r(f'coalesce(ret, CASE WHEN pos - before <= 1 THEN {_LINE} END)', 'limited', 9)} FROM ends""", _LINEAR),
    digits=9,
)
def fill_linear(spark, sf):
    """Unlimited and, next to it, at most one month after a known value."""
    both = spine(spark, sf).withColumn("limited", F.col("return"))
    return timeseries.fill_linear(timeseries.fill_linear(both), "limited", limit=1)


@query(
    "tna_roll_forward",
    over(
        ["panel"],
        f"SELECT {KEYS}, {r('tna', digits=1)} FROM rolled",
        {
            "ordered": """SELECT class_id, month_end, total_investments + cash AS anchor, "return" AS g,
              sales + reinvest - redemptions AS flow,
              row_number() OVER (PARTITION BY class_id ORDER BY month_end) AS pos FROM panel""",
            "rolled": """SELECT class_id, month_end, pos, anchor AS tna FROM ordered WHERE pos = 1 UNION ALL
              SELECT o.class_id, o.month_end, o.pos, coalesce(o.anchor, p.tna * (1 + o.g) + o.flow, p.tna)
              FROM rolled p JOIN ordered o ON o.class_id = p.class_id AND o.pos = p.pos + 1""",
        },
    ),
    digits=1,
)
def tna_roll_forward(spark, sf):
    return timeseries.tna_roll_forward(timeseries.net_flow(views.panel(spark, sf)))


@query(
    "expanding_train_window",
    over(["characteristics"], f"""SELECT f."Date" AS formation_date, {i('f.idx', 'formation_idx')}, t."Date", {i('t.idx', 'idx')}
      FROM dates f JOIN dates t ON t.idx < f.idx WHERE f.idx >= 10""",
      {"dates": 'SELECT "Date", row_number() OVER (ORDER BY "Date") - 1 AS idx FROM (SELECT DISTINCT "Date" FROM characteristics)'}),
)
def expanding_train_window(spark, sf):
    return timeseries.expanding_train_window(views.characteristics(spark, sf).select("Date").distinct())
