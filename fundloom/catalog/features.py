"""Feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, over, query, r
from fundloom.operators import features, joins, timeseries
from fundloom.operators.profile import FEATURE_ALIASES
from fundloom.plans import views
from fundloom.session import materialize

FRAME = ["return", "sales", "reinvest", "redemptions", "cash"]
KEYS = f"class_id, {d('month_end')}"
DIGITS = {"return": 9, "*": 4}


def _frame(spark, sf):
    """The panel's measures, materialized: the operators read them for statistics and for the result."""
    return materialize(views.panel(spark, sf).select("class_id", "month_end", *FRAME))


def _each(expr: str, digits: int | None = None) -> str:
    return ", ".join(
        r(expr.replace("$", f'"{c}"'), c, digits if digits is not None else DIGITS.get(c, 4)) for c in FRAME
    )


def _scalars(expr: str, source: str = "panel") -> str:
    """One row of an aggregate per column, named s_<column>."""
    return "SELECT " + ", ".join(
        expr.replace("$", f'"{c}"').replace("@", f"s_{c}") for c in FRAME
    ) + f" FROM {source}"


@query(
    "fit_feature_stats",
    over(["panel"], " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, {r(f'avg("{c}")', 'mean', 6)}, {r(f'stddev_samp("{c}")', 'std', 5)},
        {r(f'quantile_cont("{c}", 0.5)', 'median', 6)}, {r(f'quantile_cont("{c}", 0.25)', 'q25', 6)},
        {r(f'quantile_cont("{c}", 0.75)', 'q75', 6)}, {r(f'min("{c}")', 'min', 6)}, {r(f'max("{c}")', 'max', 6)} FROM panel"""
        for c in FRAME) + """ UNION ALL SELECT 'unknown', 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0"""),
    digits={"*": 6, "std": 5},
)
def fit_feature_stats(spark, sf):
    frame = _frame(spark, sf).withColumn("unknown", F.lit(None).cast("double"))
    return features.fit_feature_stats(frame, [*FRAME, "unknown"])


def _imputed(aggregate: str) -> str:
    out = ", ".join(r(f'coalesce("{c}", s_{c})', c, DIGITS.get(c, 4)) for c in FRAME)
    return over(["panel"], f"SELECT {KEYS}, {out} FROM panel, s", {"s": _scalars(f"{aggregate} AS @")})


@query("impute_median", _imputed("quantile_cont($, 0.5)"), digits=DIGITS)
def impute_median(spark, sf):
    return features.impute_median(_frame(spark, sf), FRAME)


@query("impute_mean", _imputed("avg($)"), digits=DIGITS)
def impute_mean(spark, sf):
    return features.impute_mean(_frame(spark, sf), FRAME)


@query(
    "impute_forward",
    over(["panel"], f"""SELECT {KEYS}, {_each('last_value($ IGNORE NULLS) OVER past')} FROM panel
      WINDOW past AS (PARTITION BY class_id ORDER BY panel.month_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    digits=DIGITS,
)
def impute_forward(spark, sf):
    return features.impute_forward(_frame(spark, sf), FRAME)


def _clipped(low: str, high: str, bounds: str) -> str:
    out = ", ".join(
        r(f'CASE WHEN "{c}" IS NOT NULL THEN least(greatest("{c}", {low.replace("@", c)}), {high.replace("@", c)}) END',
          c, DIGITS.get(c, 4))
        for c in FRAME
    )
    return over(["panel"], f"SELECT {KEYS}, {out} FROM panel, s", {"s": _scalars(bounds)})


@query(
    "winsorize",
    _clipped("s_@_lo", "s_@_hi", "quantile_cont($, 0.01) AS @_lo, quantile_cont($, 0.99) AS @_hi"),
    digits=DIGITS,
)
def winsorize(spark, sf):
    return features.winsorize(_frame(spark, sf), FRAME)


@query(
    "clip_iqr",
    _clipped(
        "(s_@_lo - 1.5 * (s_@_hi - s_@_lo))", "(s_@_hi + 1.5 * (s_@_hi - s_@_lo))",
        "quantile_cont($, 0.25) AS @_lo, quantile_cont($, 0.75) AS @_hi",
    ),
    digits=DIGITS,
)
def clip_iqr(spark, sf):
    return features.clip_iqr(_frame(spark, sf), FRAME)


_Z = {
    f"z{k}": f"""SELECT * FROM {'panel' if k == 0 else f'z{k - 1}'} WHERE "{c}" IS NULL OR
      abs(("{c}" - (SELECT avg("{c}") FROM {'panel' if k == 0 else f'z{k - 1}'}))
        / (SELECT stddev_pop("{c}") FROM {'panel' if k == 0 else f'z{k - 1}'})) < 2"""
    for k, c in enumerate(FRAME)
}


@query(
    "remove_outliers_z",
    over(["panel"], f"SELECT {KEYS}, {_each('$')} FROM z{len(FRAME) - 1}", _Z),
    digits=DIGITS,
)
def remove_outliers_z(spark, sf):
    """With the limit at 2, so that several features remove rows the later ones no longer see."""
    return features.remove_outliers_z(_frame(spark, sf), FRAME, limit=2.0)


@query(
    "standardize",
    over(["panel"], f"""SELECT {KEYS}, {", ".join(r(f'("{c}" - s_{c}_m) / s_{c}_s', c, 6) for c in FRAME)}
      FROM panel, s""", {"s": _scalars("avg($) AS @_m, stddev_samp($) AS @_s")}),
    digits=6,
)
def standardize(spark, sf):
    return features.standardize(_frame(spark, sf), FRAME)


_KNOWN = {
    "realized alpha": "actual_alpha", "total net assets": "total_investments", "expense ratio": "avg_tax",
    "flows": "sales + reinvest - redemptions", "age": "cash",
}
_COLS = list(_KNOWN)



@query(
    "prepare_features",
    over(
        ["panel", "predictions"],
        f"SELECT {KEYS}, cik, "
        + ", ".join(
            r(f"CASE WHEN d{_COLS.index(f)} > 0 THEN (x{_COLS.index(f)} - m{_COLS.index(f)}) / d{_COLS.index(f)} "
              f"ELSE x{_COLS.index(f)} END", f, 5) if f in _KNOWN else f'0.0::DOUBLE AS "{f}"'
            for f in FEATURE_ALIASES
        )
        + " FROM clipped, moments",
        {
            "raw": "SELECT p.class_id, p.month_end, p.cik, "
            + ", ".join(f"{e} AS x{k}" for k, e in enumerate(_KNOWN.values()))
            + " FROM panel p JOIN (SELECT class_id, month_end, actual_alpha FROM predictions) q USING (class_id, month_end)",
            "medians": "SELECT " + ", ".join(f"quantile_cont(x{k}, 0.5) AS m{k}" for k in range(5)) + " FROM raw",
            "filled": "SELECT class_id, month_end, cik, "
            + ", ".join(f"coalesce(x{k}, m{k}) AS x{k}" for k in range(5)) + " FROM raw, medians",
            "cuts": "SELECT " + ", ".join(
                f"quantile_cont(x{k}, 0.01) AS lo{k}, quantile_cont(x{k}, 0.99) AS hi{k}" for k in range(5))
            + " FROM filled",
            "clipped": "SELECT class_id, month_end, cik, "
            + ", ".join(f"least(greatest(x{k}, lo{k}), hi{k}) AS x{k}" for k in range(5)) + " FROM filled, cuts",
            "moments": "SELECT " + ", ".join(f"avg(x{k}) AS m{k}, stddev_samp(x{k}) AS d{k}" for k in range(5))
            + " FROM clipped",
        },
    ),
    digits=5,
)
def prepare_features(spark, sf):
    alpha = views.predictions(spark, sf).select(
        "class_id", "month_end", F.col("actual_alpha").alias("alpha_hat")
    )
    etl = timeseries.net_flow(views.panel(spark, sf)).withColumnsRenamed(
        {"avg_tax": "net_expense_ratio", "cash": "fund_age"}
    )
    return features.prepare_features(joins.join_regression_stats(etl, alpha))


@query(
    "prepare_pipeline",
    over(
        ["panel", "predictions"],
        """SELECT f.name AS "column", n_rows, round(CASE WHEN f.pos < 5 THEN missing[f.pos + 1] ELSE n_rows END / n_rows, 6) AS missing_ratio,
          false AS has_infinite, CASE WHEN n_rows < 30 THEN 'few rows'
            WHEN CASE WHEN f.pos < 5 THEN missing[f.pos + 1] ELSE n_rows END / n_rows > 0.5 THEN 'missing' END AS finding
        FROM counted, (VALUES """
        + ", ".join(f"('{f}', {_COLS.index(f) if f in _KNOWN else 99})" for f in FEATURE_ALIASES)
        + ") AS f(name, pos)",
        {
            "raw": "SELECT p.class_id, p.month_end, "
            + ", ".join(f"{e} AS x{k}" for k, e in enumerate(_KNOWN.values()))
            + " FROM panel p JOIN (SELECT class_id, month_end, actual_alpha FROM predictions) q USING (class_id, month_end)",
            "filled": "SELECT " + ", ".join(
                f"last_value(x{k} IGNORE NULLS) OVER (PARTITION BY class_id ORDER BY month_end) AS x{k}" for k in range(5))
            + " FROM raw",
            "counted": "SELECT count(*) AS n_rows, [" + ", ".join(f"count(*) - count(x{k})" for k in range(5)) + "] AS missing FROM filled",
        },
    ),
)
def prepare_pipeline(spark, sf):
    """The whole preparation with its validate step: features filled forward and scaled, and what they still lack."""
    alpha = views.predictions(spark, sf).select("class_id", "month_end", F.col("actual_alpha").alias("alpha_hat"))
    etl = timeseries.net_flow(views.panel(spark, sf)).withColumnsRenamed(
        {"avg_tax": "net_expense_ratio", "cash": "fund_age"}
    )
    prepared = features.prepare_features(joins.join_regression_stats(etl, alpha), "forward_fill", "none")
    return features.validation(prepared)
