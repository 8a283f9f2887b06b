"""The class-month job: filings to a panel with flows, regressions and side data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fundloom.operators import dedup, joins, profile, regression, timeseries


def class_month_facts(filed: DataFrame, tie: str) -> DataFrame:
    """Latest filing per class and month with net flow and its volatility."""
    return timeseries.rolling_flow_volatility(timeseries.net_flow(dedup.dedup_latest_filing(filed, tie)))


def build_panel(
    filed: DataFrame,
    factors: DataFrame,
    expenses: DataFrame | None = None,
    managers: DataFrame | None = None,
    manual: DataFrame | None = None,
    stored_returns: DataFrame | None = None,
    extra_months: int = 0,
    classes: DataFrame | None = None,
    fees: DataFrame | None = None,
    tie: str = "filing_date",
    regression_factors: Sequence[str] = tuple(regression.FACTORS),
    window: int = 36,
    min_obs: int = 30,
) -> DataFrame:
    """Filings to the published panel.

    After deduplication one shuffle and sort by class serve the flow volatility, the lagged assets and the
    regression sums; the factors are broadcast and keep that layout. The lag of the fitted alpha needs a
    second one, as a Python step hides the layout of its input. Side tables are joined last; the columns of
    those that are not given are null, so the schema is always the same; `managers` are given or what
    `sources.managers.manager_records` reads from prospectuses. `classes` (class_id) are the ones
    configured, and only those are kept; `fees` (class_id and more) is a file of fees joined by class.
    """
    if classes is not None:
        filed = filed.join(classes.select("class_id").distinct(), "class_id", "left_semi")
    facts = class_month_facts(filed, tie)
    if stored_returns is not None:
        facts = joins.outer_merge_returns(facts, stored_returns, extra_months)
    windowed = joins.join_factors(timeseries.lag_tna(facts), factors)
    fitted = regression.with_factor_regression(windowed, regression_factors, window, min_obs)
    lagged = timeseries.lag_realized_alpha(fitted)
    sided = lagged if expenses is None else joins.join_expense_by_class(lagged, expenses)
    sided = sided if managers is None else joins.join_manager(sided, managers)
    sided = profile.typed_null_columns(sided, joins.OVERRIDABLE)
    if manual is not None:
        sided = joins.apply_overrides(sided, manual)
    if fees is not None:
        sided = joins.join_fee_overrides(sided, fees)
    if expenses is not None:
        sided = joins.join_turnover_by_series(sided, expenses)
    sided = profile.typed_null_columns(sided, ["turnover_pct"])
    return profile.paper_column_names(joins.value_added_of(sided))


def still_missing(panel: DataFrame) -> DataFrame:
    """The classes of a published panel that lack an expense ratio, tenure or age, to be filled by hand."""
    known = panel.withColumnsRenamed({v: k for k, v in profile.PAPER_NAMES.items() if k in joins.OVERRIDABLE})
    return joins.missing_data_template(known)
