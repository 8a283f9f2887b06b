"""Joins of the panel with its side tables.

Sides that grow with the data are never hinted; adaptive execution broadcasts them when their measured
size allows. Only the monthly factor series, one row per calendar month, carries a broadcast hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.functions.scalars import col, null_double, pad_registrant_id


def join_factors(panel: DataFrame, factors: DataFrame) -> DataFrame:
    return panel.join(F.broadcast(factors), "month_end", "left")


def join_series_mapping(panel: DataFrame, mapping: DataFrame) -> DataFrame:
    """Stamp each row with the series of its class."""
    known = mapping.groupBy("class_id").agg(F.min("series_id").alias("series_id"))
    return panel.drop("series_id").join(known, "class_id", "left")


def filter_valid_classes(panel: DataFrame, mapping: DataFrame, series: DataFrame) -> DataFrame:
    """Rows whose class belongs to a configured series; without any such class nothing is filtered."""
    valid = mapping.join(series, "series_id", "left_semi").select("class_id").distinct()
    if valid.isEmpty():
        return panel
    return panel.join(valid, "class_id", "left_semi")


def join_known_values(
    panel: DataFrame, records: DataFrame, key: str, value: str, one_per_key: bool = True
) -> DataFrame:
    """Left join the distinct known (key, value) pairs; several values of a key keep the smallest,
    or multiply the rows when `one_per_key` is off."""
    known = records.where(col(key).isNotNull() & col(value).isNotNull()).select(key, value)
    side = known.groupBy(key).agg(F.min(value).alias(value)) if one_per_key else known.distinct()
    return panel.join(side, key, "left")


def join_expense_by_class(panel: DataFrame, records: DataFrame, one_per_class: bool = True) -> DataFrame:
    return join_known_values(panel, records, "class_id", "net_expense_ratio", one_per_class)


def join_turnover_by_series(panel: DataFrame, records: DataFrame, one_per_series: bool = True) -> DataFrame:
    return join_known_values(panel, records, "series_id", "turnover_pct", one_per_series)


def join_manager(panel: DataFrame, managers: DataFrame, order: Sequence[str] = ("record",)) -> DataFrame:
    """By class when any class is known, else the first record of the registrant for all its classes."""
    values = ["manager_tenure", "fund_age"]
    any_class = managers.agg(F.max(F.col("class_id").isNotNull()).alias("any")).first()["any"]
    if any_class:
        return panel.join(managers.select("class_id", *values), "class_id", "left")
    first = managers.groupBy("cik").agg(
        F.min_by(F.struct(*values), F.struct(*order)).alias("v")
    )
    return panel.join(first.select("cik", "v.*"), "cik", "left")


def join_regression_stats(panel: DataFrame, stats: DataFrame) -> DataFrame:
    return panel.join(stats, ["class_id", "month_end"], "left")


def join_fee_overrides(panel: DataFrame, fees: DataFrame) -> DataFrame:
    """Left join on class; columns on both sides get the suffixes _x (panel) and _y (fees)."""
    shared = [c for c in fees.columns if c in panel.columns and c != "class_id"]
    left = panel.withColumnsRenamed({c: f"{c}_x" for c in shared})
    return left.join(fees.withColumnsRenamed({c: f"{c}_y" for c in shared}), "class_id", "left")


OVERRIDABLE = ["net_expense_ratio", "manager_tenure", "fund_age"]


def apply_overrides(panel: DataFrame, manual: DataFrame) -> DataFrame:
    """Fill what is missing, and only that, from the manual table."""
    side = manual.select("class_id", *[F.col(c).alias(f"manual_{c}") for c in OVERRIDABLE])
    return (
        panel.join(side, "class_id", "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"manual_{c}")) for c in OVERRIDABLE})
        .drop(*[f"manual_{c}" for c in OVERRIDABLE])
    )


def missing_data_template(panel: DataFrame) -> DataFrame:
    """Classes with a value still missing, and which ones."""
    missing = [F.max(F.col(c).isNull()).alias(f"needs_{c}") for c in OVERRIDABLE]
    per_class = panel.groupBy("class_id", "cik").agg(*missing)
    return per_class.where(" or ".join(f"needs_{c}" for c in OVERRIDABLE))


def join_num_sub(numbers: DataFrame, submissions: DataFrame) -> DataFrame:
    return numbers.join(submissions.select("adsh", "cik", "period", "filed"), "adsh", "left")


def merge_returns_prefer_db(panel: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored returns win over the panel's own, and the source of each row is named."""
    side = stored.select("class_id", "month_end", F.col("return").alias("stored_return"))
    has = F.col("stored_return").isNotNull()
    return (
        panel.join(side, ["class_id", "month_end"], "left")
        .withColumn("return_source", F.when(has, F.lit("database")).otherwise(F.lit("pilot")))
        .withColumn("return", F.coalesce("stored_return", "return"))
        .drop("stored_return")
    )


def outer_merge_returns(panel: DataFrame, stored: DataFrame, extra_months: int) -> DataFrame:
    """Full outer join per class with the stored series on the complete month ends from `extra_months`
    before its first month to its last, for classes with any stored month there; stored returns win and
    the ids of added months come from the neighbouring rows."""
    reach = panel.groupBy("class_id").agg(
        F.add_months(F.min("month_end"), -extra_months).alias("since"),
        F.max("month_end").alias("until"),
    )
    in_reach = (
        stored.join(reach, "class_id")
        .where(F.col("month_end").between(F.col("since"), F.col("until")))
        .select("class_id", "month_end", F.col("return").alias("stored_return"))
    )
    served = reach.join(in_reach.select("class_id").distinct(), "class_id", "left_semi")
    window_of = calendar_spine(served, F.col("since"), F.col("until")).join(
        in_reach, ["class_id", "month_end"], "left"
    )
    merged = panel.join(window_of, ["class_id", "month_end"], "full_outer")
    merged = merged.withColumn("return", F.coalesce("stored_return", "return")).drop("stored_return")
    return fill_ids_both_ways(merged, ["cik", "series_id"])


def fill_ids_both_ways(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Forward then backward fill within a class in month order."""
    by_month = Window.partitionBy("class_id").orderBy("month_end")
    past = by_month.rowsBetween(Window.unboundedPreceding, 0)
    future = by_month.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(future)
            )
            for c in ids
        }
    )


def join_pred_actual_inner(pred: DataFrame, panel: DataFrame) -> DataFrame:
    """Predictions next to the realised alpha of the same class and month, with the error."""
    actual = panel.select("class_id", "month_end", F.col("realized alpha").alias("actual_alpha"))
    chosen = pred.select("class_id", "month_end", F.col("ensemble_prediction").alias("predicted_alpha"))
    return prediction_error(chosen.join(actual, ["class_id", "month_end"]))


def prediction_error(df: DataFrame) -> DataFrame:
    error = F.col("predicted_alpha") - F.col("actual_alpha")
    return df.withColumns({"prediction_error": error, "abs_error": F.abs(error)})


def join_pred_panel_left(pred: DataFrame, panel: DataFrame) -> DataFrame:
    clash = [c for c in panel.columns if c in pred.columns and c not in ("class_id", "month_end")]
    return pred.join(panel.drop(*clash), ["class_id", "month_end"], "left")


def calendar_spine(classes: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every month end in [start, end] for every class; `start` and `end` may vary by class."""
    first = F.trunc(start, "MM")
    months = F.filter(
        F.transform(F.sequence(first, F.greatest(end, first), F.expr("interval 1 month")), F.last_day),
        lambda m: (m >= start) & (m <= end),
    )
    return classes.select("class_id", F.explode(months).alias("month_end"))


def calendar_spine_fill(returns: DataFrame, start: str, end: str) -> DataFrame:
    """Returns of every class on the complete month-end spine; months without a row get null."""
    since, until = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = returns.where(F.col("month_end").between(since, until))
    spine = calendar_spine(inside.select("class_id").distinct(), since, until)
    return spine.join(inside, ["class_id", "month_end"], "left")


def semi_funds_in_cross_section(
    returns: DataFrame, cross_section: DataFrame, start: str, end: str
) -> DataFrame:
    in_range = returns.where(
        F.col("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    return in_range.join(cross_section.select("fundno").distinct(), "fundno", "left_semi")


def anti_missing_months(panel: DataFrame) -> DataFrame:
    """Months between a fund's first and last that have no row."""
    reach = panel.groupBy("class_id").agg(
        F.min("month_end").alias("first"), F.max("month_end").alias("last")
    )
    spine = calendar_spine(reach, F.col("first"), F.col("last"))
    return spine.join(panel.select("class_id", "month_end"), ["class_id", "month_end"], "left_anti")


def anti_processed_quarters(available: DataFrame, processed: DataFrame) -> DataFrame:
    return available.join(processed, "quarter", "left_anti")


def cross_series_class(funds: DataFrame) -> DataFrame:
    """A fund's value for each pair of its series and classes; a missing list counts as one null."""
    def or_null(c: str) -> Column:
        return F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit(None).cast("string")))

    return (
        funds.withColumn("series_id", F.explode(or_null("series_ids")))
        .withColumn("class_id", F.explode(or_null("class_ids")))
        .drop("series_ids", "class_ids")
    )


def fund_level_fallback(requested: DataFrame, records: DataFrame) -> DataFrame:
    """Values of the requested classes found in a document; a document without any of them gives its
    fund-level value to all requested classes."""
    values = ["net_expense_ratio", "turnover_pct"]
    own = requested.join(
        records.where(F.col("class_id").isNotNull()).select("doc_id", "class_id", *values),
        ["doc_id", "class_id"],
    )
    served = own.select("doc_id").distinct()
    fund = (
        records.where(F.col("context_ref") == "fund_level")
        .groupBy("doc_id")
        .agg(*[F.min(v).alias(v) for v in values])
    )
    rest = requested.join(served, "doc_id", "left_anti").join(fund, "doc_id")
    return own.unionByName(rest)


def context_join_facts(facts: DataFrame) -> DataFrame:
    """Facts (doc_id, context_ref, kind, text_value, value, position) to one record per context; the
    later fact of a kind wins, and a context needs at least one numeric value."""
    def latest(kind: str, value: str) -> Column:
        known = (F.col("kind") == kind) & F.col(value).isNotNull()
        return F.max_by(F.when(known, F.col(value)), F.when(known, F.col("position")))

    return (
        facts.where(F.col("context_ref").isNotNull())
        .groupBy("doc_id", "context_ref")
        .agg(
            latest("series", "text_value").alias("series_id"),
            latest("class", "text_value").alias("class_id"),
            latest("expense", "value").alias("net_expense_ratio"),
            latest("turnover", "value").alias("turnover_pct"),
        )
        .where(F.col("net_expense_ratio").isNotNull() | F.col("turnover_pct").isNotNull())
    )


def lookup_fund_returns(
    db: DataFrame,
    class_id: str | None = None,
    cik: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Stored returns under the given filters in month order; the filters reach the file scan, and where the
    database has a `year` only the years asked for are listed."""
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None and "year" in db.columns:
            db = db.where(keep(F.col("year"), F.lit(int(bound[:4]))))
    if class_id is not None:
        db = db.where(F.col("class_id") == class_id)
    if cik is not None:
        db = db.where(F.col("cik") == str(cik).zfill(10))
    if start is not None:
        db = db.where(F.col("month_end") >= F.lit(start).cast("date"))
    if end is not None:
        db = db.where(F.col("month_end") <= F.lit(end).cast("date"))
    return db.orderBy("month_end", "class_id")


def filter_single_fund(df: DataFrame, class_id: str) -> DataFrame:
    """The rows of one fund, of which there are some; over a stored panel the filter reaches the scan."""
    chosen = df.where(F.col("class_id") == class_id)
    if chosen.isEmpty():
        raise ValueError(f"no rows for fund {class_id}")
    return chosen


def value_added(panel: DataFrame, expenses: DataFrame, tna: DataFrame) -> DataFrame:
    """(alpha - expense ratio) x previous row's assets, with both sides joined by key."""
    merged = join_expense_by_class(panel.drop("net_expense_ratio"), expenses).join(
        tna.select("class_id", "month_end", F.col("tna").alias("tna_proxy")),
        ["class_id", "month_end"],
        "left",
    )
    return value_added_from(merged, "tna_proxy")


def value_added_from(df: DataFrame, assets: str) -> DataFrame:
    by_month = Window.partitionBy("class_id").orderBy("month_end")
    return value_added_of(df.withColumn("tna_lag", F.lag(assets).over(by_month)))


def value_added_of(df: DataFrame) -> DataFrame:
    """(alpha - expense ratio) x lagged assets, null when the panel lacks one of the two."""
    if "net_expense_ratio" not in df.columns or "alpha_hat" not in df.columns:
        return df.withColumn("value_added", null_double())
    return df.withColumn(
        "value_added", (F.col("alpha_hat") - F.col("net_expense_ratio")) * F.col("tna_lag")
    )


def registrants_flatten(registrants: DataFrame) -> DataFrame:
    return registrants.select(
        pad_registrant_id("cik").alias("cik"), F.explode("series_ids").alias("series_id")
    )
