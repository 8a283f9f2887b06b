"""Window operators over the months of a class.

All windows partition by class and count rows, not calendar months. After deduplication a class has one
row per month, so a window partition is bounded by the calendar. Windows with the same partitioning and
order share one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from fundloom.functions.scalars import col

def by_month() -> WindowSpec:
    return Window.partitionBy("class_id").orderBy("month_end")



def net_flow(df: DataFrame) -> DataFrame:
    return df.withColumn("net_flow", F.col("sales") + F.col("reinvest") - F.col("redemptions"))


def rolling_flow_volatility(df: DataFrame, window: int = 12, min_periods: int = 3) -> DataFrame:
    """Sample deviation of net flow over the last `window` rows with at least `min_periods` known."""
    frame = by_month().rowsBetween(1 - window, 0)
    enough = F.count("net_flow").over(frame) >= min_periods
    return df.withColumn("vol_of_flows", F.when(enough, F.stddev_samp("net_flow").over(frame)))


def lag_realized_alpha(df: DataFrame) -> DataFrame:
    return df.withColumn("realized_alpha_lagged", F.lag("alpha_hat").over(by_month()))


def lag_tna(df: DataFrame, assets: str = "total_investments") -> DataFrame:
    return df.withColumn("tna_lag", F.lag(assets).over(by_month()))


def month_gaps(df: DataFrame) -> DataFrame:
    """Distance in days to the previous month of the class, and which kind of gap it is."""
    days = F.datediff("month_end", "prev_month")
    return (
        df.select("class_id", "month_end")
        .withColumn("prev_month", F.lag("month_end").over(by_month()))
        .where(F.col("prev_month").isNotNull())
        .withColumns(
            {
                "days": days,
                "is_gap": days > 32,
                "is_normal": (days >= 25) & (days <= 35),
                "is_large": days > 60,
                "gap_months": F.floor(days / 30),
            }
        )
    )


def month_gap_summary(df: DataFrame) -> DataFrame:
    def hits(flag: str) -> Column:
        return F.coalesce(F.sum(F.col(flag).cast("int")), F.lit(0)).alias(f"n_{flag[3:]}")

    return month_gaps(df).groupBy("class_id").agg(
        F.count(F.lit(1)).alias("n_steps"), hits("is_gap"), hits("is_normal"), hits("is_large"),
        F.max("days").alias("max_days"),
    )


def fill_forward(df: DataFrame, value: str = "return") -> DataFrame:
    past = by_month().rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(past))


def fill_zero(df: DataFrame, value: str = "return") -> DataFrame:
    return df.withColumn(value, F.coalesce(col(value), F.lit(0.0)))


def fill_linear(df: DataFrame, value: str = "return", limit: int | None = None) -> DataFrame:
    """Linear in the row position; trailing nulls repeat the last value, leading ones stay null, and
    with `limit` at most that many nulls after a known value are filled."""
    past = by_month().rowsBetween(Window.unboundedPreceding, 0)
    future = by_month().rowsBetween(0, Window.unboundedFollowing)
    known = F.when(col(value).isNotNull(), F.struct(F.col("_pos").alias("pos"), col(value).alias("v")))
    placed = (
        df.withColumn("_pos", F.row_number().over(by_month()))
        .withColumn("_known", known)
        .withColumns(
            {
                "_prev": F.last("_known", ignorenulls=True).over(past),
                "_next": F.first("_known", ignorenulls=True).over(future),
            }
        )
    )
    step = F.try_divide(F.col("_next.v") - F.col("_prev.v"), F.col("_next.pos") - F.col("_prev.pos"))
    run = F.col("_pos") - F.col("_prev.pos")
    line = F.when(F.col("_next").isNull(), F.col("_prev.v")).otherwise(F.col("_prev.v") + step * run)
    if limit is not None:
        line = F.when(run <= limit, line)
    return placed.withColumn(value, F.coalesce(col(value), line)).drop("_pos", "_known", "_prev", "_next")


def tna_roll_forward(df: DataFrame) -> DataFrame:
    """Assets carried between the months where they are known, as rows (class_id, month_end, tna).

    Per class in month order: investments plus cash, when both known, set the state; otherwise a known
    state grows by the return and the flow when both are known, and stays as it is when not. So a month maps the
    state x to a x + b or sets it, and from the last month that set it to s the state is A (s + sum of b / A),
    A the running product of the a: running windows, linear in the months. A month with a = 0 sets the state to b.
    Rows of one class and month each count, in the order of their assets, return and flow, unknown first. Growth over
    a part is within the range of a double.
    """
    anchor = F.col("total_investments") + F.col("cash")
    known = F.col("return").isNotNull() & F.col("net_flow").isNotNull()
    rows = df.select("class_id", "month_end", anchor.alias("_set"), "return", "net_flow").withColumns(
        {"_a": F.when(known, 1 + F.col("return")).otherwise(1.0), "_b": F.when(known, F.col("net_flow")).otherwise(0.0)}
    )
    order = ["month_end", "_set", "return", "net_flow"]
    history = Window.partitionBy("class_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.count("_set").over(history) > 0  # a month without a known state before it cannot set one by a = 0
    level = F.coalesce(F.col("_set"), F.when(first & (F.col("_a") == 0), F.col("_b")))
    rows = rows.withColumn("_level", level).withColumn("_part", F.count("_level").over(history))
    part = Window.partitionBy("class_id", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sets = F.col("_level").isNotNull()
    factor = F.when(sets | (F.col("_part") == 0), 1.0).otherwise(F.col("_a"))
    rows = rows.withColumn("_product", F.product(factor).over(part))
    added = F.sum(F.when(sets, F.col("_level")).otherwise(F.try_divide("_b", "_product"))).over(part)
    tna = F.when(F.col("_part") > 0, F.col("_product") * added)
    return rows.select("class_id", "month_end", tna.alias("tna"))

def expanding_train_window(dates: DataFrame, panel_len: int = 10) -> DataFrame:
    """For each formation date the distinct earlier dates it trains on; `dates` has one row per date."""
    ordered = Window.orderBy("Date")  # one row per distinct date
    indexed = dates.select("Date").distinct().withColumn("idx", F.row_number().over(ordered) - 1)
    formation = indexed.where(F.col("idx") >= panel_len).select(
        F.col("Date").alias("formation_date"), F.col("idx").alias("formation_idx")
    )
    return F.broadcast(formation).join(indexed, F.col("idx") < F.col("formation_idx"))


def semi_train_dates(characteristics: DataFrame, formation_date: str, panel_len: int = 10) -> DataFrame:
    """Characteristics of the dates before the formation date, which has `panel_len` dates before it."""
    windows = expanding_train_window(characteristics, panel_len)
    train = windows.where(F.col("formation_date") == formation_date).select("Date")
    return characteristics.join(F.broadcast(train), "Date", "left_semi")


def extended_history(df: DataFrame, since: str, extra_months: int) -> DataFrame:
    """Rows from `extra_months` before `since`; the bound is a scan predicate."""
    return df.where(F.col("month_end") >= F.add_months(F.lit(since).cast("date"), -extra_months))
