"""Column profiles and schema checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from fundloom.functions.scalars import col, null_double
from fundloom.session import materialize

# For each model feature the input spellings accepted, in order of preference.
FEATURE_ALIASES: dict[str, list[str]] = {
    "realized alpha": ["realized alpha", "alpha_hat"],
    "realized alpha lagged": ["realized alpha lagged", "alpha_hat_lag"],
    "alpha (intercept t-stat)": ["alpha (intercept t-stat)", "alpha_t"],
    "total net assets": ["total net assets", "total_investments", "tna_proxy"],
    "expense ratio": ["expense ratio", "net_expense_ratio", "net_expense_ratio_x", "net_expense_ratio_y"],
    "age": ["age", "fund_age"],
    "flows": ["flows", "net_flow"],
    "manager_tenure": ["manager tenure", "manager_tenure"],
    "turnover ratio": ["turnover ratio", "turnover_pct", "turnover_pct_x", "turnover_pct_y"],
    "vol_of_flows": ["vol. of flows", "vol_of_flows", "flow_volatility"],
    "value_added": ["value added", "value_added"],
    "market beta t-stat": ["market beta t-stat", "market_beta_t"],
    "profit. beta t-stat": ["profit. beta t-stat", "profit_beta_t"],
    "invest. beta t-stat": ["invest. beta t-stat", "invest_beta_t"],
    "size beta t-stat": ["size beta t-stat", "size_beta_t"],
    "value beta t-stat": ["value beta t-stat", "value_beta_t"],
    "momentum beta t-stat": ["momentum beta t-stat", "momentum_beta_t"],
    "R2": ["R2", "r_squared"],
}
# The features a model needs are all of these but the current alpha.
MODEL_FEATURES = [f for f in FEATURE_ALIASES if f != "realized alpha"]

# Published names of the panel columns.
PAPER_NAMES = {
    "alpha_hat": "realized alpha",
    "realized_alpha_lagged": "realized alpha lagged",
    "alpha_t": "alpha (intercept t-stat)",
    "total_investments": "total net assets",
    "net_expense_ratio": "expense ratio",
    "fund_age": "age",
    "net_flow": "flows",
    "turnover_pct": "turnover ratio",
    "market_beta_t": "market beta t-stat",
    "profit_beta_t": "profit. beta t-stat",
    "invest_beta_t": "invest. beta t-stat",
    "size_beta_t": "size beta t-stat",
    "value_beta_t": "value beta t-stat",
    "momentum_beta_t": "momentum beta t-stat",
}
METADATA = ["class_id", "month_end", "cik"]


def first_available_columns(df: DataFrame, aliases: dict[str, list[str]] = FEATURE_ALIASES) -> DataFrame:
    """Each feature from the first spelling present in the schema, else a null column."""
    chosen = []
    for feature, spellings in aliases.items():
        found = next((c for c in spellings if c in df.columns), None)
        chosen.append((col(found) if found else null_double()).alias(feature))
    return df.select(*[c for c in METADATA if c in df.columns], *chosen)


def paper_column_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(PAPER_NAMES)


def typed_null_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns an absent source would have given, so that the schema stays the same."""
    return df.withColumns({n: null_double() for n in names if n not in df.columns})


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def column_profile(df: DataFrame) -> DataFrame:
    """Type, known and distinct values, and date range of every column.

    Each column is counted on its own type from a stored copy of the frame, of which it reads that column alone: a
    repeated value is shuffled once per task, as what it is. Ranges and known values come from one plain aggregate.
    """
    stored = materialize(df)
    dated = {f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
    nothing = F.lit(None).cast("string")
    facts = [F.count(F.lit(1)).alias("_rows")]
    for k, c in enumerate(df.columns):
        facts += [F.count(col(c)).alias(f"_n{k}")]
        facts += [(f(col(c)).cast("string") if c in dated else nothing).alias(f"_{f.__name__}{k}") for f in (F.min, F.max)]
    totals = stored.agg(*facts)
    listed = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"_n{k}").alias("non_null"),
                 F.col(f"_min{k}").alias("min_date"), F.col(f"_max{k}").alias("max_date"))
        for k, f in enumerate(df.schema)
    ])
    rows = totals.select("_rows", F.explode(listed).alias("c")).select("_rows", "c.*")
    distinct = reduce(DataFrame.unionByName, [
        stored.groupBy(col(c)).agg(F.lit(1).alias("_one")).agg(F.count(col(c)).alias("distinct_values"))
        .select(F.lit(c).alias("column"), "distinct_values")
        for c in df.columns
    ])
    return rows.join(F.broadcast(distinct), "column").select(  # a row for each column
        "column",
        "type",
        "non_null",
        F.try_divide((F.col("_rows") - F.col("non_null")) * 100.0, F.col("_rows")).alias("null_pct"),
        "distinct_values",
        "min_date",
        "max_date",
    )


def top_values(df: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent values of each text column; the limit is applied per task before the shuffle."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    long = df.select(*text).unpivot([], [col(c) for c in text], "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    best = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n)


def high_missing_columns(df: DataFrame, limit: float = 0.5) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(col(c)).alias(c) for c in df.columns]
    )
    long = counted.unpivot(["_rows"], [col(c) for c in df.columns], "column", "known")
    share = long.select(
        "column", (1 - F.try_divide("known", "_rows")).alias("missing_ratio"), F.col("_rows").alias("n_rows")
    )
    return share.where(F.col("missing_ratio") > limit)


def infinite_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Which columns hold an infinite value."""
    flags = df.agg(
        *[F.coalesce(F.max(F.abs(col(c)) == float("inf")), F.lit(False)).alias(c) for c in columns]
    )
    return flags.unpivot([], [col(c) for c in columns], "column", "has_infinite")


def feature_compatibility(
    spark: SparkSession, columns: Sequence[str], aliases: dict[str, list[str]] = FEATURE_ALIASES
) -> DataFrame:
    """Which features a schema offers and whether that is enough for scoring."""
    found = {f: next((c for c in spell if c in columns), None) for f, spell in aliases.items()}
    available = sum(v is not None for v in found.values())
    if available == len(found):
        verdict = "full"
    elif available >= 0.8 * len(MODEL_FEATURES):
        verdict = "mostly"
    else:
        verdict = "too few"
    rows = [(f, c, c is not None, verdict) for f, c in found.items()]
    return spark.createDataFrame(rows, "feature string, source string, available boolean, verdict string")
