"""Fund tables derived from the star-schema tables, so that every job grows with the given data.

Values that later steps compare or rank are rounded here once, which makes them independent of the
order in which floating sums were taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fundloom.functions.stats import complete_case_filter
from fundloom.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def class_key(key: str) -> Column:
    return F.concat(F.lit("C"), F.lpad(F.col(key).cast("string"), 9, "0"))


def series_key(key: str) -> Column:
    return F.concat(F.lit("S"), F.lpad(F.col(key).cast("string"), 4, "0"))


def month_number(d: str) -> Column:
    return F.year(d) * 12 + F.month(d)


def supplier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and ship month; partial sums leave one small row per key to shuffle."""
    price = F.col("l_extendedprice")

    def flagged(flag: str) -> Column:
        return F.round(F.sum(F.when(F.col("l_returnflag") == flag, price)), 2)

    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("month_end", F.last_day(F.to_date("l_shipdate")))
        .groupBy("l_suppkey", "month_end")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_discount").alias("sum_discount"),
            F.sum("l_tax").alias("sum_tax"),
            F.sum("l_quantity").alias("sum_quantity"),
            F.round(F.sum(price * (1 - F.col("l_discount"))), 4).alias("net_price"),
            flagged("N").alias("sales"),
            flagged("R").alias("redemptions"),
            flagged("A").alias("reinvest"),
        )
    )


def panel(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Class x month facts with some returns unknown and cash known quarterly.

    `base` is the materialized `supplier_month` of a caller that also needs the factors."""
    at = month_number("month_end")
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    mean_return = F.col("sum_discount") / F.col("n") - F.col("sum_tax") / F.col("n")
    monthly = base if base is not None else supplier_month(spark, sf_dir)
    return (
        monthly.join(supplier, "l_suppkey")
        .select(
            class_key("l_suppkey").alias("class_id"),
            series_key("s_nationkey").alias("series_id"),
            F.lpad(F.col("s_nationkey").cast("string"), 10, "0").alias("cik"),
            "month_end",
            F.date_add("month_end", 60).alias("filing_date"),
            F.when((F.col("l_suppkey") * 7 + at) % 17 != 0, F.round(mean_return, 6)).alias("return"),
            "sales",
            "reinvest",
            "redemptions",
            F.col("net_price").alias("total_investments"),
            F.when(F.month("month_end") % 3 == 0, F.col("sum_quantity")).alias("cash"),
            F.round(F.col("sum_tax") / F.col("n"), 6).alias("avg_tax"),
            F.round(F.col("sum_discount") / F.col("n"), 6).alias("avg_discount"),
            "n",
        )
    )


def gappy(panel: DataFrame) -> DataFrame:
    """The panel with every 29th month of a class left out, for the reports that look for gaps."""
    number = F.substring("class_id", 2, 9).cast("int")
    return panel.where((number * 5 + month_number("month_end")) % 29 != 0)


def factors(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Monthly factor series; one row per calendar month, so it may be broadcast."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region_sums = [
        F.sum(F.when(F.col("n_regionkey") == r, F.col("sum_discount") - F.col("sum_tax"))).alias(f"s{r}")
        for r in range(5)
    ] + [F.sum(F.when(F.col("n_regionkey") == r, F.col("n"))).alias(f"n{r}") for r in range(5)]
    sums = base if base is not None else supplier_month(spark, sf_dir)
    monthly = (
        sums.join(supplier, "l_suppkey")
        .join(nation, "n_nationkey")
        .groupBy("month_end")
        .agg(
            F.sum("n").alias("n"),
            F.sum("sum_discount").alias("d"),
            F.sum("sum_tax").alias("t"),
            *region_sums,
        )
    )
    base = F.col("s0") / F.col("n0")

    def spread(r: int) -> Column:
        return F.round(F.col(f"s{r}") / F.col(f"n{r}") - base, 10)

    rf = F.col("t") / F.col("n") / 100
    by_month = Window.orderBy("month_end")  # one row per calendar month
    return monthly.select(
        "month_end",
        F.round((F.col("d") - F.col("t")) / F.col("n") - rf, 10).alias("MKT_RF"),
        spread(1).alias("SMB"),
        spread(2).alias("HML"),
        spread(3).alias("RMW"),
        spread(4).alias("CMA"),
        F.round(rf, 10).alias("RF"),
    ).withColumn("MOM", F.lag("MKT_RF").over(by_month))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported values with several filings per class and month."""
    key = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.lpad((key % 25).cast("string"), 10, "0").alias("cik"),
        class_key("o_custkey").alias("class_id"),
        F.concat(F.lit("S"), F.lpad((key % 25).cast("string"), 4, "0")).alias("series_id"),
        F.last_day(F.to_date("o_orderdate")).alias("month_end"),
        F.to_date("o_orderdate").alias("filing_date"),
        F.last_day(F.to_date("o_orderdate")).alias("report_period"),
        F.when(key % 13 != 0, F.col("o_totalprice") / 1e7).alias("return"),
        F.col("o_orderkey").alias("accession"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("position"),
    )


def expense_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios extracted from prospectuses: some classes have none, some have two."""
    s = table(spark, sf_dir, "supplier")
    ratio = F.when(F.col("s_suppkey") % 7 != 0, F.round(F.abs("s_acctbal") / 1e6, 8))
    first = s.select(
        class_key("s_suppkey").alias("class_id"),
        series_key("s_nationkey").alias("series_id"),
        ratio.alias("net_expense_ratio"),
        F.when(
            F.col("s_suppkey") % 3 != 0, F.round(F.col("s_nationkey") / 100.0 + 0.1, 4)
        ).alias("turnover_pct"),
        F.lit("fund_level").alias("context_ref"),
    )
    second = first.where(F.col("class_id").endswith("4")).withColumn(
        "net_expense_ratio", F.round(F.col("net_expense_ratio") + 0.001, 8)
    )
    return first.unionByName(second)


def managers(spark: SparkSession, sf_dir: str, by_class: bool = True) -> DataFrame:
    """Manager tenure and fund age, either known per class or per registrant only."""
    s = table(spark, sf_dir, "supplier")
    cls = class_key("s_suppkey") if by_class else F.lit(None).cast("string")
    return s.select(
        F.lpad(F.col("s_nationkey").cast("string"), 10, "0").alias("cik"),
        cls.alias("class_id"),
        F.when(F.col("s_suppkey") % 5 != 0, (F.col("s_suppkey") % 23).cast("double")).alias(
            "manager_tenure"
        ),
        F.round((F.col("s_suppkey") % 41) / 2.0, 1).alias("fund_age"),
        F.col("s_suppkey").alias("record"),
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manually kept values for classes whose documents had none."""
    s = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 2 == 0)
    return s.select(
        class_key("s_suppkey").alias("class_id"),
        F.lit(0.0075).alias("net_expense_ratio"),
        F.lit(4.0).alias("manager_tenure"),
        F.lit(12.5).alias("fund_age"),
    )


FEATURES = [
    "alpha6_1mo_12m_lag_1", "alpha6_tstat_lag_1", "mtna_lag_1", "exp_ratio_lag_1", "age_lag_1",
    "flow_12m_lag_1", "mgr_tenure_lag_1", "turn_ratio_lag_1", "flow_vol_12m_lag_1",
    "value_added_12m_lag_1", "beta_market_tstat_lag_1", "beta_profit_tstat_lag_1",
    "beta_invest_tstat_lag_1", "beta_size_tstat_lag_1", "beta_value_tstat_lag_1",
    "beta_mom_tstat_lag_1", "R2_lag_1",
]  # fixed values: the feature contract of the models
TARGET = "alpha6_1mo_12m"


def characteristics(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Quarterly characteristics per fund: the target of a quarter and 17 values known before it.

    `facts` is the materialized panel of a caller that also needs the returns."""
    quarterly = (
        (facts if facts is not None else panel(spark, sf_dir))
        .withColumn("quarter_end", F.last_day(F.add_months(F.trunc("month_end", "quarter"), 2)))
        .groupBy(F.col("class_id").alias("fundno"), "quarter_end")
        .agg(
            F.round(F.avg("return"), 9).alias("alpha"),
            (F.max("return") - F.min("return")).alias("spread"),
            (F.round(F.avg("total_investments"), 5) / 1e6).alias("tna"),
            F.round(F.avg("avg_tax"), 9).alias("tax"),
            F.round(F.avg("avg_discount"), 9).alias("discount"),
            (F.round(F.sum("sales"), 2) / 1e6).alias("sales"),
            (F.round(F.sum("redemptions"), 2) / 1e6).alias("redemptions"),
            (F.round(F.sum("reinvest"), 2) / 1e6).alias("reinvest"),
            (F.sum("cash") / 1e3).alias("cash"),
            F.sum("n").cast("double").alias("rows"),
            F.count("return").cast("double").alias("known"),
            F.min("month_end").alias("first_month"),
        )
    )
    history = Window.partitionBy("fundno").orderBy("quarter_end")
    values = {
        "alpha6_1mo_12m_lag_1": F.col("alpha"),
        "alpha6_tstat_lag_1": F.try_divide("alpha", "spread"),
        "mtna_lag_1": F.col("tna"),
        "exp_ratio_lag_1": F.col("tax"),
        "age_lag_1": (F.row_number().over(history)).cast("double"),
        "flow_12m_lag_1": F.col("sales") - F.col("redemptions"),
        "mgr_tenure_lag_1": F.col("rows"),
        "turn_ratio_lag_1": F.try_divide("redemptions", "tna"),
        "flow_vol_12m_lag_1": F.abs(F.col("sales") - F.col("reinvest")),
        "value_added_12m_lag_1": (F.col("alpha") - F.col("tax")) * F.col("tna"),
        "beta_market_tstat_lag_1": F.col("discount"),
        "beta_profit_tstat_lag_1": F.try_divide("tax", "tna"),
        "beta_invest_tstat_lag_1": F.col("cash"),
        "beta_size_tstat_lag_1": F.col("spread"),
        "beta_value_tstat_lag_1": F.col("discount") * F.col("discount"),
        "beta_mom_tstat_lag_1": F.col("alpha") - F.lag("alpha").over(history),
        "R2_lag_1": F.try_divide("known", "rows"),
    }
    valued = quarterly.withColumns({f"now_{k}": v for k, v in values.items()})
    return valued.select(
        "fundno",
        F.date_format("quarter_end", "yyyyMM").alias("Date"),
        F.col("alpha").alias(TARGET),
        *[F.lag(f"now_{f}").over(history).alias(f) for f in FEATURES],
    )


def training_rows(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Complete characteristics, with measures of every scale kept as they are."""
    rows = characteristics(spark, sf_dir, facts)
    return complete_case_filter(rows, rows.columns)


def returns(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    return (facts if facts is not None else panel(spark, sf_dir)).select(
        F.col("class_id").alias("fundno"),
        F.trunc("month_end", "MM").alias("Date"),
        F.col("return").alias("mret"),
    )


def restated(panel: DataFrame) -> DataFrame:
    """The panel as filed: for some keys an earlier filing with other values comes with the one that counts."""
    earlier = panel.where(month_number("month_end") % 4 == 0).withColumns(
        {"filing_date": F.date_sub("filing_date", 20), "return": F.col("return") + 0.5, "sales": F.lit(0.0)}
    )
    return panel.unionByName(earlier)


def scored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with factors, two model outputs per class and month, and the alpha realised over the same
    12 rows. The line items are read once; factors and panel come from their materialized monthly sums, and
    all windows share one shuffle by class."""
    base = materialize(supplier_month(spark, sf_dir))
    history = Window.partitionBy("class_id").orderBy("month_end")
    year = history.rowsBetween(-11, 0)
    excess, market = F.col("return") - F.col("RF"), F.col("MKT_RF")
    complete = F.count(F.when(excess.isNotNull() & market.isNotNull(), 1)).over(year)
    joined = panel(spark, sf_dir, base).join(
        F.broadcast(factors(spark, sf_dir, base)), "month_end", "left"
    )
    models = joined.withColumns(
        {
            "xgb_prediction": F.round(F.avg("return").over(history.rowsBetween(-3, -1)), 9),
            "rf_prediction": F.round(F.avg("return").over(history.rowsBetween(-6, -1)), 9),
            "actual_alpha": F.when(
                complete >= 8, F.round(F.expr("regr_intercept(`return` - RF, MKT_RF)").over(year), 9)
            ),
        }
    )
    return models.withColumn(
        "ensemble_prediction", (F.col("xgb_prediction") + F.col("rf_prediction")) / 2
    )


def predictions(spark: SparkSession, sf_dir: str, scored: DataFrame | None = None) -> DataFrame:
    return (scored if scored is not None else scored_panel(spark, sf_dir)).select(
        "class_id", "month_end", "cik", "return", "xgb_prediction", "rf_prediction", "actual_alpha",
        "ensemble_prediction",
    )


def predictions_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows next to the realised alpha."""
    p = predictions(spark, sf_dir).where(F.col("ensemble_prediction").isNotNull())
    return p.select(
        "class_id", "month_end", F.col("ensemble_prediction").alias("predicted_alpha"), "actual_alpha",
        "xgb_prediction", "rf_prediction",
    )


def audited_panel(spark: SparkSession, sf_dir: str, scored: DataFrame | None = None) -> DataFrame:
    """The panel with factors and realised alpha, as the coverage reports read it."""
    return (
        (scored if scored is not None else scored_panel(spark, sf_dir))
        .withColumnRenamed("actual_alpha", "realized alpha")
        .drop("xgb_prediction", "rf_prediction", "ensemble_prediction")
    )
