import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundloom.operators import features as X, profile, scoring

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(0)
    out = pd.DataFrame({"class_id": [f"C{k % 7}" for k in range(400)], "n": range(400)})
    out["month_end"] = pd.to_datetime("2000-01-31") + pd.to_timedelta(out.n, unit="D")
    out["month_end"] = out.month_end.dt.date
    out["a"] = rng.normal(3, 2, 400)
    out["b"] = rng.gamma(1, 2, 400)
    out.loc[out.n % 9 == 0, "a"] = np.nan
    return out.drop(columns="n")


@pytest.fixture(scope="module")
def df(spark, pdf):
    raw = spark.createDataFrame(pdf)
    return raw.withColumn("a", F.when(~F.isnan("a"), F.col("a")))


def as_pandas(out, columns=COLS):
    return out.toPandas().sort_values(["month_end"])[columns].reset_index(drop=True)


def compare(out, want):
    got = as_pandas(out)
    for c in COLS:
        assert got[c].to_numpy(dtype=float) == pytest.approx(want[c].to_numpy(), rel=1e-9, nan_ok=True)


def test_imputation(df, pdf):
    base = pdf[COLS]
    compare(X.impute_median(df, COLS), base.fillna(base.median()))
    compare(X.impute_mean(df, COLS), base.fillna(base.mean()))
    compare(X.impute_forward(df, COLS), pdf.groupby("class_id")[COLS].ffill())


def test_outliers(df, pdf):
    base = pdf[COLS]
    compare(X.winsorize(df, COLS), base.clip(base.quantile(0.01), base.quantile(0.99), axis=1))
    q1, q3 = base.quantile(0.25), base.quantile(0.75)
    compare(X.clip_iqr(df, COLS), base.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), axis=1))
    left = base
    for c in COLS:
        z = ((left[c] - left[c].mean()) / left[c].std(ddof=0)).abs()
        left = left[z.isna() | (z < 2)]
    compare(X.remove_outliers_z(df, COLS, limit=2.0), left)


def test_scaling_with_own_and_fitted_statistics(df, pdf):
    base = pdf[COLS]
    compare(X.standardize(df, COLS), (base - base.mean()) / base.std())
    fitted = X.fit_feature_stats(df.where(F.col("class_id") != "C0"), COLS)
    some = pdf[pdf.class_id != "C0"][COLS]
    compare(X.standardize(df, COLS, fitted), (base - some.mean()) / some.std())
    compare(X.impute_median(df, COLS, fitted), base.fillna(some.median()))


def test_constant_and_empty_features(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "k int, c double, e double")
    stats = {r["variable"]: r for r in X.fit_feature_stats(df, ["c", "e"]).collect()}
    assert (stats["c"]["std"], stats["c"]["median"]) == (0.0, 5.0)
    assert (stats["e"]["mean"], stats["e"]["std"], stats["e"]["max"]) == (0.0, 1.0, 1.0)
    out = X.standardize(X.impute_median(df, ["c", "e"]), ["c", "e"]).collect()
    assert [(r["c"], r["e"]) for r in out] == [(5.0, 0.0), (5.0, 0.0)]


def test_prepared_features_hold_all_names_and_read_text_numbers(spark):
    df = spark.createDataFrame(
        [("A", "1.5", "x", 2.0), ("B", "2.5", "3", 4.0)],
        "class_id string, alpha_hat string, net_flow string, total_investments double",
    )
    out = X.prepare_features(df, outliers="none", scale=False)
    assert out.columns == ["class_id", *profile.FEATURE_ALIASES]
    rows = out.orderBy("class_id").collect()
    assert [r["realized alpha"] for r in rows] == [1.5, 2.5]
    assert [r["flows"] for r in rows] == [3.0, 3.0]
    assert X.model_inputs(out).columns == ["class_id", *profile.MODEL_FEATURES]
    assert len(profile.MODEL_FEATURES) == 17


def test_first_spelling_present_decides_even_when_null(spark):
    df = spark.createDataFrame([(None, 9.0)], "`expense ratio` double, net_expense_ratio double")
    assert profile.first_available_columns(df).first()["expense ratio"] is None


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b"):
        profile.require_columns(spark.range(1), ["id", "b"])


def test_verdict_on_a_schema(spark):
    def verdict(columns):
        return profile.feature_compatibility(spark, columns).first()["verdict"]

    names = list(profile.FEATURE_ALIASES)
    assert (verdict(names), verdict(names[:14]), verdict(names[:5])) == ("full", "mostly", "too few")


def test_duplicate_predictions_are_an_error(spark):
    df = spark.createDataFrame(
        [("f", "m", 1.0, 0.5, True), ("f", "m", 2.0, 0.5, True)],
        "fund_id string, model string, predicted_alpha double, portfolio_weight double, in_top_decile boolean",
    )
    with pytest.raises(Exception, match="duplicate entry"):
        scoring.pivot_model_predictions(df, ["m"], ["fund_id"]).collect()


def test_ensembles(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0), (1.0, None, 4.0)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    row, gap = df.select(
        scoring.ensemble_mean(cols).alias("batch"),
        scoring.ensemble_mean(cols, skip_nulls=False).alias("service"),
        scoring.ensemble_median(cols).alias("median"),
        scoring.ensemble_weighted(cols, {"a": 2.0}).alias("weighted"),
    ).collect()
    assert tuple(row) == pytest.approx((3.0, 3.0, 2.0, 2.5))
    assert tuple(gap) == (2.5, None, None, None)


def z_by_hand(pdf, names, limit):
    left = pdf
    for f in names:
        m, s = left[f].mean(), left[f].std(ddof=0)
        if s and not np.isnan(s):
            left = left[~((left[f] - m).abs() / s >= limit)]
    return set(left.id)


@pytest.mark.parametrize("seed, limit", [(0, 3.0), (1, 2.0), (2, 1.5)])
def test_outliers_are_removed_step_by_step(spark, seed, limit):
    """Heavy tails, features that are outliers together, unknown and constant ones, and a value so far off that what
    is left has a spread much smaller than that of all rows."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(3000), "a": rng.standard_t(2, 3000), "b": rng.normal(size=3000), "c": 4.0})
    pdf["d"] = pdf.a * 2 + rng.normal(size=3000)
    pdf["e"] = np.where(rng.random(3000) < 0.2, np.nan, rng.standard_t(3, 3000))
    pdf["f"] = np.where(pdf.id < 3, 1e6, rng.normal(size=3000))
    pdf.loc[pdf.id < 3, "a"] = 500.0  # the rows that are far off go with the first feature
    names = ["a", "b", "c", "d", "e", "f"]
    got = X.remove_outliers_z(spark.createDataFrame(pdf), names, limit).toPandas()
    assert set(got.id) == z_by_hand(pdf, names, limit)
    assert got.e.isna().any()


def test_outliers_of_nothing(spark):
    empty = spark.createDataFrame([], "a double")
    assert X.remove_outliers_z(empty, ["a"]).count() == 0
    same = spark.createDataFrame([(1.0,), (1.0,), (None,)], "a double")
    assert X.remove_outliers_z(same, ["a"]).count() == 3
