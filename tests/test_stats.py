import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fundloom.functions import stats

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def quantiles(spark, values, probs=PROBS, accuracy=50, **kw):
    df = spark.createDataFrame(pd.DataFrame({"x": values}), "x double")
    rows = stats.exact_quantiles(df, ["x"], probs, accuracy=accuracy, **kw).collect()
    return {r["prob"]: r["quantile"] for r in rows}


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(1).normal(size=20000),
        # a third of all rows share one value
        np.concatenate([np.full(7000, 0.25), np.random.default_rng(2).random(14000)]),
        np.full(5000, 3.0),
        np.arange(1000.0) ** 3,
        np.array([4.0, 1.0]),
        np.array([7.0]),
    ],
)
def test_exact_quantiles_through_brackets(spark, values):
    got = quantiles(spark, values)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("most", [3, 40, 400])
def test_brackets_are_narrowed_until_few_values_are_left(spark, most):
    """Several narrowing passes, heavy values inside brackets and on their ends, two measures at once."""
    rng = np.random.default_rng(most)
    heavy = np.concatenate([np.full(6000, 0.5), np.full(5000, 0.25), rng.random(9000)])
    pdf = pd.DataFrame({"x": heavy, "y": rng.normal(size=20000)})
    rows = stats.exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], PROBS, accuracy=40, most=most).collect()
    assert len(rows) == 2 * len(PROBS)
    for r in rows:
        assert r["quantile"] == pytest.approx(np.quantile(pdf[r["variable"]], r["prob"]), rel=1e-12, abs=1e-12)


def test_a_missed_rank_moves_the_bracket(spark):
    """A bracket that does not hold its rank is moved to the rank's side, in both directions."""
    wide = spark.createDataFrame(pd.DataFrame({"_x0": np.arange(100.0)}))
    bracket = "named_struct('i', 0, 'p', 0.5D, 'n', 100D, 'lo', {}D, 'hi', {}D, 'size', 1D)"
    brackets = spark.range(1).selectExpr(f"array({bracket.format(60, 70)}, {bracket.format(10, 20)}) AS _s")
    for take in (True, False):
        low, high = stats._bracket_pass(wide, brackets, [], [0, 0], 1000, take).first()["_s"]
        assert (low["lo"], low["hi"], low["size"]) == (None, 60.0, 100.0)
        assert (high["lo"], high["hi"], high["size"]) == (20.0, None, 100.0)


def test_exact_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, x double")
    assert stats.exact_quantiles(empty, ["x"], [0.5]).count() == 0
    assert stats.exact_quantiles(empty, ["x"], [0.5], ["g"]).count() == 0
    nulls = spark.createDataFrame([("a", None), ("b", 1.0)], "g string, x double")
    assert [tuple(r) for r in stats.exact_quantiles(nulls, ["x"], [0.5], ["g"]).collect()] == [("b", "x", 0.5, 1.0)]


def test_exact_quantiles_skip_missing_and_group(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 9000), "x": rng.normal(size=9000)})
    pdf.loc[pdf.index % 11 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.col("g") != 2, F.col("x")))
    got = stats.exact_quantiles(df, ["x"], [0.1, 0.9], ["g"], accuracy=40).collect()
    assert {(r["g"], r["prob"]) for r in got} == {(g, p) for g in (0, 1) for p in (0.1, 0.9)}
    for r in got:
        want = pdf[pdf.g == r["g"]].x.quantile(r["prob"])
        assert r["quantile"] == pytest.approx(want, rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([-1.5, 0.0, 0.25, 2.0, 9.0]), min_size=1, max_size=900))
def test_exact_quantiles_of_repeated_values(spark, values):
    got = quantiles(spark, values, [0.33, 0.5], accuracy=20)
    for p in (0.33, 0.5):
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_moments_follow_pandas(spark):
    pdf = pd.DataFrame({"x": np.random.default_rng(4).gamma(2, size=500)})
    row = spark.createDataFrame(pdf).agg(
        stats.sample_skewness("x").alias("s"), stats.sample_excess_kurtosis("x").alias("k")
    ).first()
    assert row["s"] == pytest.approx(pdf.x.skew(), rel=1e-9)
    assert row["k"] == pytest.approx(pdf.x.kurtosis(), rel=1e-9)


def test_correlation_of_constant_is_null(spark):
    pdf = pd.DataFrame({"x": [1.0, 1.0, 1.0], "y": [1.0, 2.0, 3.0]})
    assert spark.createDataFrame(pdf).agg(stats.correlation("x", "y").alias("c")).first()["c"] is None
