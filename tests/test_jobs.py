import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundloom.functions import scalars as S
from fundloom.operators import joins, timeseries
from fundloom.plans import etl, service, views
from fundloom.streaming import incremental
from test_regression import make_panel


def filed(spark, rows):
    return spark.createDataFrame(
        [("0000000001", "C", "S", dt.date(2000, m, 28), v, dt.date(2000, f, 1), dt.date(2000, m, 28), a)
         for m, v, f, a in rows],
        incremental.RETURNS_SCHEMA,
    )


def test_stream_merges_late_corrections_and_is_idempotent(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "db")
    filed(spark, [(1, 0.1, 3, 1), (2, 0.2, 3, 1)]).write.mode("append").parquet(landing)
    incremental.stream_quarters(spark, landing, root, str(tmp_path / "p1")).awaitTermination()
    filed(spark, [(2, 0.9, 5, 2), (2, 0.8, 5, 1), (4, 0.4, 6, 3)]).write.mode("append").parquet(landing)
    for progress in ("p1", "p2"):  # the second run replays every file from the start
        incremental.stream_quarters(spark, landing, root, str(tmp_path / progress)).awaitTermination()
        db = incremental.read_returns_database(spark, root).orderBy("month_end").collect()
        assert [(r["month_end"].month, r["return"]) for r in db] == [(1, 0.1), (2, 0.9), (4, 0.4)]
    assert [r[0] for r in incremental.processed_quarters(incremental.read_returns_database(spark, root)).collect()]


def test_readers_see_the_version_before_or_after_a_merge(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "db")
    months = lambda df: sorted((r["month_end"].month, r["return"]) for r in df.collect())
    incremental.merge_batch(spark, root, filed(spark, [(1, 0.1, 3, 1)]))
    before = incremental.read_returns_database(spark, root)
    seen = []

    def publish(session, where, version, folders, real=incremental._publish):
        seen.append(months(incremental.read_returns_database(session, where)))  # all data is written, nothing published
        real(session, where, version, folders)

    monkeypatch.setattr(incremental, "_publish", publish)
    incremental.merge_batch(spark, root, filed(spark, [(1, 0.5, 4, 2), (2, 0.2, 4, 3)]))
    assert seen == [[(1, 0.1)]] and months(before) == [(1, 0.1)]
    assert months(incremental.read_returns_database(spark, root)) == [(1, 0.5), (2, 0.2)]
    assert months(incremental.read_returns_database(spark, root, 1)) == [(1, 0.1)]


def test_a_failed_merge_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "db")
    incremental.merge_batch(spark, root, filed(spark, [(1, 0.1, 3, 1)]))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "_publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.merge_batch(spark, root, filed(spark, [(1, 0.9, 5, 2)]))
    assert incremental.read_returns_database(spark, root).first()["return"] == 0.1
    with pytest.raises(RuntimeError, match="another writer"):
        incremental._publish(spark, root, 1, {})
    assert incremental.versions(spark, root) == [1]
    for k in range(3):
        incremental.merge_batch(spark, root, filed(spark, [(1, float(k), 6 + k, 2 + k)]))
    incremental.remove_old_versions(spark, root, keep=1)
    assert incremental.versions(spark, root) == [4]
    assert incremental.read_returns_database(spark, root).first()["return"] == 2.0


def test_panel_job_keeps_one_row_per_class_and_month(spark):
    pdf = make_panel(n=50, classes=2)
    facts = pdf[["class_id", "month_end", "return"]].assign(
        sales=3.0, reinvest=1.0, redemptions=2.0, total_investments=100.0, cash=None, cik="0000000001",
        series_id="S1", filing_date=dt.date(2005, 1, 1),
    )
    late = facts.iloc[[3]].assign(filing_date=dt.date(2006, 1, 1), sales=9.0)
    schema = (
        "class_id string, month_end date, `return` double, sales double, reinvest double, redemptions double, "
        "total_investments double, cash double, cik string, series_id string, filing_date date"
    )
    filings = spark.createDataFrame(pd.concat([facts, late]).astype(object).to_numpy().tolist(), schema)
    factors = spark.createDataFrame(pdf.drop(columns=["class_id", "return"]).drop_duplicates("month_end"))
    expenses = spark.createDataFrame(
        [("C0", "S1", 0.01, 0.5), ("C0", "S1", 0.02, 0.5)],
        "class_id string, series_id string, net_expense_ratio double, turnover_pct double",
    )
    managers = spark.createDataFrame(
        [("0000000001", None, 4.0, 7.0, 1)],
        "cik string, class_id string, manager_tenure double, fund_age double, record int",
    )
    out = etl.build_panel(filings, factors, expenses, managers).cache()
    assert out.count() == 100 == out.select("class_id", "month_end").distinct().count()
    assert out.where(F.col("flows") == 8).count() == 1
    row = out.where("class_id = 'C0'").orderBy(F.desc("month_end")).first()
    assert row["value_added"] == pytest.approx((row["realized alpha"] - 0.01) * 100)
    assert (row["turnover ratio"], row["manager_tenure"], row["age"]) == (0.5, 4.0, 7.0)
    assert out.where("class_id = 'C1' and `expense ratio` is not null").isEmpty()
    out.unpersist()


def test_service_scores_do_not_depend_on_batches(spark, sf_dir):
    panel = timeseries.net_flow(views.panel(spark, sf_dir))
    coefficients = spark.createDataFrame(
        [("m1", 0.1, [1.0] * 17), ("m2", -0.1, [0.5] * 17)],
        "model string, intercept double, coefficients array<double>",
    )
    out = service.predict_service_batch(panel, coefficients).toPandas()
    assert len(out) == panel.count()
    assert out.ensemble_prediction.to_numpy() == pytest.approx((out.m1_prediction + out.m2_prediction) / 2)
    assert out.prediction_std.to_numpy() == pytest.approx((out.m1_prediction - out.m2_prediction).abs() / 2)
    shuffled = service.predict_service_batch(panel.repartition(5), coefficients).toPandas()
    keys = ["class_id", "month_end"]
    both = out.merge(shuffled, on=keys)
    assert both.ensemble_prediction_x.to_numpy() == pytest.approx(both.ensemble_prediction_y, abs=1e-9)


def test_linear_fill_follows_positions(spark):
    values = [None, 1.0, None, None, 4.0, None, None]
    df = spark.createDataFrame(
        [("C", dt.date(2000, k + 1, 28), v) for k, v in enumerate(values)],
        "class_id string, month_end date, `return` double",
    )
    got = [r["return"] for r in timeseries.fill_linear(df).orderBy("month_end").collect()]
    want = pd.Series(values, dtype=float).interpolate("linear")
    assert pd.Series(got, dtype=float).to_numpy() == pytest.approx(want.to_numpy(), nan_ok=True)
    two = [r["return"] for r in timeseries.fill_linear(df, limit=1).orderBy("month_end").collect()]
    assert pd.Series(two, dtype=float).to_numpy() == pytest.approx(
        pd.Series(values, dtype=float).interpolate("linear", limit=1).to_numpy(), nan_ok=True
    )


def test_valid_class_filter_is_off_without_classes(spark):
    panel = spark.createDataFrame([("C",)], "class_id string")
    mapping = spark.createDataFrame([("C", "S")], "class_id string, series_id string")
    none = spark.createDataFrame([("other",)], "series_id string")
    assert joins.filter_valid_classes(panel, mapping, none).count() == 1


def test_single_fund_must_exist(spark):
    with pytest.raises(ValueError):
        joins.filter_single_fund(spark.createDataFrame([("C",)], "class_id string"), "D")


@pytest.mark.parametrize(
    "text, month",
    [("2001-03-15", dt.date(2001, 3, 1)), ("20010315", dt.date(2001, 3, 1)), ("200103", dt.date(2001, 3, 1)),
     ("2001", None), ("x", None), ("20011399", None)],
)
def test_month_spellings(spark, text, month):
    row = spark.createDataFrame([(text,)], "t string").select(S.coerce_month_start("t")).first()
    assert row[0] == month
