"""Assets carried forward against a loop over the months."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundloom.operators import timeseries

SCHEMA = "class_id string, month_end date, total_investments double, cash double, `return` double, net_flow double"


def by_hand(rows):
    found, state = [], {}
    low = float("-inf")
    key = lambda r: (r[0], r[1], *[low if v is None else v for v in (None if None in r[2:4] else r[2] + r[3], r[4], r[5])])
    for c, month, total, cash, growth, flow in sorted(rows, key=key):
        if total is not None and cash is not None:
            state[c] = total + cash
        elif state.get(c) is not None and growth is not None and flow is not None:
            state[c] = state[c] * (1 + growth) + flow
        found.append((c, month, state.get(c)))
    return found


def test_against_a_loop(spark):
    """Unknown assets at the start, returns of -1 and below, repeated months, single months, many segments."""
    rng = np.random.default_rng(8)
    rows = []
    maybe = lambda p, v: float(v) if rng.random() < p else None
    for c in range(12):
        for m in range(60):
            month = dt.date(2000 + m // 12, m % 12 + 1, 28)
            for _ in range(1 + (rng.random() < 0.1)):
                growth = rng.choice([-1.0, -1.5, rng.normal(0, 0.1)], p=[0.05, 0.05, 0.9])
                rows.append((f"C{c}", month, maybe(0.9, rng.random() * 1e6), maybe(0.1 * (c > 0), 10.0), maybe(0.9, growth), maybe(0.9, rng.normal(0, 1000))))
    rows.append(("D", dt.date(2000, 1, 31), None, None, -1.0, 5.0))
    got = timeseries.tna_roll_forward(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    got = sorted(((r.class_id, r.month_end, r.tna) for r in got), key=str)
    want = sorted(by_hand(rows), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    a, b = (sorted((x[0], str(x[1]), x[2] is not None, round(x[2] or 0, 4)) for x in s) for s in (got, want))
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3], rel=1e-9, abs=1e-3)


def test_a_long_history_stays_linear(spark):
    """Ten thousand months of one class: no array of the history is built."""
    df = spark.range(10000).select(
        F.lit("C").alias("class_id"), F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("id").cast("int")).alias("month_end"),
        F.when(F.col("id") == 3, 100.0).alias("total_investments"), F.lit(0.0).alias("cash"),
        F.lit(0.0001).alias("return"), F.lit(1.0).alias("net_flow"),
    )
    out = timeseries.tna_roll_forward(df)
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    last = out.orderBy(F.desc("month_end")).first()["tna"]
    state = 100.0
    for _ in range(9996):
        state = state * 1.0001 + 1
    assert last == pytest.approx(state, rel=1e-9)
    assert out.where("tna is null").count() == 3
