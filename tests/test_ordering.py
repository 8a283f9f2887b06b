import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fundloom.operators import ordering


def test_rank_and_decile_with_a_hot_tie(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 3000, p=[0.9, 0.1]), "id": np.arange(3000)})
    pdf["score"] = np.where(rng.random(3000) < 0.4, 0.5, rng.random(3000).round(2))
    pdf.loc[pdf.id % 50 == 0, "score"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    got = ordering.rank_and_decile(df, "g", "id", "score").toPandas().set_index("fund_id")
    known = pdf.dropna()
    assert len(got) == len(known)
    for _, g in known.groupby("g"):
        want = g.score.rank(method="min", ascending=False).astype(int)
        assert (got.loc[g.id, "rank"].to_numpy() == want.to_numpy()).all()
        ordered = g.sort_values(["score", "id"], ascending=[False, True]).id.to_numpy()
        tiles = np.concatenate([np.full(len(c), k + 1) for k, c in enumerate(np.array_split(ordered, 10))])
        assert (got.loc[ordered, "decile"].to_numpy() == tiles).all()


def test_one_score_for_all_rows_spans_tasks(spark):
    """The run of a tie that fills several tasks starts where its first task has it."""
    ids = spark.range(20000).repartition(8)
    hot = ids.select(F.lit("a").alias("g"), "id", F.when(F.col("id") < 50, F.col("id") + 1.0).otherwise(0.5).alias("score"))
    got = ordering.rank_and_decile(hot, "g", "id", "score")
    assert got.where("expected_alpha = 0.5").select("rank").distinct().collect() == [(51,)]
    assert got.where("expected_alpha > 0.5").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (1, 50, 50)
    placed = ordering.global_positions(hot.drop("g"), [F.col("score"), F.col("id")], "at", runs=["score"])
    assert {r[0] for r in placed.where("score = 0.5").select("at_run").distinct().collect()} == {0}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MergeJoin [g" not in plan.replace("g#", "g") or "score" not in plan.split("MergeJoin")[1].split("\n")[0]


def test_tiles_of_a_group_smaller_than_the_tiles(spark):
    df = spark.createDataFrame([("a", k, float(k)) for k in range(4)], "g string, id int, score double")
    got = ordering.rank_and_decile(df, "g", "id", "score").orderBy("rank").toPandas()
    assert got.decile.tolist() == [1, 2, 3, 4]


def test_global_positions_number_every_row_once(spark):
    df = spark.range(0, 5000).withColumn("hot", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40))
    placed = ordering.global_positions(df, [F.col("hot"), F.col("id").desc()]).toPandas()
    want = placed.sort_values(["hot", "id"], ascending=[True, False])
    assert want.position.tolist() == list(range(5000))


def test_top_and_bottom_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 3.0)], "k string, v double")
    got = ordering.top_and_bottom(df, "v", "k", 2).collect()
    assert [(r["k"], r["side"]) for r in got] == [("c", "top"), ("d", "top"), ("a", "bottom"), ("c", "bottom")]


def test_spot_check_is_repeatable(spark):
    df = spark.range(1000)
    first = ordering.spot_check_sample(df, ["id"], 20).collect()
    assert first == ordering.spot_check_sample(df.repartition(7), ["id"], 20).collect()
    assert first != ordering.spot_check_sample(df, ["id"], 20, seed=7).collect()
