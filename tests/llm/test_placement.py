"""Shards, mixtures and neighbours."""

import math

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from fundloom.llm import forest, mixing, sharding
from fundloom.llm.catalog import ORACLES, QUERIES

# Shards


def plain_jump(key, shards):
    key, at, j = (key or 0) % 2**64, -1, 0
    while j < shards:
        at = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_shard_query_agrees_with_sql(spark, sf_dir):
    got = QUERIES["op9_jump_hash_shards"](spark, sf_dir).toPandas()
    assert difference(got, connect(sf_dir).execute(ORACLES["op9_jump_hash_shards"]).df()) is None


def test_jump_hash(spark):
    keys = [None, 0, 1, -1, 2**63 - 1, -(2**63), *range(1000, 3000)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 17, 100):
        got = {r.k: r.s for r in frame.select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()}
        assert got == {k: plain_jump(k, shards) for k in keys}


def test_shard_edges(edges, clashing, empty):
    rows = sharding.shard_documents(clashing, 4).collect()
    assert len(rows) == edges.count() and rows[0].row == "own row"
    for s in range(4):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    for r in rows:
        assert r.shard == plain_jump(r.doc_id, 4) and r.grown_shard in (r.shard, 4)
        assert r.size == len((r.text or "").encode()) + 1
    assert sharding.shard_documents(empty, 4).count() == 0


def test_rows_of_one_key_lie_in_many_windows(spark, monkeypatch):
    """A third of all rows without a key: slots are gapless, and no window holds more than a few."""
    seen = []
    plain = sharding.numbered

    def watched(df, group, block, order, name):
        seen.append(df.groupBy(*group, block.alias("b")).count().agg(F.max("count")).first()[0])
        return plain(df, group, block, order, name)

    monkeypatch.setattr(sharding, "numbered", watched)
    rows = [(None if k % 3 == 0 else k, f"text {k}") for k in range(3000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert len(got) == 3000 and seen[0] < 20
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


# Mixtures


@pytest.mark.parametrize("shares", [{"a": 5, "b": 3, "c": 2}, {"a": 997, "b": 2, "c": 1}, {f"s{i}": 1 + i * i for i in range(20)}])
def test_every_source_stays_within_one_block_of_its_share(shares):
    total = sum(shares.values())
    by_slot = {t: s for s, places in mixing.earliest_deadline_first(shares).items() for t in places}
    assert sorted(by_slot) == list(range(total))
    done = dict.fromkeys(shares, 0)
    for t in range(total):
        done[by_slot[t]] += 1
        for s, m in shares.items():
            assert abs(done[s] - m * (t + 1) / total) < 1


def test_plan_places_every_block_once_and_in_order():
    shares, blocks = {"a": 5, "b": 3, "c": 2}, {"a": 17, "b": 40, "c": 1}
    made = mixing.plan(shares, blocks)
    slots = {s: [made.slot(s, j) for j in range(n)] for s, n in blocks.items()}
    assert sorted(t for places in slots.values() for t in places) == list(range(sum(blocks.values())))
    assert all(places == sorted(places) for places in slots.values())


def test_mixture_query(spark, sf_dir, local_documents):
    """Against the schedule run slot by slot with the same weights."""
    got = QUERIES["op5_pfair_mixture"](spark, sf_dir).toPandas().sort_values("position")
    assert got.position.tolist() == list(range(len(local_documents)))
    assert sorted(got.doc_id) == local_documents.doc_id.tolist()
    counts = {f"={s}": n for s, n in local_documents.source.value_counts().items()}
    blocks = {s: math.ceil(n / mixing.BLOCK_ROWS) for s, n in counts.items()}
    made = mixing.plan(mixing.target_shares(counts), blocks)
    for r in got.itertuples():
        assert made.slot(f"={r.source}", r.block) == r.slot
    assert (got.groupby("slot").source.nunique() == 1).all()


def test_weights_are_met_while_all_sources_last(spark):
    sizes = {"a": 3000, "b": 500, None: 100, "other": 50}
    rows = [(k * 10_000 + i, s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string").repartition(5)
    got = mixing.mix(frame, {"a": 6, "b": 3, None: 1}, block_rows=10).toPandas().sort_values("position")
    assert got.position.tolist() == list(range(len(rows)))
    name = got.source.fillna("none")
    for slots in range(1, 60):
        head = got[got.slot < slots]
        share = name[head.index].value_counts() / 10
        # the source without a weight is mixed at the smallest one, 1 of 11
        for s, m in {"a": 6, "b": 3, "none": 1, "other": 1}.items():
            assert abs(share.get(s, 0) - m * slots / 11) < 1 + 1e-9
    again = mixing.mix(frame.repartition(2), {"a": 6, "b": 3, None: 1}, block_rows=10).toPandas()
    assert again.sort_values("position").doc_id.tolist() == got.doc_id.tolist()


def test_mixture_edges(edges, clashing, empty, monkeypatch):
    rows = mixing.mix(clashing, block_rows=2).collect()
    assert sorted(r.position for r in rows) == list(range(edges.count())) and rows[0].row == "own row"
    assert mixing.mix(empty).count() == 0 and mixing.in_mixed_order(empty).count() == 0
    ordered = mixing.in_mixed_order(clashing)
    assert ordered.columns == clashing.columns and ordered.count() == clashing.count()
    monkeypatch.setattr(mixing, "SOURCES", 1)  # all but the largest source stand in classes
    few = mixing.mix(edges, block_rows=2).collect()
    assert sorted(r.position for r in few) == list(range(edges.count()))


def test_any_number_of_sources_stay_within_one_block_of_their_shares(spark):
    """One source with a third of the rows, and more small ones than are scheduled one by one."""
    sizes = {"hot": 9000, None: 151, **{f"s{k}": 40 + 3 * (k % 90) for k in range(260)}}
    names = [s for s, n in sizes.items() for _ in range(n)]
    frame = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string").repartition(6)
    rows, most = 4, 0.0
    got = mixing.mix(frame, block_rows=rows).toPandas().sort_values("position")
    assert got.position.tolist() == list(range(len(names))) and sorted(got.doc_id) == list(range(len(names)))
    source = got.source.fillna("none").to_numpy()
    counts = {("none" if s is None else s): n for s, n in sizes.items()}
    largest = sorted(counts, key=lambda s: (-counts[s], s != "none", s))[: mixing.SOURCES]
    named = {s: "null" if s == "none" else f"={s}" for s in counts}
    kind = {s: named[s] if s in largest else f"rest {math.floor(mixing.CLASSES * math.log2(n))}" for s, n in counts.items()}
    weight = {}
    for s, n in counts.items():
        weight[kind[s]] = weight.get(kind[s], 0) + math.sqrt(n)
    shares = mixing.whole_shares(weight)
    target = {s: shares[kind[s]] / sum(shares.values()) * math.sqrt(n) / weight[kind[s]] for s, n in counts.items()}
    ends = {}
    for at, s in enumerate(source):
        ends[s] = at
    stop = min(ends.values()) // rows  # until the first source ends
    assert stop > 100
    done = dict.fromkeys(counts, 0)
    for slot in range(stop):
        for s in source[slot * rows : (slot + 1) * rows]:
            done[s] += 1
        most = max(most, *(abs(done[s] / rows - target[s] * (slot + 1)) for s in counts))
    assert most < 1


# Neighbours


def plain_neighbours(rows, query, point, nearest):
    near = sorted((math.dist(point, v), i) for i, v in rows if i != query)
    return [(i, d) for d, i in near[:nearest]]


def test_forest_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = forest.nearest_neighbours(table, every=20).toPandas()
    queries = [(r.vec_id, list(r.embedding)) for r in table.where("vec_id % 20 = 0").collect()]
    want = forest.exact_neighbours(table, queries).toPandas()
    hits = got.merge(want, on=["query_id", "vec_id"])
    assert len(hits) >= 0.9 * len(want)
    assert np.allclose(hits.score_x, hits.score_y, rtol=1e-12)
    assert (got.groupby("query_id")["rank"].max() == 10).all()


def recall(spark, points, every):
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = forest.nearest_neighbours(frame, every=every).toPandas()
    shares = {}
    for q in range(0, len(points), every):
        near = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        near[q] = np.inf
        shares[q] = len(set(np.argsort(near)[:10]) & set(got[got.query_id == q].vec_id)) / 10
    return shares


def test_forest_recall_in_many_clusters(spark, monkeypatch):
    """The longest prefixes find what is near, without reading everything."""
    monkeypatch.setattr(forest, "BLOCK", 128)
    monkeypatch.setattr(forest, "WINDOW", 32)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16))
    points = np.repeat(centres, 40, axis=0) + rng.normal(scale=0.05, size=(2400, 16))
    assert np.mean(list(recall(spark, points, 100).values())) >= 0.9


@pytest.mark.parametrize("noise", [0.0005, 0.005, 0.05])
def test_forest_recall_in_one_hot_cluster(spark, monkeypatch, noise):
    """A third of all vectors around one direction: their prefixes fill many blocks, all of which are read."""
    monkeypatch.setattr(forest, "BLOCK", 64)
    monkeypatch.setattr(forest, "WINDOW", 32)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(3000, 32)) * rng.uniform(0.5, 2, size=(3000, 1))
    points[::3] = points[0] + rng.normal(scale=noise, size=(1000, 32))
    shares = recall(spark, points, 50)
    assert np.mean([v for q, v in shares.items() if q % 3 == 0]) >= 0.9
    assert np.mean([v for q, v in shares.items() if q % 3]) >= 0.9


def test_prefixes_are_long_enough_for_the_angle():
    """Two vectors at the widest angle for a prefix share one in some tree as often as it is said."""
    rng = np.random.default_rng(5)
    axes = forest.axes_of(24)
    one, other = rng.normal(size=(2, 1500, 24))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    for n in (1, 3, 10):
        angle = forest.widest_angles()[n - 1]
        same = forest.hash_symbols(one, axes) == forest.hash_symbols(np.cos(angle) * one + np.sin(angle) * other, axes)
        assert same[:, :, :n].all(axis=2).any(axis=1).mean() == pytest.approx(forest.FOUND, abs=0.03)


def test_forest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (None, [1.0, 0.1]), (7, []), (8, [1.0, 0.0, 0.0]), (9, [0.0, 2.0]), (100, [0.0, 1.0]),
    ]
    rows += [(k, [5.0, 5.0]) for k in range(200, 260)]  # many copies: ties fall to the smaller keys
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("own"))
    got = forest.nearest_neighbours(frame, every=100).toPandas().sort_values(["query_id", "rank"])
    part = [(i, v) for i, v in rows if i in (0, 1, 9, 100) or i is not None and i >= 200]
    part = sorted({(i, tuple(v)) for i, v in part})
    for query in (0, 100, 200):
        want = plain_neighbours(part, query, dict(part)[query], 10)
        mine = got[got.query_id == query]
        assert list(zip(mine.vec_id, mine["rank"])) == [(i, k + 1) for k, (i, _) in enumerate(want)]
        assert np.allclose(mine.score, [d for _, d in want])
    assert set(got.query_id) == {0, 100, 200}
    assert forest.nearest_neighbours(frame.limit(0)).count() == 0
    assert forest.nearest_neighbours(frame.where("vec_id = 100")).count() == 0
