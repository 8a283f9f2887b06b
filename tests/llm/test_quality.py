"""Quality by attention over passages: slopes, accuracy on held-out rows, odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundloom.llm import quality

LABELS = "doc_id long, quality int"


def test_gradient_agrees_with_differences():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 255, n).astype(np.uint8).tobytes() for n in (0, 3, 600, 1500)]
    rows, lengths, owner = next(quality.passages(texts))
    x, y = quality.features(rows, lengths).astype(float), np.array([1.0, 0, 1, 0])
    shapes = [(quality.FEATURES, 5), (5,), (5, 4), (5, 4), (4,), (5,), (1,)]
    w = [rng.normal(0, 0.5, s) for s in shapes]
    _, slopes = quality.gradient(w, x, owner, y)
    for v, slope in zip(w, slopes):
        flat = np.abs(slope).ravel().argsort()[-3:]
        for at in flat:
            step = np.zeros(v.size)
            step[at] = 1e-5
            step = step.reshape(v.shape)
            up = quality.gradient([a + step if a is v else a for a in w], x, owner, y)[0]
            down = quality.gradient([a - step if a is v else a for a in w], x, owner, y)[0]
            assert (up - down) / 2e-5 == pytest.approx(slope.ravel()[at], rel=1e-4, abs=1e-9)


def test_attention_is_a_share_of_each_text():
    owner = np.array([0, 0, 1, 2, 2, 2])
    a = quality.shares(np.array([1.0, 2, 500, -3, 0, 3]), np.array([0, 2, 3]), owner)
    assert np.bincount(owner, a) == pytest.approx([1, 1, 1]) and a[2] == 1


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.rate_documents(docs, labels).select("doc_id", "held_out", "score", "predicted")
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").toPandas()
    assert len(rows) > 90 and (rows.predicted == rows.quality).mean() >= 0.97
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def test_scores_depend_on_the_text_alone(spark, edges):
    """Held-out labels, sources and ids change nothing; equal texts have equal scores, whatever stands beside them."""
    rows = edges.where("doc_id is not null").select("doc_id", "text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)], LABELS)
    held = labels.withColumn("quality", F.when(quality.may_learn(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    a = {(r.doc_id, r.text): r.score for r in quality.rate_documents(rows, labels).collect()}
    b = {(r.doc_id, r.text): r.score for r in quality.rate_documents(rows.repartition(7), held).collect()}
    assert a == b
    net = quality.fit(rows, labels)
    again = quality.rate_documents(rows.withColumn("doc_id", F.col("doc_id") + 1000), labels, fitted=net).collect()
    assert {r.text: r.score for r in again} == {t: s for (_, t), s in a.items()}


def test_edges(spark, edges, clashing, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (5, None), (None, 1), (6, 0), (6, 0), (99, 1)], LABELS)
    found = quality.rate_documents(edges, labels)
    assert found.columns == [*edges.columns, "held_out", "score", "predicted"] and found.count() == edges.count()
    assert found.where("score is null or score < 0 or score > 1 or predicted is null").count() == 0
    by_text = {r.text: r.score for r in found.collect()}
    assert by_text[None] == by_text[""]
    taken = quality.rate_documents(clashing.withColumns({"score": F.lit("own"), "found": F.lit("own")}), labels)
    assert {r.text: r.score for r in taken.collect()} == by_text
    assert {r["found"] for r in taken.collect()} == {"own"}
    assert quality.rate_documents(empty, labels).count() == 0


@pytest.mark.parametrize("rows, expected", [([], 0.5), ([(1, 1), (2, 1), (9, 1)], 1.0), ([(1, 0), (2, 0), (9, 0)], 0.0), ([(1, None)], 0.5)])
def test_one_label_or_none(spark, edges, rows, expected):
    found = quality.rate_documents(edges, spark.createDataFrame(rows, LABELS)).collect()
    assert {r.score for r in found} == {expected} and {r.predicted for r in found} == {int(expected >= 0.5)}


def test_long_text_in_parts():
    """Passages come in bounded parts, and the parts of a text share one attention."""
    text = bytes(range(256)) * (quality.PASSAGE * quality.WIDE // 128)
    parts = list(quality.passages([b"short", text, b""]))
    assert len(parts) > 1 and max(len(rows) for rows, *_ in parts) <= 2 * quality.WIDE
    assert b"".join(bytes(r[:n]) for rows, lengths, _ in parts for r, n in zip(rows, lengths)) == b"short" + text
    assert [int(o[0]) for *_, o in parts] == sorted(int(o[0]) for *_, o in parts)
