"""Reversed search against a version that scores every document for every item."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fundloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, most=10):
    counted = [(k, Counter(terms(t))) for k, t in docs]
    counted = [(k, c, sum(c.values())) for k, c in counted if c]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for key, text in items:
        wanted.setdefault(key, set()).update(terms(text))
    found = []
    for key, own in wanted.items():
        ranked = []
        for doc, c, length in counted:
            m = 100 - 90 + (90 * length * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in own
                if t in c
            )
            if score > 0:
                ranked.append((-score, doc is not None, doc or 0, doc))
        found += [(key, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(ranked)[:most])]
    return sorted(found, key=str)


def run(spark, docs, items, **settings):
    got = lexical.ranked_search(docs, items, **settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )


ITEMS = [(1, "the River"), (2, "Fluss Mühle the the"), (3, None), (4, ""), (5, "!!! ..."), (None, "mill"), (2, "word 678"), (6, "nowhere")]


def test_edges(spark, edges, clashing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    expected = brute_force(rows, ITEMS)
    assert expected and run(spark, edges, items) == expected
    named = clashing.withColumns({c: F.lit(2) for c in "number score doc rank part item item_id".split()})
    assert run(spark, named, items.withColumns({"doc_id": F.lit(1), "terms": F.lit(2)})) == expected


@pytest.mark.parametrize("settings", [{}, {"postings": 7}, {"index_bytes": 10}, {"most": 1}, {"most": 1000}])
def test_random_texts(spark, settings):
    """Many ties: a third of the documents are copies; frequent and rare words; several blocks of items."""
    rng = random.Random(3)
    words = ["a", "A1", "né", "日本", "x_y", "zz", "\x85q", "İ", "b-c"] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, range(70, 1, -1), k=rng.randint(0, 60)))) for i in range(400)]
    docs += [(i, "a w3 w3 né") for i in rng.sample(range(1000, 9000), 200)] + [(None, "a w3 w3 né"), (-5, "a w3 w3 né"), (1001, None)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(12)]
    most = settings.get("most", 10)
    assert run(spark, *frames(spark, docs, items), **settings) == brute_force(docs, items, most)


def test_bounded_heaps_meet_in_parts(spark):
    """However many tasks, an item's rows in one merge are a few for each part."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text")).repartition(90)
    items = spark.createDataFrame([(1, "same")], "item_id long, text string")
    assert run(spark, docs, items) == brute_force([(i, "same text") for i in range(3000)], [(1, "same")])


def test_long_text_in_pieces(monkeypatch):
    text = "Abc dé, x9 " * 50
    whole = [t for part in lexical.terms_of(text.encode()) for t in part]
    monkeypatch.setattr(lexical, "PIECE", 7)
    pieces = [t for part in lexical.terms_of(text.encode()) for t in part]
    assert pieces == whole == [t.encode() for t in terms(text)]


def test_empty_tables(spark, empty, edges):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(spark, empty, items) == []
    assert run(spark, edges, items.limit(0)) == []
    assert run(spark, edges.where("text is null"), items) == []
