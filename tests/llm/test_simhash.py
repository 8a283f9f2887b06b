"""Fingerprints, links and groups against brute force, also where keys overflow and copies abound."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fundloom.llm import simhash
from fundloom.llm.catalog import QUERIES
from fundloom.llm.components import components


def plain_fingerprint(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ x) <= max_bits).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark, sf_dir, local_documents):
    got = QUERIES["op1_simhash_near_duplicates"](spark, sf_dir).toPandas().set_index("doc_id")
    fps = np.array([plain_fingerprint(t, 4) for t in local_documents.text], np.uint64)
    ids = local_documents.doc_id.tolist()
    groups = plain_components(fps, 4)
    for k, doc_id in enumerate(ids):
        assert got.fingerprint[doc_id] == f"{int(fps[k]):016x}"
        assert got.component_id[doc_id] == ids[groups[k]]


@pytest.mark.parametrize("most", [32_768, 3])
@pytest.mark.parametrize("max_bits, spare", [(4, 4), (6, 3)])
def test_links_connect_what_is_near(spark, monkeypatch, most, max_bits, spare):
    """Chains, a dense ball and strangers; with a small `most` every key is cut finer."""
    monkeypatch.setattr(simhash, "KEY_ROWS", most)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    ball = [int(centre) ^ sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 6), replace=False)) for _ in range(150)]
    chain = [int(rng.integers(0, 2**63))]
    for _ in range(20):
        chain.append(chain[-1] ^ sum(1 << int(b) for b in rng.choice(64, max_bits, replace=False)))
    fps = np.unique(np.array([*ball, *chain, *rng.integers(0, 2**63, 100).tolist()], np.uint64))
    frame = spark.createDataFrame([(int(x.view(np.int64)),) for x in fps], "fp long")
    found = components(simhash.near_links(frame, max_bits, spare))
    got = {r.node: r.root for r in found.collect()}
    signed = fps.view(np.int64).tolist()
    mine: dict[int, set] = {}
    for x in signed:
        mine.setdefault(got.get(x, x), set()).add(x)
    want: dict[int, set] = {}
    for x, g in zip(signed, plain_components(fps, max_bits)):
        want.setdefault(g, set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(1001, 1300)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[k] == 1000 for k in range(1000, 1300))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_edges(edges, empty):
    rows = simhash.near_duplicates(edges, words=4).collect()
    assert len(rows) == edges.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert by_id[4].fingerprint == by_id[5].fingerprint == by_id[6].fingerprint == "0" * 16
    assert by_id[4].component_id == by_id[6].component_id == 4
    assert simhash.near_duplicates(empty).count() == 0


def near(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def test_one_of_each_keeps_one_of_each_group(documents, local_documents):
    kept = set(simhash.one_of_each(documents).toPandas().doc_id)
    rows = [(i, t) for i, t in zip(local_documents.doc_id, local_documents.text) if t and t.split()]
    alike = [(a, b) for k, (b, y) in enumerate(rows) for a, x in rows[:k] if near(x, y) >= 0.8]
    groups: dict[int, int] = {}
    for a, b in sorted(alike):
        groups[b] = groups.get(a, a)
    gone = {b for _, b in alike}
    assert not gone & kept
    assert kept >= {i for i, _ in rows} - gone


def test_one_of_each_edges(edges, clashing, empty):
    rows = simhash.one_of_each(clashing).collect()
    ids = sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    # equal texts: 2 goes; one of the repeated rows stays; texts without words are one group under a null key
    assert 2 not in ids and ids.count(3) == 1 and ids.count(1) == 1
    assert rows[0].row == "own row" and set(rows[0].asDict()) == set(clashing.columns)
    assert {7, 8, 9} <= set(ids)
    assert simhash.one_of_each(empty).count() == 0
    many = edges.where("doc_id = 1").select(F.explode(F.sequence(F.lit(100), F.lit(700))).alias("doc_id"), "text", "lang", "source", "n_chars")
    assert [r.doc_id for r in simhash.one_of_each(many).collect()] == [100]


def plain_groups(texts):
    """Components over all pairs by all their shingles."""
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if root[i] != root[j] and both >= 0.8 * (len(a) + len(b) - both):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def parted(spark, texts):
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.group) for r in simhash.near_groups(frame).collect()}
    assert len({g for _, g in got.values()}) == len({c for c, _ in got.values()})
    return [got[i][0] for i in range(len(texts))]


def test_appended_cut_and_replaced_copies_are_found(spark):
    """Copies at every similarity from 0.75 up, whatever the edit: the groups are those of all pairs."""
    rng = np.random.default_rng(8)
    fresh = lambda n: [f"w{k}" for k in rng.integers(0, 5000, n)]
    texts = []
    for n in rng.integers(20, 600, 20).tolist():
        for share in (0.05, 0.12, 0.18):
            t, m = fresh(n), max(1, int(share * n))
            texts += [t, t + fresh(m)]
            texts += [t := fresh(n), t[m:]]
            texts += [t := fresh(n), t[: n // 3] + fresh(m // 2) + t[n // 3 + m // 2 :]]
    want = plain_groups(texts)
    assert sum(i != c for i, c in enumerate(want)) > 120
    assert parted(spark, texts) == want


@pytest.mark.parametrize("most", [64_000_000, 3_000])
def test_copies_in_loose_groups_are_found(spark, monkeypatch, most):
    """Copies among many texts of the same words in other order, and among many that share most of a template; with
    few bytes for a key most are cut finer."""
    monkeypatch.setattr(simhash, "KEY_BYTES", most)
    rng = np.random.default_rng(9)
    words, template = ([f"{c}{k}" for k in range(150)] for c in "vt")
    texts = []
    for family in range(30):
        t = rng.permutation(words).tolist()
        texts += [t, [*t[:70], t[71], t[70], *t[72:]]]  # near copies
        t = [*template, *(f"f{family}x{k}" for k in range(34))]
        texts += [t, [*t, "end"]]
    want = plain_groups(texts)
    assert sorted(want.count(c) for c in set(want)) == [2] * 60
    assert parted(spark, texts) == want


def test_one_of_each_keeps_rows_of_other_groups_under_the_same_key(spark):
    rng = np.random.default_rng(10)
    a, b, c, d = ([f"{n}{k}" for k in rng.integers(0, 900, 60)] for n in "abcd")
    rows = [(None, a), (None, b), (7, c), (7, d), (3, [*d, "end"]), (7, c), (8, [*c, "end"])]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text[0]) for r in simhash.one_of_each(frame).collect()), key=str)
    assert kept == [(3, "d"), (7, "c"), (None, "a"), (None, "b")]


def test_fingerprints_alone_find_close_copies(spark, monkeypatch):
    """Copies whose fingerprints link are grouped also if no band serves them, and only if their shingles are alike."""
    monkeypatch.setattr(simhash, "_signature", lambda hashes: np.arange(100, dtype=np.uint32) + np.uint32(hashes[0] >> np.uint64(33)))
    monkeypatch.setattr(simhash, "MARGIN", 1.0)
    rng = np.random.default_rng(11)
    texts = []
    for k in range(20):
        t = [f"{k}w{i}" for i in rng.integers(0, 900, 300)]
        texts += [t, [f"{k}new", *t]]
    prints = [simhash.text_fingerprint(" ".join(t), 5) for t in texts]
    linked = [i for i in range(20) if (prints[2 * i] ^ prints[2 * i + 1]).bit_count() <= 4]
    assert len(linked) > 15
    got = parted(spark, texts)
    assert all(got[2 * i + 1] == 2 * i for i in linked)
    assert all(g in (i, i - 1) for i, g in enumerate(got))
