"""Merkle manifest against a version in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fundloom.llm import catalog, merkle

COLUMNS = catalog.LEAF_COLUMNS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    text = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    return sha(text)


def tree(nodes):
    """The top of a tree and the path, (left, right) by level, of every node."""
    paths, where = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owners = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in where[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            owners.append([i for k in range(len(run)) for i in where[at + k]])
        nodes, where = above, owners
    return nodes[0], paths


def brute_force(rows):
    """Rows of the query: rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault("" if row[2] is None else "+" + row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda g: g.encode())
    tops = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, upper = tree([tops[g][0] for g in names])
    found = []
    for g, above in zip(names, upper):
        for (_, _, own, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), tops[g][1]):
            path = path + above
            node = own
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 3 == 0 and row[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                node = leaf((*row[:4], low))
            for left, right in path:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path))
            found.append((row[0], own, tops[g][0], root, proof, node, node == root))
    return sorted(found, key=str)


def run(spark, monkeypatch, df):
    monkeypatch.setattr(catalog, "read", lambda *_: df)
    got = catalog.op11(spark, "").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_edges(spark, monkeypatch, edges, clashing):
    rows = [tuple(r) for r in edges.select(*COLUMNS).collect()]
    expected = brute_force(rows)
    assert run(spark, monkeypatch, edges) == expected
    taken = clashing.withColumns({c: F.lit(1) for c in "key group node carried tie at n place path root own up left".split()})
    assert run(spark, monkeypatch, taken) == expected


@pytest.mark.parametrize("sizes", [[1], [8, 9], [700, 1, 64, 65, 3, 2, 1, 1, 1, 8], [513, 512]])
def test_tree_shapes(spark, monkeypatch, sizes):
    """Runs that end early, lone rows, more than eight groups, groups of several windows; a third with the null key."""
    rows = []
    for g, size in enumerate(sizes):
        for i in range(size):
            rows.append((None if i % 3 == 0 else 7 * i + g, f"S{i % 2}", None if g == 1 else f"l{g}", i, f"Text É {i % 5}"))
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert run(spark, monkeypatch, df.repartition(5)) == brute_force(rows)


def test_equal_rows_are_split(spark, monkeypatch):
    """Rows that are all the same: each is a leaf of its own, and they do not meet in one window."""
    rows = [(1, "a", "en", 3, "Abc")] * 1500
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert run(spark, monkeypatch, df) == brute_force(rows)
    assert merkle.BLOCK < len(rows)


def test_manifest_proves_rows(spark, edges):
    """A proof folds to the root; another row's does not."""
    found = merkle.manifest(edges, ["doc_id", "text"], key="doc_id", group="source").collect()
    roots = {r.root for r in found}
    assert len(found) == edges.count() and len(roots) == 1
    for r in found:
        node, other = r.leaf, sha("x")
        for step in r.path:
            node, other = sha(step.left + node + step.right), sha(step.left + other + step.right)
        assert node == r.root != other


def test_empty(spark, monkeypatch, empty):
    assert run(spark, monkeypatch, empty) == []
