"""Merkle manifest of a table: a hash tree for each group of rows, a tree over the groups, and every row's proof.

Rows of a group stand in the order of their key; each run of `FANOUT` consecutive nodes becomes one node, the
SHA-256 of their digests as hex text, until one is left, the group's subroot. Subroots, by group, form a tree of
the same kind up to the root.

A level is a table of nodes with their place in the group and the group's number of nodes. Lag and lead columns
of the offsets 1 to `FANOUT` - 1, masked by the node's slot and the length of its run, hold its siblings; the
first child of each run hashes the parent. A window spans `BLOCK` nodes, a whole number of runs, whatever the
size of the group. From the top down each level then takes its parents' paths by (group, place of the parent).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.operators.ordering import global_positions
from fundloom.session import materialize

#: Nodes that make one parent.
FANOUT = 8
#: Nodes that one window holds.
BLOCK = FANOUT**3
#: Groups whose sizes are broadcast; more are joined.
FEW_GROUPS = 10_000
_STEP = "array<struct<left:string,right:string>>"


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of texts in UTF-8, one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def value_text(value: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(*[value_text(v) for v in values])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf has under a path of siblings."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_text(path: Column) -> Column:
    """The siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _above(count: Column) -> Column:
    return F.ceil(count / FANOUT).cast("long")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """`left` and `right`: digests of the node's siblings before and after it."""
    nodes = nodes.withColumn("block", F.floor(F.col("at") / BLOCK)).repartition("group", "block")
    near = Window.partitionBy("group", "block").orderBy("at")
    slot = F.col("at") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("at") + slot)
    steps = range(1, FANOUT)
    before = [F.when(slot >= k, F.lag("node", k).over(near)) for k in reversed(steps)]
    after = [F.when(slot + k < length, F.lead("node", k).over(near)) for k in steps]
    # concat_ws leaves nulls out
    near_ones = {"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)}
    return nodes.withColumns(near_ones).drop("block")


def _numbered(rows: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, int]:
    """`at` and `n`: the place in the group and the group's number of rows; and the largest such number."""
    placed = global_positions(rows, order, "place")
    groups = placed.groupBy("group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    most, count = groups.agg(F.max("n"), F.count("n")).first()
    most = most or 0
    if count <= FEW_GROUPS:
        groups = F.broadcast(groups)  # else the join goes by measured size, and a hot group is split as skew
    numbered = placed.join(groups, "group").withColumn("at", F.col("place") - F.col("first"))
    return numbered.drop("place", "first"), most


def _levels(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees from the leaves up, as written tables, and the top of each with its height."""
    levels, tops = [], []
    while True:
        tops.append(nodes.where(F.col("n") == 1).select("group", "node", F.lit(len(levels)).alias("height")))
        if most <= 1:
            return levels, reduce(DataFrame.unionByName, tops)
        level = materialize(_with_siblings(nodes.where(F.col("n") > 1)))
        levels.append(level)
        nodes = level.where(F.col("at") % FANOUT == 0).select(
            "group", _above(F.col("n")).alias("n"), F.floor(F.col("at") / FANOUT).alias("at"),
            digest(F.col("node"), F.col("right")).alias("node"),
        )
        most = -(-most // FANOUT)


def _downward(levels: list[DataFrame], leaves: DataFrame, tops: DataFrame) -> DataFrame:
    """Each leaf with the path of its siblings, then what `tops` has above the top of its tree.

    tops: group, height, path, and columns that every leaf of the group gets.
    """
    given = [c for c in tops.columns if c not in ("group", "height", "path")]

    def at_height(k: int) -> DataFrame:
        return tops.where(F.col("height") == k).select("group", F.lit(0).cast("long").alias("up"), "path", *given)

    parents = at_height(len(levels))
    for k in reversed(range(len(levels))):
        own = F.array(F.struct("left", "right")).cast(_STEP)
        nodes = levels[k].withColumn("up", F.floor(F.col("at") / FANOUT)).join(parents, ["group", "up"])
        nodes = nodes.withColumn("path", F.concat(own, "path")).drop("left", "right", "up")
        if k:
            parents = nodes.select("group", F.col("at").alias("up"), "path", *given).unionByName(at_height(k))
    alone = leaves.where(F.col("n") == 1).join(at_height(0).drop("up"), "group")
    return nodes.unionByName(alone) if levels else alone


def manifest(
    docs: DataFrame, columns: Sequence[str], key: str = "doc_id", group: str = "lang", **carried: Column
) -> DataFrame:
    """One row for each row of `docs`: key, group, leaf, path, subroot and root, and the `carried` columns.

    A leaf is the digest of `columns`. `path` lists the siblings on the way up, a struct of those to the left and
    to the right for each level, through the subroot to the root. Within a group leaves stand by key, null first,
    then by digest; equal rows are leaves of their own and interchangeable. Null is a group, before all others;
    groups go by the bytes of their text. A group of one row has that leaf as subroot, and a table of one group has
    its subroot as root. An empty table has an empty manifest. Other columns of `docs` are not read.
    """
    named = lambda c: F.col(f"`{c}`")
    whole = docs.select(
        named(key).alias("key"),
        F.coalesce(F.concat(F.lit("+"), named(group).cast("string")), F.lit("")).alias("group"),
        leaf_digest([named(c) for c in columns]).alias("node"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in carried.items()]).alias("carried"),
        F.monotonically_increasing_id().alias("tie"),  # tells equal rows apart, so that a range sort can split them
    )
    rows = materialize(whole)
    order = ["group", F.asc_nulls_first("key"), "node", "tie"]
    leaves, most = _numbered(rows, [F.col(o) if isinstance(o, str) else o for o in order])
    leaves = leaves.drop("tie")
    levels, tops = _levels(leaves, most)
    heads = materialize(tops.withColumnsRenamed({"group": "own", "node": "subroot"}).withColumn("group", F.lit("")))
    roots, count = _numbered(heads.withColumn("node", F.col("subroot")), [F.col("own")])
    upper, top = _levels(roots, count)
    empty = F.array().cast(_STEP)
    top = top.withColumns({"path": empty, "root": F.col("node")}).drop("node")
    with_path = _downward(upper, roots, top.select("group", "height", "path", "root"))
    heads = materialize(with_path.select(F.col("own").alias("group"), "height", "path", "subroot", "root"))
    found = _downward(levels, leaves, heads)
    return found.select(
        F.col("key").alias(key),
        F.when(F.col("group") != "", F.substring("group", 2, 2**31 - 1)).alias(group),
        F.col("node").alias("leaf"), "path", "subroot", "root",
        *[F.col(f"carried.`{name}`").alias(name) for name in carried],
    )
