"""Connected components of a graph that may have hubs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fundloom.session import materialize


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `edges` (u, v: long): the smallest node of its component.

    Large and small stars in turn until nothing changes, each round a table in the shared folder. A hub is
    one row after the map-side minimum; the minima are tables too, so that the join of a hub's many neighbours
    with its minimum is split by size.
    Only the number of edges and a checksum reach the driver.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(pairs.distinct())
    seen = _checksum(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct())
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        now = materialize(small.where("u <> v").distinct())
        before, seen = seen, _checksum(now)
        if before == seen:
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)
