"""Approximate nearest neighbours by a hash-prefix forest.

Each tree is a sorted array of long hash strings, one for each distinct vector. A query descends to its own place in
every tree, where its longest-prefix matches stand: the nearest of them bound the distance of what it seeks. From
there it ascends in all trees at once, to the longest prefix under which a vector at that distance is met with
probability `FOUND`, and reads all entries with this prefix, as many blocks as they fill. If that is more than all
vectors, or no prefix is enough, it reads one tree whole. All distances are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.llm.common import small_batches
from fundloom.operators.ordering import global_positions
from fundloom.session import materialize

#: Trees, symbols of a hash string, and axes that a symbol chooses from.
TREES, SYMBOLS, AXES = 16, 24, 16
#: Entries of a block of the sorted arrays, the unit that is read; entries around its place that a query looks at first.
BLOCK, WINDOW = 4096, 256
#: Least probability that an entry as far away as the bound has the prefix of a query in some tree.
FOUND = 0.93
SEED = 11


def axes_of(dim: int) -> np.ndarray:
    """(dim, TREES * SYMBOLS * AXES): random axes, of which each symbol has its own."""
    rng = np.random.default_rng((SEED, dim))
    return rng.standard_normal((dim, TREES * SYMBOLS * AXES), dtype=np.float32)


def hash_symbols(vectors: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """(vectors, TREES, SYMBOLS) bytes: the axis with the largest product, by its sign (cross-polytope), from 1.

    Vectors are scaled first, so that strings depend on the direction; the scale does not change the largest.
    """
    scaled = (vectors / np.abs(vectors).max(axis=1, keepdims=True)).astype(np.float32)
    out = np.empty((len(vectors), TREES, SYMBOLS), np.uint8)
    for at in range(0, len(vectors), 256):
        turned = (scaled[at : at + 256] @ axes).reshape(-1, TREES, SYMBOLS, AXES)
        best = np.abs(turned).argmax(axis=3)
        positive = np.take_along_axis(turned, best[..., None], 3)[..., 0] > 0
        out[at : at + 256] = 2 * best + positive + 1
    return out


@cache
def widest_angles(trees: int = TREES, symbols: int = SYMBOLS, axes: int = AXES, found: float = FOUND) -> list[float]:
    """For prefixes of 1, 2, ... symbols, the angle up to which two vectors share one in some tree with
    probability `found`. How often a symbol agrees depends on the angle alone and is drawn 20,000 times."""
    rng = np.random.default_rng(SEED)
    one, other = rng.standard_normal((2, 20_000, axes))
    each, first = np.arange(len(one)), np.abs(one).argmax(axis=1)
    angles = np.linspace(0, np.pi / 2, 181)
    agree = []
    for angle in angles:
        turned = np.cos(angle) * one + np.sin(angle) * other
        second = np.abs(turned).argmax(axis=1)
        agree.append(((first == second) & ((one[each, first] > 0) == (turned[each, second] > 0))).mean())
    agree = np.minimum.accumulate(agree)
    in_a_tree = 1 - (1 - found) ** (1 / trees)
    return [float(angles[agree >= in_a_tree ** (1 / n)][-1]) for n in range(1, symbols + 1)]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, first, ask, vector, dim, tree, string) of every vector and tree; a symbol is a byte of its string."""
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = np.array([len(v) for v in batch.column("vector")])
        for dim in np.unique(dims).tolist():
            part = batch.take(pa.array(np.flatnonzero(dims == dim)))
            if dim not in known:
                known[dim] = axes_of(dim)
            symbols = hash_symbols(_matrix(part.column("vector")), known[dim])
            n = part.num_rows
            for tree in range(TREES):
                raw = symbols[:, tree].tobytes()
                strings = pa.array([raw[k : k + SYMBOLS] for k in range(0, len(raw), SYMBOLS)], pa.binary())
                own = [pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, tree, np.int32)), strings]
                yield pa.record_batch([*part.columns, *own], [*part.schema.names, "dim", "tree", "string"])


def _nearest(vectors: np.ndarray, first: np.ndarray, point: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the nearest vectors, ties to the smaller key."""
    score = np.sqrt(((vectors - point) ** 2).sum(axis=1))
    if len(score) > most:
        near = np.flatnonzero(score <= np.partition(score, most - 1)[most - 1])
    else:
        near = np.arange(len(score))
    near = near[np.lexsort((first[near], score[near]))][:most]
    return near, score[near]


def _pieces(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows with equal values in the named columns; a run may come in several pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names], 1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for s, e in zip(np.append(0, cuts).tolist(), np.append(cuts, len(values)).tolist()):
            yield tuple(values[s].tolist()), batch.slice(s, e - s)


def _answer(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    query = np.repeat([q for q, _, _ in found], [len(c) for _, c, _ in found])
    return pa.record_batch(
        [pa.array(query.astype(np.int64)), *[pa.array(np.concatenate(c)) for c in list(zip(*found))[1:]]],
        ["query", "class", "score"],
    )


ANSWER = "query long, class long, score double"


def _descend(most: int):
    """From sorted arrays: for each query its nearest among the entries around its place, block by block."""

    def around(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        asks = np.flatnonzero(table.column("ask").to_numpy())
        if not len(asks):
            return
        name, first = table.column("class").to_numpy(), table.column("first").to_numpy()
        vectors = _matrix(table.column("vector").combine_chunks())
        found = []
        for at in asks.tolist():
            low = max(0, at - WINDOW // 2)
            part = slice(low, at + WINDOW // 2 + 1)
            near, score = _nearest(vectors[part], first[part], vectors[at], most)
            found.append((name[at], name[part][near], score))
        yield _answer(found)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for where, piece in _pieces(batches, "dim", "tree", "block"):
            if where != now and held:
                yield from around(held)
                held = []
            now = where
            held.append(piece)
        if held:
            yield from around(held)

    return descend


def _ascend(most: int):
    """From blocks, sorted, with their entries before the queries that visit them: for each query its nearest
    among the entries with its prefix. A task holds one block and passes the queries by."""

    def ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, block = None, None
        for (*where, ask), piece in _pieces(batches, "block", "dim", "tree", "ask"):
            if where != now:
                held, now, block = [], where, None
            if not ask:
                held.append(piece)
                continue
            if not held:
                continue
            if block is None:
                table = pa.Table.from_batches(held).combine_chunks()
                strings = np.array(table.column("string").to_pylist(), f"S{SYMBOLS}")
                name, first = table.column("class").to_numpy(), table.column("first").to_numpy()
                block = strings, name, first, _matrix(table.column("vector").combine_chunks())
            strings, name, first, vectors = block
            points, found = _matrix(piece.column("vector")), []
            queries = zip(piece.column("class").to_pylist(), piece.column("string").to_pylist(), points)
            for query, prefix, point in queries:
                low, high = np.searchsorted(strings, [prefix, prefix + b"\xff"])
                if low < high:
                    near, score = _nearest(vectors[low:high], first[low:high], point, most)
                    found.append((query, name[low:high][near], score))
            if found:
                yield _answer(found)

    return ascend


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part, once each: with a key, and a finite vector that is not zero.

    Vectors of single precision stay so, others become double; distances are taken in double precision.
    """
    v = F.col(vector)
    single = vectors.select(v).schema[0].dataType.simpleString() == "array<float>"
    inf = float("inf")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & F.coalesce(fine, F.lit(False)))
    kept = v.cast("array<float>" if single else "array<double>")
    return rows.select(F.col(key).cast("long").alias("id"), kept.alias("vector")).distinct()


def sorted_arrays(entries: DataFrame) -> DataFrame:
    """All trees of (class, first, ask, vector), each a sorted array, as (dim, tree, string, block) beside these.

    Equal strings stand in another order in each tree.
    """
    kind = entries.schema["vector"].dataType.simpleString()
    schema = f"class long, first long, ask boolean, vector {kind}, dim int, tree int, string binary"
    strings = entries.select("class", "first", "ask", "vector").mapInArrow(_strings, schema)
    placed = global_positions(strings, [*map(F.col, ("dim", "tree", "string")), F.xxhash64("class", "tree")])
    return placed.withColumn("block", F.floor(F.col("position") / BLOCK)).drop("position")


def _norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def stops(entries: DataFrame, descended: DataFrame, most: int) -> DataFrame:
    """(class, dim, all, level) of every query: how many entries have its length, and to which prefix it ascends.

    Whatever is nearer than the `most`-th that the descent has found makes an angle with the query of at most the
    one that this distance and the norms of all entries allow; a query that has found fewer takes them all.
    """
    sized = entries.select("class", "ask", F.size("vector").alias("dim"), _norm(F.col("vector")).alias("norm"))
    lengths = sized.groupBy("dim").agg(F.min("norm").alias("low"), F.max("norm").alias("high"), F.count("*").alias("all"))
    line = Window.partitionBy("query").orderBy("score", "class")
    last = descended.withColumn("_at", F.row_number().over(line)).where(F.col("_at") == most)
    last = last.select(F.col("query").alias("class"), F.col("score").alias("bound"))
    asked = sized.where("ask").join(lengths, "dim").join(last, "class", "left")
    a, r = F.col("norm"), F.col("bound")
    b = F.least(F.greatest(F.sqrt(F.greatest(a * a - r * r, F.lit(0.0))), F.col("low")), F.col("high"))
    angle = F.acos(F.least(F.greatest((a * a + b * b - r * r) / (2 * a * b), F.lit(-1.0)), F.lit(1.0)))
    wide = F.array(*[F.lit(w) for w in widest_angles(TREES, SYMBOLS, AXES, FOUND)])
    level = F.when(r.isNotNull(), F.size(F.filter(wide, lambda w: w >= angle))).otherwise(0)
    return asked.select("class", "dim", "all", level.alias("level"))


def visits(arrays: DataFrame, stop: DataFrame) -> DataFrame:
    """(class, dim, tree, block, string, n): the blocks that hold entries with the prefix of a query, and how many
    of these they hold. A query whose prefixes have as many entries as there are vectors visits one tree whole."""
    levels = sorted(r.level for r in stop.select("level").distinct().collect() if r.level)  # SYMBOLS at most
    whole = stop.where("level = 0").select("class", "dim")
    blocks = arrays.where("tree = 0").groupBy("dim", "tree", "block").agg(F.count("*").alias("n"))
    none = F.lit(b"").alias("string")
    if not levels:
        return whole.join(blocks, "dim").select("class", "dim", "tree", "block", none, "n")
    level = F.explode(F.array(*[F.lit(n) for n in levels])).alias("level")
    prefix = F.expr("substring(string, 1, level)")
    directory = arrays.select("dim", "tree", "string", "block", level).withColumn("string", prefix)
    directory = directory.groupBy("dim", "tree", "level", "string", "block").agg(F.count("*").alias("n"))
    places = arrays.where("ask").select("class", "tree", "string").join(stop.where("level > 0"), "class")
    places = places.withColumn("string", prefix)
    read = materialize(places.join(directory, ["dim", "tree", "level", "string"]))
    sums = read.groupBy("class").agg(F.sum("n").alias("_sum"), F.first("all").alias("_all"), F.first("dim").alias("dim"))
    many = sums.where("_sum >= _all").select("class", "dim")
    some = read.join(many, "class", "left_anti").select("class", "dim", "tree", "block", "string", "n")
    every = whole.unionByName(many).join(blocks, "dim")
    return some.unionByName(every.select("class", "dim", "tree", "block", none, "n"))


def nearest_neighbours(
    vectors: DataFrame, every: int = 100, nearest: int = 10, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id` and `score` (Euclidean distance in double precision), nearest first,
    ties to the smaller key, for every row whose key is divisible by `every`, against all other rows.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without key.
    Rows that repeat key and vector are one row; a key with several vectors is near to what any of them is
    near to. Only vectors of the same length are compared. Equal vectors are one entry of the forest, under
    their smallest key, and the smallest keys that can be among the nearest stand in for it.
    """
    small_batches(vectors.sparkSession)
    rows = materialize(usable(vectors, key, vector))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    members = rows.withColumn("_at", place).where(F.col("_at") <= nearest + 1)
    firsts = rows.groupBy("vector").agg(F.min("id").alias("first"), F.max(F.col("id") % every == 0).alias("ask"))
    entries = materialize(firsts.withColumn("class", F.monotonically_increasing_id()))
    of_class = members.join(entries, "vector").select("class", F.col("id").alias("member"))
    asking = rows.where(F.col("id") % every == 0).join(entries, "vector").select("id", "class")

    arrays = sorted_arrays(entries)
    most = nearest + 1  # the query is one of them
    descended = materialize(arrays.mapInArrow(_descend(most), ANSWER).groupBy("query", "class").agg(F.min("score").alias("score")))
    read = materialize(visits(arrays, materialize(stops(entries, descended, most))))
    points = entries.select("class", "first", "vector")
    come = read.drop("n").join(points, "class").withColumn("ask", F.lit(True))
    meant = arrays.join(read.select("dim", "tree", "block").distinct(), ["dim", "tree", "block"], "left_semi")
    both = meant.withColumn("ask", F.lit(False)).unionByName(come)
    both = both.repartition("dim", "tree", "block").sortWithinPartitions("block", "dim", "tree", "ask", "string")
    ascended = both.mapInArrow(_ascend(most), ANSWER)

    candidates = descended.unionByName(ascended).groupBy("query", "class").agg(F.min("score").alias("score"))
    pairs = (
        asking.withColumnRenamed("class", "query")
        .join(candidates, "query")
        .select("id", "class", "score")
        .join(of_class, "class")
        .where("member <> id")
        .groupBy("id", "member")
        .agg(F.min("score").alias("score"))
    )
    by_score = Window.partitionBy("id").orderBy("score", "member")
    return (
        pairs.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= nearest)
        .select(F.col("id").alias("query_id"), "rank", F.col("member").alias("vec_id"), "score")
    )


def exact_neighbours(vectors: DataFrame, queries: list[tuple[int, list[float]]], nearest: int = 10) -> DataFrame:
    """The same for a few stated queries by brute force, to measure recall: each task's nearest, then the best."""
    ids = np.array([i for i, _ in queries])
    points = np.array([v for _, v in queries], np.float64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            uid, v = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for i, point in zip(ids, points):
                score = np.sqrt(((v - point) ** 2).sum(axis=1))
                score[uid == i] = np.inf
                best = np.lexsort((uid, score))[:nearest]
                best = best[np.isfinite(score[best])]
                yield pa.record_batch(
                    [pa.array(np.full(len(best), i)), pa.array(uid[best]), pa.array(score[best])],
                    ["query_id", "vec_id", "score"],
                )

    rows = usable(vectors, "vec_id", "embedding").mapInArrow(scan, "query_id long, vec_id long, score double")
    line = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return rows.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= nearest)
