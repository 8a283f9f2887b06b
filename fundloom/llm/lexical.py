"""Ranked lexical search the other way round: documents stream through an index of the queries' terms.

The queries ("items") are few and the documents many, so the index is built over the items: for each term the
items that hold it. It is broadcast, documents pass it once for the document frequencies and once for the
scores, and each task keeps the best documents of every item in a bounded heap. Heaps are merged at the end.
Neither documents nor their terms are shuffled. More items than one index may hold are searched in blocks.

All scores are whole numbers: see `op13` in the catalog for the formula.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fundloom.llm.common import small_batches
from fundloom.session import materialize

#: Letters and digits of ASCII, capitals as small letters, and all that is not ASCII make terms; the rest is a blank.
TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Postings (a term of an item) and bytes of terms that one broadcast index holds, unless one item alone has more.
POSTINGS, INDEX_BYTES = 500_000, 16_000_000
#: Bytes of a text that are split into terms at once, and documents scored at once for an item count.
PIECE, SCORED, CELLS = 1 << 20, 256, 2_000_000
#: Parts in which the heaps of one item are merged first.
MERGES = 64
# Fixed values of the score: thousandths of the weight, of the term frequency's saturation and of the length's part.
SCALE, WEIGHT, SATURATION, LENGTH = 1_000_000_000, 1000, 8, 90
_LEAST = -(2**63)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text in UTF-8, some at a time, so that a long text is never one list."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        yield text[at:end].translate(TERM_BYTES).split()
        at = end


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (item, terms): each item's distinct terms, sorted. Rows of one key are one item; items without a term
    are left out. The null key is an item too."""
    small_batches(items.sparkSession)

    @F.arrow_udf("array<binary>")
    def terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [sorted(set().union(*terms_of(t.as_py() or b""))) for t in batch]
            yield pa.array(found, pa.list_(pa.binary()))

    rows = items.select(F.col(f"`{key}`").cast("long").alias("item"), terms(_bytes(text)).alias("terms"))
    rows = rows.select("item", F.explode("terms").alias("term"))
    return rows.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _bytes(text: str) -> Column:
    return F.col(f"`{text}`").cast("binary")


def _blocks(items: DataFrame, postings: int, size: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items read one after the other, as many at a time as an index may hold."""
    block, held, length = [], 0, 0
    for row in items.toLocalIterator():
        own = [bytes(t) for t in row["terms"]]
        own_size = sum(map(len, own))
        if block and (held + len(own) > postings or length + own_size > size):
            yield block
            block, held, length = [], 0, 0
        block.append((row["item"], own))
        held, length = held + len(own), length + own_size
    if block:
        yield block


def _count(docs: DataFrame, vocabulary, text: str) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms with repeats, and for each number of the vocabulary the documents
    that hold it. One row for each task and term reaches the shuffle."""
    numbers = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = numbers.value.get
        held = np.zeros(len(numbers.value), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for value in batch.column(0):
                seen, length = set(), 0
                for terms in terms_of(value.as_py() or b""):
                    length += len(terms)
                    seen.update(map(get, terms))
                n_docs, n_terms = n_docs + (length > 0), n_terms + length
                seen.discard(None)
                held[list(seen)] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], at])), pa.array(np.concatenate([[n_docs, n_terms], held[at]]))],
            ["number", "n"],
        )

    parts = docs.select(_bytes(text).alias("text")).mapInArrow(count, "number bigint, n bigint")
    # no more rows than the vocabulary of a block
    totals = dict(parts.groupBy("number").agg(F.sum("n")).toLocalIterator())
    numbers.destroy()
    return totals.pop(-2, 0), totals.pop(-1, 0), totals


def weight(n_docs: int, df: int) -> int:
    """Thousandths of the logarithm of the inverse document frequency."""
    return math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _best(docs: DataFrame, index, most: int, key: str, text: str) -> DataFrame:
    """Rows (number, score, doc): each task's best documents of each item of a block."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, starts, postings, n_items, n_docs, n_terms = shared.value
        get, sizes = vocabulary.get, np.diff(starts)
        heaps: list[list[tuple]] = [[] for _ in range(n_items)]
        worst, worst_key = np.zeros(n_items, np.int64), np.full(n_items, _LEAST)  # of full heaps
        at_once = max(1, min(SCORED, CELLS // n_items))

        def push(keys: list, found: list[np.ndarray]) -> None:
            scores = np.zeros((len(keys), n_items), np.int64)
            if not found:
                return
            terms, values, owners = (np.concatenate(x) for x in zip(*found))
            spread = np.repeat(np.arange(len(terms)), sizes[terms])
            ends = np.cumsum(sizes[terms])
            place = np.arange(ends[-1]) - (ends - sizes[terms])[spread] + starts[terms][spread]
            np.add.at(scores, (owners[spread], postings[place]), values[spread])
            order = np.array([_LEAST if k is None else k for k in keys], np.int64)[:, None]
            better = (scores > worst) | (scores == worst) & (order <= worst_key) & (scores > 0)
            for row, item in zip(*np.nonzero(better)):
                doc, heap = keys[row], heaps[item]
                # a heap's first entry is its worst: least score, then largest key; a null key is the smallest
                entry = (int(scores[row, item]), -(_LEAST - 1 if doc is None else doc))
                if len(heap) < most:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
                if len(heap) == most:
                    worst[item], worst_key[item] = heap[0][0], max(_LEAST, -heap[0][1])

        keys, found = [], []
        for batch in batches:
            for key_, value in zip(batch.column(0), batch.column(1)):
                counts, length = Counter(), 0
                for terms in terms_of(value.as_py() or b""):
                    length += len(terms)
                    counts.update(map(get, terms))
                counts.pop(None, None)
                if not counts:
                    continue
                numbers = np.fromiter(counts.keys(), np.int64, len(counts))
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                m = 100 - LENGTH + LENGTH * length * n_docs // n_terms
                values = weights[numbers] * (SCALE * tf // (1000 * tf + SATURATION * m))
                found.append((numbers, values, np.full(len(numbers), len(keys))))
                keys.append(key_.as_py())
                if len(keys) == at_once:
                    push(keys, found)
                    keys, found = [], []
        push(keys, found)
        rows = [(i, s, None if k == 1 - _LEAST else -k) for i, heap in enumerate(heaps) for s, k in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["number", "score", "doc"]
        )

    rows = docs.select(F.col(f"`{key}`").cast("long"), _bytes(text).alias("text"))
    heaps = rows.mapInArrow(search, "number bigint, score bigint, doc bigint")
    # many tasks' heaps of one item meet in parts first, each part keeps the best, and then all parts meet
    for by in (["number", "part"], ["number"]):
        first = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc"))
        heaps = heaps.withColumn("part", F.spark_partition_id() % MERGES) if len(by) > 1 else heaps
        heaps = heaps.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)
    return heaps.drop("part")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    postings: int = POSTINGS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Rows (item_key, rank, key, score): each item's `most` documents of highest score above 0, best first, equal
    scores by ascending key.

    Keys are whole numbers or null, which comes first. Every row of `docs` is a document, also one that repeats
    another; rows of `items` with one key are one item, whose terms count once. Null and empty texts have no terms.
    An item without terms, or whose terms no document holds, has no rows; an empty table gives none. A term that all
    documents hold still has a positive weight. `postings` and `index_bytes` bound the broadcast index; items beyond
    them are searched in further passes over the documents.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    results = []
    for block in _blocks(materialize(item_terms(items, item_key, item_text)), postings, index_bytes):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*[terms for _, terms in block])))}
        n_docs, n_terms, df = _count(docs, vocabulary, text)
        by_term: list[list[int]] = [[] for _ in vocabulary]
        for number, (_, terms) in enumerate(block):
            for t in terms:
                by_term[vocabulary[t]].append(number)
        held = {t: i for t, i in vocabulary.items() if df.get(i)}  # a term of no document adds nothing
        starts = np.concatenate([[0], np.cumsum([len(x) for x in by_term])]).astype(np.int64)
        flat = np.array([i for x in by_term for i in x], np.int64)
        weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(by_term))], np.int64)
        index = (held, weights, starts, flat, len(block), n_docs, max(1, n_terms))
        found = materialize(_best(docs, index, most, key, text))
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "number bigint, item bigint")
        results.append(found.join(F.broadcast(names), "number"))  # no more items than the index has
    if not results:
        return spark.createDataFrame([], f"`{item_key}` bigint, rank int, `{key}` bigint, score bigint")
    rows = reduce(DataFrame.unionByName, results)
    return rows.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
