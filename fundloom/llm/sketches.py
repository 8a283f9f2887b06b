"""Document fingerprints: the k least hashes of a text's word shingles, in DataFrame functions alone."""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.llm.common import SPACES

#: Hashes a sketch keeps, and words of a shingle.
K, WORDS = 128, 5
#: Text that a range of neighbours holds, about, and most ranges (larger ones then; a task sorts with spill).
RANGE_BYTES, RANGES = 64 * 2**20, 20_000
_LEAST = -(2**63)


def words_of(text: Column) -> Column:
    """Words without spaces between them; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The k least distinct hashes of all shingles, ascending, array<long>.

    A text of fewer words is one shingle, one without words has an empty sketch.
    """

    def shingles(w: Column) -> Column:
        last = F.greatest(F.size(w) - words, F.lit(0))
        hashes = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(words)])
        )
        return F.when(F.size(w) == 0, F.array().cast("array<long>")).otherwise(hashes)

    found = F.transform(F.array(words_of(text)), shingles)[0]
    return F.slice(F.sort_array(F.array_distinct(found)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """How many distinct shingles a sketch stands for: counted below k, estimated from the k-th hash above."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both, 0 to 1; 1 if neither has any."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both)).cast("double")


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of `a` that `b` has, 0 to 1; 1 if `a` has none."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def merged_sketches(sketches: DataFrame, group: str, name: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of documents, of any size.

    Values are made distinct map-side and each task passes on its k least of a group; empty sketches add none.
    """
    values = sketches.select(group, F.explode(name).alias("_value")).distinct()
    least = F.row_number().over(Window.partitionBy(group).orderBy("_value"))
    kept = values.withColumn("_at", least).where(F.col("_at") <= k)
    return kept.groupBy(group).agg(F.sort_array(F.collect_list("_value")).alias(name))


def _ranges(docs: DataFrame, least_ranges: int) -> list[tuple[int, int]]:
    """The first (key, hash) of each range, ascending; `docs` has `_key` and `_hash`, one row for each text.

    Ranges hold about `RANGE_BYTES` of text each. A key that stands for several shares of the rows has as many
    ranges, cut by the hash; the first hash of each is looked up, so that every limit belongs to a row.
    """
    found = docs.agg(F.sum("_bytes"), F.count(F.lit(1)), F.min("_key")).first()
    total, count, least = found
    if not count:
        return [(0, 0)]
    pieces = min(RANGES, max(2, least_ranges, -(-(total or 0) // RANGE_BYTES)))
    shares = [i / pieces for i in range(1, pieces)]
    cuts = docs.agg(F.percentile_approx("_key", shares, max(10_000, 20 * pieces))).first()[0]
    times = Counter([least, *cuts])
    hot = {k: n for k, n in times.items() if n > 1}
    limits = [(k, _LEAST) for k in times if k not in hot]
    if hot:
        parts = F.create_map(*[F.lit(v) for k, n in hot.items() for v in (k, n)])
        own = docs.where(F.col("_key").isin(list(hot))).withColumn("_part", _part(F.col("_hash"), parts[F.col("_key")]))
        limits += [tuple(r) for r in own.groupBy("_key", "_part").agg(F.min("_hash").alias("h")).select("_key", "h").collect()]
    return sorted(limits)


def _part(value: Column, parts: Column) -> Column:
    """0 to parts - 1, ascending with a 64-bit hash."""
    return F.floor((F.shiftright(value, 32) + F.lit(2**31)) * parts / F.lit(2**32)).cast("int")


def _listed(limits: list[tuple[int, int]]) -> Column:
    """The limits as a constant, in one expression however many there are."""
    text = json.dumps([{"k": k, "h": h} for k, h in limits])
    return F.from_json(F.lit(text), "array<struct<k:bigint,h:bigint>>")


def _range_of(key: Column, value: Column, limits: list[tuple[int, int]]) -> tuple[Column, Column]:
    """The number of the range of a (key, hash), and whether the pair is its limit; two steps of about the root
    of the number of ranges each."""
    step = math.isqrt(len(limits) - 1) + 1
    whole, heads = _listed(limits), _listed(limits[::step])
    reached = lambda c: (c["k"] < key) | ((c["k"] == key) & (c["h"] <= value))
    coarse = F.greatest(F.size(F.filter(heads, reached)) - 1, F.lit(0))
    near = F.slice(whole, coarse * step + 1, F.lit(step))
    at = coarse * step + F.greatest(F.size(F.filter(near, reached)) - 1, F.lit(0))
    own = F.get(whole, at)
    return at, (own["k"] == key) & ((own["h"] == value) | (own["h"] == _LEAST))


def with_next(docs: DataFrame, key: str, text: str, derived: dict[str, Column]) -> DataFrame:
    """`docs` with the `derived` columns and, as `next_...`, the text and the derived columns of the document
    that follows by ascending key (after the last: the first).

    Rows are dealt by ranges of (key, hash of the text), each a task of its own, and the first row of each range
    also goes to the range before it, so every row meets its successor in one shuffle of the texts. The limits
    come from approximate quantiles; they decide how even the ranges are, not the result. Nulls come first as the
    least long; rows with the same key follow each other by the hash of their text, and a key that holds a large
    part of all rows has several ranges. Only rows equal in key and text always share one.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(key).cast("long"), F.lit(_LEAST))
    rows = docs.withColumns({"_key": order, "_hash": F.xxhash64(text)})
    measured = rows.select("_key", "_hash", F.octet_length(text).cast("long").alias("_bytes"))
    limits = _ranges(measured, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at, leads = _range_of(F.col("_key"), F.col("_hash"), limits)
    rows = rows.withColumn("_range", at).withColumn("_leads", leads)
    before = F.when(F.col("_range") == 0, F.lit(len(limits) - 1)).otherwise(F.col("_range") - 1)
    own = F.struct(F.col("_range").alias("at"), F.lit(False).alias("copy"))
    other = F.struct(before.alias("at"), F.lit(True).alias("copy"))
    dealt = rows.withColumn("_to", F.explode(F.when(F.col("_leads"), F.array(own, other)).otherwise(F.array(own))))
    met = dealt.withColumns({"_at": F.col("_to.at"), "_copy": F.col("_to.copy")}).drop("_to", "_range", "_leads")
    met = met.repartitionById(len(limits), "_at").withColumns(derived)
    line = Window.partitionBy("_at").orderBy("_copy", "_key", "_hash")
    following = {f"next_{c}": F.lead(c).over(line) for c in [text, *derived]}
    return met.withColumns(following).where(~F.col("_copy")).drop("_at", "_copy", "_key", "_hash")


def edited_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row key, `text`, `sketch`, `next_text`, `next_sketch`, `edited` and `edited_sketch`.

    In the edited text the last floor(n/2) code points are replaced by the first as many (or all) of the next
    document's. A null text is an empty one; repeated rows stay and follow each other.
    """
    plain = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(plain, "_id", "text", {"sketch": sketch(F.col("text"))})
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.length("text") - half)
    edited = rows.withColumn("edited", F.concat(head, F.substring(F.col("next_text"), F.lit(1), half)))
    return edited.withColumn("edited_sketch", sketch(F.col("edited"))).withColumnRenamed("_id", key)
