"""Documents of several sources interleaved to target weights by Pfair scheduling.

Each source's documents form blocks. With `m` of `total` shares, block j of a source may not be placed before
slot floor(j total / m) and must be placed before slot ceil((j + 1) total / m); the earliest deadline among
the released blocks takes each slot. So after any number of slots a source is less than one block away from
its share. The windows repeat after `total` slots, so one cycle is scheduled and all others follow from it.

The largest sources are scheduled one by one. All others form classes of nearly equal size, each scheduled like a
source at the sum of its weights; inside a class, row i of a source with weight w has the deadline (i + 1) / w, and
rows stand by their deadlines. As weights of a class are nearly equal, no source is two rows off its share of the
class, so that it stays within one block of its share of the whole, however many sources there are.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from fundloom.llm.common import numbered, packed, unpacked
from fundloom.session import materialize

#: Documents of a block, shares that the weights are rounded to, sources that are scheduled one by one, and classes
#: of the others for each doubling of the size.
BLOCK_ROWS, SHARES, SOURCES, CLASSES = 64, 1000, 100, 2
#: Without given weights, sources weigh this power of their sizes.
POWER = 0.5


def whole_shares(weights: dict[str, float], total: int = SHARES) -> dict[str, int]:
    """Whole shares in proportion to the weights, one at least; the largest remainders make up the total."""
    known = {s: w for s, w in weights.items() if w > 0}
    whole = sum(known.values())
    exact = {s: total * w / whole for s, w in known.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(known, key=lambda s: (int(exact[s]) - exact[s], s)):
        if sum(shares.values()) >= total:
            break
        shares[s] += 1
    return shares


def target_shares(counts: dict[str, int], power: float = POWER, total: int = SHARES) -> dict[str, int]:
    """Whole shares in proportion to count ** power."""
    return whole_shares({s: n**power for s, n in counts.items() if n > 0}, total)


def earliest_deadline_first(shares: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one cycle of sum(shares) slots."""
    total = sum(shares.values())
    waiting = [(0, s, 0) for s in shares]  # release, source, block
    heapq.heapify(waiting)
    released: list[tuple[int, str, int]] = []  # deadline, source, block
    slots: dict[str, list[int]] = {s: [] for s in shares}
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(released, (-(-(j + 1) * total // shares[s]), s, j))
        deadline, s, j = heapq.heappop(released)
        if deadline <= t:
            raise RuntimeError("a block missed its deadline")
        slots[s].append(t)
        if j + 1 < shares[s]:
            heapq.heappush(waiting, ((j + 1) * total // shares[s], s, j + 1))
    return slots


@dataclass
class Plan:
    """For each source, by phase: blocks placed before it, blocks of a cycle, slots of a cycle, its first slot,
    and where in the cycle its blocks stand."""

    before: dict[str, list[int]] = field(default_factory=dict)
    blocks: dict[str, list[int]] = field(default_factory=dict)
    length: dict[str, list[int]] = field(default_factory=dict)
    start: dict[str, list[int]] = field(default_factory=dict)
    places: dict[str, list[list[int]]] = field(default_factory=dict)

    def slot(self, source: str, block: int) -> int:
        k = sum(b <= block for b in self.before[source]) - 1
        cycle, at = divmod(block - self.before[source][k], self.blocks[source][k])
        return self.start[source][k] + cycle * self.length[source][k] + self.places[source][k][at]


def plan(shares: dict[str, int], blocks: dict[str, int]) -> Plan:
    """Phases until every block has a slot: whole cycles while all sources last, then the head of a cycle up to the
    last block of the first source to end, then on with the others at their shares. Two phases for each source at
    most; in each, no source is a block off its share."""
    made, left, done, slot = Plan(), {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0
    while left:
        cycle = earliest_deadline_first({s: shares[s] for s in left})
        length = sum(shares[s] for s in left)
        cycles = min(n // shares[s] for s, n in left.items())
        if not cycles:
            length = 1 + min(cycle[s][n - 1] for s, n in left.items() if n <= shares[s])
            cycle = {s: [t for t in places if t < length] for s, places in cycle.items()}
            cycles = 1
        for s, places in cycle.items():
            if places:
                for name, value in (("before", done[s]), ("blocks", len(places)), ("length", length), ("start", slot)):
                    getattr(made, name).setdefault(s, []).append(value)
                made.places.setdefault(s, []).append(places)
                done[s] += cycles * len(places)
                left[s] -= cycles * len(places)
        left = {s: n for s, n in left.items() if n}
        slot += cycles * length
    return made


def _label(source: Column, listed: list[str | None]) -> Column:
    """A name that tells null, a listed source and all others apart."""
    names = [s for s in listed if s is not None]
    label = F.when(source.isin(names), F.concat(F.lit("="), source)) if names else F.when(F.lit(False), "")
    if None in listed:
        label = label.when(source.isNull(), "null")
    return label.otherwise("rest")


def _by_deadline(rows: DataFrame, small: DataFrame, by_key: tuple[Column, list[Column]]) -> DataFrame:
    """`rows` of the small sources with their class as `_mix`, numbered in it by deadline as `_seq`."""
    own = numbered(rows.join(small, F.col("_from").eqNullSafe(F.col("_source"))), [F.col("_source")], *by_key, "_row")
    own = own.withColumn("_due", (F.col("_row") + 1) / F.pow("_n", F.lit(POWER)))
    last = F.pow(F.lit(2.0), (F.col("_class") + 1) / CLASSES * (1 - POWER))  # no deadline of the class is later
    part = F.floor(F.col("_due") / last * 256)
    due = numbered(own, [F.col("_class")], part, [F.col("_due"), F.col("_source")], "_seq")
    return due.withColumn("_mix", F.concat(F.lit("rest "), F.col("_class"))).drop("_class", "_source", "_n", "_row", "_due")


def mix(
    docs: DataFrame,
    weights: dict[str, int] | None = None,
    block_rows: int = BLOCK_ROWS,
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """`docs` with `block`, `slot` and `position` (gapless from 0) in the mixture; columns of these names are replaced.

    `weights` are whole shares by source; without them they follow the square root of the sources' sizes. No
    row is dropped or repeated: a source that ends leaves its shares to the others. A null source is a source
    of its own. Beside given weights, sources without one are mixed as one with the smallest weight. In a source
    rows stand by the digest of their key; equal rows are interchangeable.
    The driver reads one count for each of the `SOURCES` largest sources (or of those with a given weight) and for
    each class of the others; the plan, at most two cycles for each, is broadcast.
    """
    spark = docs.sparkSession
    counts = materialize(docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n")))
    name = lambda s: "null" if s is None else f"={s}"
    small = None
    if weights is not None:
        known = counts.where(F.col("_source").isin([s for s in weights if s is not None]) | F.col("_source").isNull())
        listed = {r[0]: r[1] for r in known.collect() if r[0] in weights}
        rows_of = {name(s): n for s, n in listed.items()}
        shares = {name(s): max(1, int(weights[s])) for s in listed}
        if others := counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0] - sum(listed.values()):
            rows_of["rest"], shares["rest"] = others, min(shares.values(), default=1)
    else:
        listed = {r[0]: r[1] for r in counts.orderBy(F.col("_n").desc(), "_source").limit(SOURCES).collect()}
        rows_of = {name(s): n for s, n in listed.items()}
        weight = {s: n**POWER for s, n in rows_of.items()}
        size = F.floor(CLASSES * F.log2("_n")).cast("int")
        small = counts.where(_label(F.col("_source"), list(listed)) == "rest").withColumn("_class", size)
        for r in small.groupBy("_class").agg(F.sum("_n"), F.sum(F.pow("_n", F.lit(POWER)))).collect():
            rows_of[f"rest {r[0]}"], weight[f"rest {r[0]}"] = r[1], r[2]
        shares = whole_shares(weight)
    made = plan(shares, {s: -(-n // block_rows) for s, n in rows_of.items()})

    short = sorted(
        (made.slot(s, (n - 1) // block_rows), -n % block_rows) for s, n in rows_of.items() if n % block_rows
    )
    table = spark.createDataFrame(
        [(s, made.before[s], made.blocks[s], made.length[s], made.start[s], made.places[s]) for s in rows_of],
        "_mix string, _before array<long>, _blocks array<long>, _length array<long>, _start array<long>, "
        "_places array<array<int>>",
    )
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = packed(docs, key=F.col(key), digest=digest, _from=F.col(source), _mix=_label(F.col(source), list(listed)))
    by_key = F.substring("digest", 1, 2), [F.col("digest"), F.col("key")]
    if len(rows_of) == len(listed) or weights is not None:
        placed = numbered(rows, [F.col("_mix")], *by_key, "_seq")
    else:
        large = numbered(rows.where("_mix <> 'rest'"), [F.col("_mix")], *by_key, "_seq")
        placed = large.unionByName(_by_deadline(rows.where("_mix = 'rest'"), small, by_key))
    placed = placed.withColumn("block", F.floor(F.col("_seq") / block_rows)).join(F.broadcast(table), "_mix")
    phase = F.size(F.filter("_before", lambda b: b <= F.col("block"))) - 1
    placed = placed.withColumn("_phase", phase).withColumn("_nth", F.col("block") - F.get("_before", F.col("_phase")))
    turn = F.col("_nth") % F.get("_blocks", F.col("_phase"))
    cycle = F.floor(F.col("_nth") / F.get("_blocks", F.col("_phase")))
    slot = (
        F.get("_start", F.col("_phase"))
        + cycle * F.get("_length", F.col("_phase"))
        + F.get(F.get("_places", F.col("_phase")), turn.cast("int"))
    ).cast("long")
    missing = F.lit(0).cast("long")
    if short:
        lacks = F.array(*[F.struct(F.lit(s).cast("long").alias("s"), F.lit(n).cast("long").alias("n")) for s, n in short])
        earlier = F.filter(lacks, lambda x: x["s"] < F.col("slot"))
        missing = F.aggregate(earlier, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    position = F.col("slot") * block_rows + F.col("_seq") % block_rows - missing
    placed = placed.withColumn("slot", slot).withColumn("position", position)
    return unpacked(placed, docs, block=F.col("block"), slot=F.col("slot"), position=F.col("position"))


def in_mixed_order(docs: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """`docs` in the order of the mixture: rows are dealt by ranges of the position and sorted.

    All rows and columns stay as they are; the order of the rows in the written files is the mixture.
    """
    rows = packed(docs, key=F.col(key), source=F.col(source))
    placed = mix(rows, key="key", source="source", **options).select("position", "row")
    return unpacked(placed.repartitionByRange("position").sortWithinPartitions("position"), docs)
