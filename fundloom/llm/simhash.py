"""Near duplicates by SimHash: fingerprints of word shingles, pigeonhole blocks, verified distances."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fundloom.llm.common import packed, small_batches, unpacked
from fundloom.llm.components import components
from fundloom.session import materialize, passing

#: A fingerprint is cut into so many blocks more than bits may differ; two or more of them agree in as many.
SPARE = 4
#: Distinct fingerprints of one block key that one task compares; larger keys are cut finer.
KEY_ROWS = 32_768
#: Shingles of a text whose bits are counted at once.
_SHINGLES = 200_000


def text_fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; 0 without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.append(0, spaces + 1), np.append(spaces, len(joined))
    n = max(1, len(found) - words + 1)
    starts, ends = starts[:n], ends[-n:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _SHINGLES):
        pairs = zip(starts[at : at + _SHINGLES].tolist(), ends[at : at + _SHINGLES].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint(spark: SparkSession, text: Column, words: int) -> Column:
    """The fingerprint of a whole text as a signed long."""
    small_batches(spark)

    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [text_fingerprint(t.as_py(), words) for t in batch]
            yield pa.array(np.array(values, np.uint64).view(np.int64))

    return fingerprints(text)


def _block_masks(max_bits: int, spare: int) -> list[int]:
    edges = [round(64 * i / (max_bits + spare)) for i in range(max_bits + spare + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]


def _first_key(max_bits: int, spare: int) -> tuple[list[int], list[int], np.ndarray]:
    """Masks of the blocks and of the block keys, and the first key that two fingerprints share, by the blocks
    they differ in."""
    blocks = _block_masks(max_bits, spare)
    keys = list(combinations(range(len(blocks)), spare))
    first = np.full(1 << len(blocks), -1, np.int16)
    for differ in range(1 << len(blocks)):
        first[differ] = next((c for c, key in enumerate(keys) if not any(differ >> b & 1 for b in key)), -1)
    return blocks, [sum(blocks[b] for b in key) for key in keys], first


def _differing_blocks(x: np.ndarray, blocks: list[int]) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for b, mask in enumerate(blocks):
        out |= ((x & np.uint64(mask)) != 0).astype(np.int64) << b
    return out


def _tree(found: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among the fingerprints of one key, each verified.

    Whoever is reached is never compared again, so a dense group costs little more than its size.
    """
    parents, children = [], []
    rest = found
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                reached, rest = rest[near], rest[~near]
                parents.append(np.full(len(reached), x))
                children.append(reached)
                frontier.extend(reached)
    none = np.empty(0, np.uint64)
    return np.concatenate([*parents, none]), np.concatenate([*children, none])


def _linker(max_bits: int, blocks: list[int], first: np.ndarray, most: int):
    """For rows sorted by (c, key, fp): links within each key. A key of over `most` rows is passed on as rows
    without partner, so that a task holds `most` rows of a key."""

    def emit(c: np.ndarray, u: np.ndarray, v: np.ndarray | None) -> pa.RecordBatch:
        other = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v.view(np.int64))
        return pa.record_batch([pa.array(c, pa.int32()), pa.array(u.view(np.int64)), other], ["c", "u", "v"])

    def links(c: int, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        u, v = _tree(found, max_bits)
        own = first[_differing_blocks(u ^ v, blocks)] == c  # other links belong to another key that the pair shares
        if own.any():
            yield emit(np.full(int(own.sum()), c), u[own], v[own])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []  # the fingerprints of the key that goes on into the next batch
        now, held, passing = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            c, key, fp = (batch.column(i).to_numpy() for i in range(3))
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((c[1:] != c[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(c))
            for s, e in zip(starts.tolist(), ends.tolist()) if len(starts) < 2 else _worth(starts, ends):
                this = (int(c[s]), int(key[s]))
                if this != now:
                    if now is not None and held > 1 and not passing:
                        yield from links(now[0], np.concatenate(kept))
                    kept, held, passing, now = [], 0, False, this
                part = fp[s:e]
                held += len(part)
                if held > most:
                    for rows in [*kept, part]:
                        yield emit(np.full(len(rows), this[0]), rows, None)
                    kept, passing = [], True
                else:
                    kept.append(part)
        if now is not None and held > 1 and not passing:
            yield from links(now[0], np.concatenate(kept))

    return link


def _worth(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The stretches that may hold a link: two rows or more, or an end that may go on in another batch."""
    use = ends - starts > 1
    use[0] = use[-1] = True
    return list(zip(starts[use].tolist(), ends[use].tolist()))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(fingerprints: DataFrame, max_bits: int = 4, spare: int = SPARE) -> DataFrame:
    """Links (u, v) between distinct `fp` that connect all fingerprints at `max_bits` or fewer differing bits.

    Cut into `max_bits + spare` blocks, two such fingerprints agree in `spare` blocks or more, so they meet
    under one of the keys made of that many. A key that gathers more than `KEY_ROWS` distinct fingerprints is
    cut again by the same rule over its other blocks, halved, and those finer keys are compared whole.
    """
    blocks, masks, first = _first_key(max_bits, spare)
    schema = "c int, u long, v long"
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])
    keyed = fingerprints.select(F.posexplode(keys).alias("c", "key"), "fp")
    sorted_keys = keyed.repartition("c", "key").sortWithinPartitions("c", "key", "fp")
    found = materialize(sorted_keys.mapInArrow(_linker(max_bits, blocks, first, KEY_ROWS), schema))
    finer = _finer_masks(fingerprints.sparkSession, blocks, masks, max_bits)
    again = (
        found.where("v IS NULL")
        .select("c", F.col("u").alias("fp"))
        .join(F.broadcast(finer), "c")  # a fixed number of rows
        .select("c", "s", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        .repartition("c", "s", "key")
        .sortWithinPartitions("c", "s", "key", "fp")
        .select("c", F.xxhash64("s", "key").alias("key"), "fp")
        .mapInArrow(_linker(max_bits, blocks, first, 1 << 62), schema)
    )
    return found.where("v IS NOT NULL").select("u", "v").unionByName(again.select("u", "v"))


def _finer_masks(spark: SparkSession, blocks: list[int], masks: list[int], max_bits: int) -> DataFrame:
    """(c, s, mask): for each key the finer keys, which fix half of the other blocks' halves as well."""
    rows = []
    for c, mask in enumerate(masks):
        halves = []
        for block in (b for b in blocks if not b & mask):
            low, size = (block & -block).bit_length() - 1, block.bit_count()
            cut = low + size // 2
            halves += [(1 << cut) - (1 << low), (1 << (low + size)) - (1 << cut)]
        for s, chosen in enumerate(combinations(halves, len(halves) - max_bits)):
            rows.append((c, s, _signed(mask | sum(chosen))))
    return spark.createDataFrame(rows, "c int, s int, mask long")


def near_duplicates(
    docs: DataFrame, words: int = 5, max_bits: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: key, `fingerprint` (16 hex digits), `component_id`, and `fp` as a signed long.

    Fingerprints are those of whole texts, ASCII lower case, shingles of `words` words with repeats. Documents
    link when their fingerprints differ in `max_bits` bits or fewer; `component_id` is the smallest key that
    links reach. Texts without words (null, empty) have fingerprint zero and link like any other. Repeated
    rows stay; a null key is in its component but names none, unless the component has no other key.
    """
    spark = docs.sparkSession
    rows = materialize(
        docs.select(F.col(key).alias("doc_id"), fingerprint(spark, F.col(text), words).alias("fp"))
    )
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(near_links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = classes.join(linked, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(names, "root").select("fp", "component_id")
    return rows.join(of_class, "fp").select(
        F.col("doc_id").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "fp",
    )


def _shingle_hashes(found: list[bytes], words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    least = np.empty(0, np.uint64)
    for at in range(0, max(1, len(found) - words + 1), _SHINGLES):
        part = found[at : at + _SHINGLES + words - 1]
        ends = range(max(1, len(part) - words + 1)) if part else ()
        hashes = [xxhash.xxh64_intdigest(b" ".join(part[i : i + words]), 42) for i in ends]
        least = np.unique(np.concatenate([least, np.array(hashes, np.uint64)]))
    return least


#: A signature has so many bands of so many minima. Texts alike by 0.8 agree in a whole band with 0.9996.
BANDS, MINIMA = 20, 5
#: Bands of the first round; the others only serve texts that these left apart.
FIRST_BANDS = 4
#: A share of agreeing minima that errs by less than this is looked at (three standard deviations at 0.8).
MARGIN = 0.12
#: Bytes of the texts of one key that a task compares; larger keys are cut finer.
KEY_BYTES = 64_000_000
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 2**63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 2**63, BANDS * MINIMA, dtype=np.uint64)


def _signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of the hashes under each of the mixings, 32 bits; zeros without hashes."""
    least = np.full(len(_FACTORS), 2**32 - 1, np.uint64)
    for at in range(0, len(hashes), 1024):
        mixed = hashes[at : at + 1024, None] * _FACTORS + _OFFSETS
        mixed >>= np.uint64(32)
        least = np.minimum(least, mixed.min(axis=0))
    return (least if len(hashes) else least * 0).astype(np.uint32)


def _features(spark: SparkSession, text: Column, words: int) -> Column:
    """Struct of `sig`, a text's signature, and `shingles`, the distinct hashes of its shingles of `words` words,
    ascending, 32 bits each. ASCII lower case."""
    small_batches(spark)

    @F.arrow_udf("struct<sig:array<int>,shingles:binary>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            signatures, sets = [], []
            for t in batch:
                hashes = _shingle_hashes((t.as_py() or "").encode().lower().split(), words)
                signatures.append(_signature(hashes).view(np.int32))
                sets.append(np.unique((hashes >> np.uint64(32)).astype(np.uint32)).tobytes())
            columns = [pa.array(signatures, pa.list_(pa.int32())), pa.array(sets, pa.binary())]
            yield pa.StructArray.from_arrays(columns, ["sig", "shingles"])

    return features(text)


def _alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two ascending sets share `similarity` of all they hold; empty ones are alike."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < similarity * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _joined(th, root, sig, sets, similarity: float) -> tuple[list[int], list[int]]:
    """Links that connect what is alike among the texts of one key, each counted on whole sets.

    Texts of one root are connected already. Whoever is reached is never compared again, and a text is counted only
    with those of fitting size and signature.
    """
    sizes = np.array([len(s) for s in sets])
    left = np.ones(len(th), bool)
    u, v = [], []
    while left.any():
        start = np.flatnonzero(left)[0]
        frontier = np.flatnonzero(left & (root == root[start])).tolist()
        left[frontier] = False
        while frontier and left.any():
            x = frontier.pop()
            rest = np.flatnonzero(left)
            fits = np.minimum(sizes[rest], sizes[x]) >= similarity * np.maximum(sizes[rest], sizes[x])
            rest = rest[fits]
            rest = rest[(sig[rest] == sig[x]).mean(axis=1) >= similarity - MARGIN]
            for y in rest.tolist():
                if left[y] and _alike(sets[x], sets[y], similarity):
                    u.append(int(th[x]))
                    v.append(int(th[y]))
                    reached = np.flatnonzero(left & (root == root[y]))
                    left[reached] = False
                    frontier.extend(reached.tolist())
    return u, v


def _text_linker(similarity: float, most: int):
    """For rows sorted by key: links (u, v) within each key. A key of over `most` bytes is passed on as rows
    (key, text) without partner, so that a task holds so much of a key."""

    def emit(u: list, v: list | None, key: int) -> pa.RecordBatch:
        other = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v, pa.int64())
        return pa.record_batch([pa.array([key] * len(u), pa.int64()), pa.array(u, pa.int64()), other], ["key", "u", "v"])

    def links(key: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        th, root = (np.array([r[c] for r in rows], np.int64) for c in (0, 1))
        if (root == root[0]).all():
            return
        sig = np.array([r[2] for r in rows], np.int32)
        u, v = _joined(th, root, sig, [np.frombuffer(r[3], np.uint32) for r in rows], similarity)
        if u:
            yield emit(u, v, key)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, held = None, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in range(5)]
            for k, th, root, sig, sets in zip(*columns):
                key = k.as_py()
                if key != now:
                    if len(rows) > 1 and held <= most:
                        yield from links(now, rows)
                    now, rows, held = key, [], 0
                row = (th.as_py(), root.as_py(), sig.values.to_numpy(), sets.as_py())
                size = 600 + len(row[3])
                if held <= most < held + size:  # from here on the key is too large for one task
                    yield emit([r[0] for r in rows], None, key)
                    rows = []
                held += size
                if held > most:
                    yield emit([row[0]], None, key)
                else:
                    rows.append(row)
        if len(rows) > 1 and held <= most:
            yield from links(now, rows)

    return link


def _linked(keyed: DataFrame, roots: DataFrame | None, texts: DataFrame, similarity: float, most: int) -> DataFrame:
    """Links among the texts of each key (key, th): of keys whose texts are of one root there is nothing to do."""
    if roots is not None:
        keyed = keyed.join(roots, "th", "left").withColumn("root", F.coalesce("root", "th"))
        keyed = materialize(keyed)
        mixed = keyed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        keyed = keyed.join(mixed.select("key"), "key", "left_semi")
    else:
        keyed = keyed.withColumn("root", F.col("th"))
    rows = keyed.join(texts, "th").select("key", "th", "root", "sig", "shingles")
    ordered = rows.repartition("key").sortWithinPartitions("key", "th")
    return materialize(ordered.mapInArrow(_text_linker(similarity, most), "key long, u long, v long"))


def _text_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (u, v) between `th` that connect the texts whose shingles are alike by `similarity`.

    Texts whose fingerprints `near_links` connects share a key, and so do texts that agree in a band. Of a key's texts
    links are drawn until all that are alike are connected. Fingerprints connect copies with few changes, the first
    bands most of the other groups; a later key only matters where it has texts of different components. A key of over
    `KEY_BYTES` is cut by every other band, and those finer keys are compared whole.
    """
    prints = rows.select("fp").distinct()
    near = materialize(components(near_links(prints)).withColumnRenamed("node", "fp"))
    alike = rows.join(near, "fp", "left").select(F.xxhash64(F.lit(-1), F.coalesce("root", "fp")).alias("key"), "th")
    mixed = alike.groupBy("key").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo < hi")
    alike = materialize(alike.join(mixed.select("key"), "key", "left_semi").distinct())
    bands = [F.xxhash64(F.lit(b), F.slice("sig", 1 + b * MINIMA, MINIMA)) for b in range(BANDS)]
    every = rows.select("th", F.posexplode(F.array(*bands)).alias("band", "key"))
    shared = every.groupBy("key").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo < hi")
    members = materialize(every.join(shared.select("key"), "key", "left_semi").distinct())
    met = members.select("th").union(alike.select("th")).distinct()
    busy = rows.join(met, "th", "left_semi").dropDuplicates(["th"])
    texts = materialize(busy.select("th", "sig", "shingles"))
    links: list[DataFrame] = []
    banded = [members.where(c).select("key", "th") for c in (F.col("band") < FIRST_BANDS, F.col("band") >= FIRST_BANDS)]
    for keyed in (alike.select("key", "th"), *banded):
        roots = materialize(components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "th")) if links else None
        found = _linked(keyed, roots, texts, similarity, KEY_BYTES)
        links.append(found.where("v IS NOT NULL").select("u", "v"))
        large = found.where("v IS NULL").select("key", F.col("u").alias("th"))
        if not large.isEmpty():
            again = large.join(texts.select("th", F.array(*bands).alias("others")), "th")
            finer = again.select("th", "key", F.explode("others").alias("other")).where("other <> key")
            finer = finer.select("th", F.xxhash64("key", "other").alias("key"))
            roots = materialize(components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "th"))
            more = _linked(finer, roots, texts, similarity, 1 << 62)
            links.append(more.select("u", "v"))
    return reduce(DataFrame.unionByName, links)


def near_groups(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`key`, `text_hash`, `component_id` and `group` of every document: near duplicates by `similarity`.

    Texts link if of all their distinct shingles of `words` words a share of `similarity` is common. Candidates are
    connected by their fingerprints, as in `near_duplicates`, or agree in one of `BANDS` bands of their signatures, and
    what decides is counted on all their shingles, so that a pair is lost only with its fingerprints and all its bands. `component_id` is the smallest key of a component; `group` tells components apart,
    also those whose keys repeat or are null.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    print_ = fingerprint(spark, F.col("_text"), words).alias("fp")
    rows = own.select("_key", F.xxhash64("_text").alias("th"), print_, _features(spark, F.col("_text"), words).alias("f"))
    rows = materialize(rows.select("_key", "th", "fp", "f.sig", "f.shingles"))
    rooted = materialize(components(_text_links(rows, similarity)).withColumnRenamed("node", "th"))
    whole = rows.select("_key", "th").join(rooted, "th", "left").withColumn("root", F.coalesce("root", "th"))
    names = materialize(whole.groupBy("root").agg(F.min("_key").alias("component_id")))
    return whole.join(names, "root").select(
        F.col("_key").alias(key), F.col("th").alias("text_hash"), "component_id", F.col("root").alias("group")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` without near duplicates: of each group the row with the smallest key stays, null keys last.

    Of rows that share that key, the one with the least text hash stays, then the first by its values. Rows of
    different groups never stand for each other, whatever their keys. Texts that are null or without words are
    alike and form one group. Columns are those of `docs`.
    """
    with passing(docs.sparkSession):  # the sketches need no room once it is known what stays
        found = near_groups(docs, key=key, text=text, **options)
        order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("text_hash").alias("th"))
        first = found.groupBy("group").agg(F.min(order).alias("f"))
        stay = materialize(first.select(F.col("f.key").alias("_key"), F.col("f.th").alias("_th")), lasting=True)
    th = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = packed(docs, key=F.col(key), th=th, hash=F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    kept = rows.join(stay, F.col("key").eqNullSafe(F.col("_key")) & (F.col("th") == F.col("_th")))
    return unpacked(kept.groupBy("key", "th").agg(F.min_by("row", "hash").alias("row")), docs)
