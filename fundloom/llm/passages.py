"""Repeated passages: windows of words found by doubling their length, and texts without the later copies.

A window of 20 words is looked at through its part of the least hash among its parts of 10 words, then as a
whole (of 40: of 10, 20, then 40). Equal windows choose equal parts, so a window whose part occurs once occurs
once itself, and only windows whose part repeats are looked at again at twice the length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from fundloom.llm.common import SPACES, give_back, small_batches
from fundloom.session import materialize

#: Words of a window.
WINDOW = 20
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two window hashes
_ROWS = 200_000
#: Texts that a task knows again; beyond, it forgets them.
_KEPT_TEXTS = 500_000
#: Bytes of texts that are taken apart at once; memory follows this and the longest text.
PART_BYTES = 2_000_000
_LOW = np.uint64((1 << 32) - 1)
_LONG = 64  # bytes of a word that is hashed by itself
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def levels(window: int) -> list[int]:
    """The lengths looked at, each twice the one before; the last is the window."""
    if window < 8 or window % 2:
        raise ValueError("a window has an even number of words, 8 or more")
    found = [window]
    while found[0] % 2 == 0 and (len(found) == 1 or found[0] >= 16):
        found.insert(0, found[0] // 2)
    return found


def word_hashes(words: pa.Array) -> np.ndarray:
    """The hash of each word: its length, then eight bytes at a time, mixed in; of long words XXH64."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    padded = np.concatenate([letters, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(letters) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each one on
    at, sizes = ends[:-1], np.diff(ends)
    hashes = sizes.astype(np.uint64) * np.uint64(_FACTORS[0])
    on = slice(None)
    for done in range(0, min(_LONG, int(sizes.max(initial=0))), 8):
        if done:
            on = np.flatnonzero(sizes > done)
        kept = _FIRST_BYTES[np.minimum(sizes[on] - done, 8)]
        hashes[on] = _mixed(hashes[on] ^ (eight[np.minimum(at[on] + done, len(letters))] & kept))
    for i in np.flatnonzero(sizes > _LONG).tolist():
        hashes[i] = xxhash.xxh64_intdigest(letters[ends[i] : ends[i + 1]])
    return hashes


class _Words:
    """The words of several texts, one text after the other; blank texts count as one empty word."""

    def __init__(self, texts: pa.Array):
        self.lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
        self.sizes = _sizes(self.lists)
        self.starts = _before(self.sizes)
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def inside(self, window: int) -> np.ndarray:
        """For each position whether a window from there on ends in the same text; as many as there are windows."""
        n = max(0, len(self.text) - window + 1)
        return self.text[:n] == self.text[len(self.text) - n :]


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _before(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), values)


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts have about `PART_BYTES` together, or one text."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
            part = np.cumsum(sizes, dtype=np.int64) // PART_BYTES
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for at, end in zip(edges, edges[1:]):
                yield batch.slice(at, end - at)
    give_back()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """The hash of the `length` words from each position on, found by doubling."""
    factor = _FACTORS[which]
    now, power, size = words, factor, 1
    for bit in bin(length)[3:]:
        n = max(0, len(words) - 2 * size + 1)
        now, power, size = now[:n] * np.uint64(power) + now[size : size + n], pow(power, 2, 1 << 64), 2 * size
        if bit == "1":
            n = max(0, len(words) - size)
            now = now[:n] * np.uint64(factor) + words[size : size + n]
            power, size = power * factor % (1 << 64), size + 1
    return _mixed(now)


def chosen_parts(hashes: np.ndarray, window: int, length: int) -> np.ndarray:
    """For each window the position of its part of least hash (of the upper 32 bits), the leftmost if equal."""
    inside, size = window - length + 1, 1
    if len(hashes) < inside:
        return np.empty(0, np.int64)
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    while 2 * size <= inside:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < inside:
        least = np.minimum(least[: size - inside], least[inside - size :])
    return (least & _LOW).astype(np.int64)


def _spans(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the words of each stretch: the difference of two sums, moved to where the stretch starts."""
    back = np.cumprod(np.append(np.uint64(1), np.full(len(words), pow(_FACTORS[1], -1, 1 << 64), np.uint64)))
    ahead = np.cumprod(np.append(np.uint64(1), np.full(len(words), _FACTORS[1], np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(words * back[:-1]))
    return _mixed((sums[starts + sizes] - sums[starts]) * ahead[starts])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class _Rows:
    """Collects arrays and gives them out as record batches of bounded size."""

    def __init__(self, names: list[str]):
        self.names, self.held, self.n = names, [], 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.held.append(columns)
            self.n += len(columns[0])

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.n >= _ROWS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            whole = [np.concatenate(c) for c in zip(*self.held)]
            self.held, self.n = [], 0
            for at in range(0, len(whole[0]), _ROWS):
                part = [c[at : at + _ROWS] for c in whole]
                arrays = [_signed(c) if c.dtype == np.uint64 else pa.array(c) for c in part]
                yield pa.record_batch(arrays, self.names)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any of the columns; the first row does."""
    differ = np.ones(len(columns[0]), bool)
    differ[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(differ)


def _first_level(window: int):
    """Rows (h, d, p) of the chosen parts of the first length, from texts; of equal texts in a task, once."""
    length = levels(window)[0]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seen = _Rows(["h", "d", "p"]), set()
        for batch in _slices(batches, 0):
            words = _Words(batch.column(0))
            joined = pc.binary_join(words.lists, " ").cast(pa.binary())
            d, new = np.zeros(len(joined), np.uint64), np.zeros(len(joined), bool)
            for i in np.flatnonzero(words.sizes >= window).tolist():
                d[i] = one = xxhash.xxh64_intdigest(joined[i].as_buffer(), 42)
                if one not in seen:
                    if len(seen) >= _KEPT_TEXTS:
                        seen.clear()
                    seen.add(one)
                    new[i] = True
            h = window_hashes(word_hashes(words.lists.flatten()), length)
            live = np.flatnonzero(words.inside(window) & new[words.text[: max(0, len(words.text) - window + 1)]])
            at = chosen_parts(h, window, length)[live]
            at = at[_changes(at)]
            text = words.text[at]
            rows.add(h[at], d[text], (at - words.starts[text]).astype(np.int32))
            yield from rows.full()
        yield from rows.rest()

    return emit


def _live(words: _Words, marks: pa.Array, h: np.ndarray, window: int, length: int):
    """The windows whose chosen part of `length` is among the repeated ones, and these parts."""
    marked = np.zeros(len(words.text) + 1, bool)
    marked[np.repeat(words.starts, _sizes(marks)) + marks.flatten().to_numpy()] = True
    parts = chosen_parts(h, window, length)
    live = np.flatnonzero(words.inside(window) & marked[parts])
    return live, parts[live]


def _next_level(window: int, level: int):
    """Rows (h, d, p) of the chosen parts of a middle length, from texts with the repeated parts before."""
    before, length = levels(window)[level - 1 : level + 1]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(["h", "d", "p"])
        for batch in _slices(batches, 1):
            words = _Words(batch.column(1))
            each = word_hashes(words.lists.flatten())
            live, _ = _live(words, batch.column(2), window_hashes(each, before), window, before)
            h = window_hashes(each, length)
            at = chosen_parts(h, window, length)[live]
            at = at[_changes(at)]
            text = words.text[at]
            rows.add(h[at], batch.column(0).to_numpy()[text], (at - words.starts[text]).astype(np.int32))
            yield from rows.full()
        yield from rows.rest()

    return emit


def _stretches(window: int, level: int):
    """Rows (h, d, s, n, words) from texts with their repeated parts: one for each run of windows that share
    such a part, with the part's hash, where the run starts, how many windows it has and a hash of its words."""
    length = levels(window)[level]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(["h", "d", "s", "n", "words"])
        for batch in _slices(batches, 1):
            words = _Words(batch.column(1))
            each = word_hashes(words.lists.flatten())
            h = window_hashes(each, length)
            live, at = _live(words, batch.column(2), h, window, length)
            if not len(live):
                continue
            heads = _changes(live - np.arange(len(live)), at)
            n = np.diff(np.append(heads, len(live)))
            s, text = live[heads], words.text[live[heads]]
            rows.add(
                h[at[heads]], batch.column(0).to_numpy()[text], (s - words.starts[text]).astype(np.int32),
                n.astype(np.int32), _spans(each, s, n + window - 1),
            )
            yield from rows.full()
        yield from rows.rest()

    return emit


def _runs(words: _Words, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs (s, n) of each text start among all `words`, and their n."""
    s, n = (c.to_numpy().astype(np.int64) for c in runs.flatten().flatten())
    return np.repeat(words.starts, _sizes(runs)) + s, n


def _whole_windows(window: int):
    """Rows (h, g, d, s) of single windows, two hashes each, from texts with the runs (s, n) to open."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(["h", "g", "d", "s"])
        for batch in _slices(batches, 1):
            words = _Words(batch.column(1))
            each = word_hashes(words.lists.flatten())
            s, n = _runs(words, batch.column(2))
            at = np.repeat(s - _before(n), n) + np.arange(n.sum())
            h, g = (window_hashes(each, window, w) for w in (0, 1))
            text = words.text[at]
            d = batch.column(0).to_numpy()[text]
            rows.add(h[at], g[at], d, (at - words.starts[text]).astype(np.int32))
            yield from rows.full()
        yield from rows.rest()

    return emit


def _repeated(rows: DataFrame) -> DataFrame:
    """(d, marks): of each text the parts that also occur in another text or elsewhere in it."""
    rows = materialize(rows)  # read twice, hashed once
    place = F.xxhash64("d", "p")
    twice = rows.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("h")
    # as a table of its own, so that a part which a third of all texts have is split by size in the join
    found = rows.join(materialize(twice), "h").select("d", "p").distinct()
    return found.groupBy("d").agg(F.collect_list("p").alias("marks"))  # as many as the text has words, at most


def summaries(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, th, d, n_words, whole_sha256) of every row: the hash of its text, the identity of its word
    sequence, and what is left of it if nothing goes."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), "")
    joined = F.array_join(words, " ")
    return docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("th"),
        F.xxhash64(joined).alias("d"),
        F.size(words).cast("long").alias("n_words"),
        F.sha2(joined.cast("binary"), 256).alias("whole_sha256"),
    )


def repeated_runs(docs: DataFrame, rows: DataFrame, window: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(d, doc_id, text, marks) of the texts that may hold a repeated window, one for each word sequence, and
    (d, s, n): runs of n windows from s on that also start earlier. `rows` are the summaries of `docs`."""
    small_batches(docs.sparkSession)
    lengths = levels(window)
    last = len(lengths) - 2
    texts = docs.select(F.col(text).alias("text"))
    marks = _repeated(texts.mapInArrow(_first_level(window), "h long, d long, p int"))
    least = rows.where(F.col("n_words") >= window).groupBy("d").agg(F.min(F.struct("doc_id", "th")).alias("least"))
    chosen = marks.join(least, "d").select("d", "least.*", "marks").withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    same = (named["th"] == chosen["_th"]) & named["doc_id"].eqNullSafe(chosen["_id"])
    held = materialize(named.join(chosen, same).select("d", "doc_id", "text", "marks"))
    for level in range(1, last + 1):
        found = held.select("d", "text", "marks").mapInArrow(_next_level(window, level), "h long, d long, p int")
        held = materialize(held.drop("marks").join(_repeated(found), "d"))

    runs = held.select("d", "text", "marks").mapInArrow(_stretches(window, last), "h long, d long, s int, n int, words long")
    names = materialize(held.select("d", "doc_id").distinct())
    runs = materialize(runs.join(names, "d"))
    # Runs with the same words hold the same windows: the earliest stands for all, the others go as a whole.
    start = F.struct("doc_id", "d", "s").alias("start")
    kinds = materialize(runs.groupBy("h", "words", "n").agg(F.min(start).alias("first"), F.count("*").alias("k")))
    many = kinds.where("k > 1").select("h", "words", "n", F.col("first.d").alias("_d"), F.col("first.s").alias("_s"))
    later = runs.join(many, ["h", "words", "n"]).where((F.col("d") != F.col("_d")) | (F.col("s") != F.col("_s")))
    # Where runs with different words share a part, their windows are compared one by one.
    differ = materialize(kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select("h"))
    opened = kinds.join(differ, "h").select(F.col("first.d").alias("d"), F.col("first.s").alias("s"), "n")
    opened = opened.groupBy("d").agg(F.collect_list(F.struct("s", "n")).alias("runs"))
    windows = held.drop("marks").join(opened, "d").select("d", "text", "runs")
    windows = windows.mapInArrow(_whole_windows(window), "h long, g long, d long, s int").distinct()
    windows = materialize(windows.join(names, "d"))
    earliest = windows.groupBy("h", "g").agg(F.min(start).alias("first"), F.count("*").alias("k")).where("k > 1")
    earliest = materialize(earliest.select("h", "g", F.col("first.d").alias("_d"), F.col("first.s").alias("_s")))
    single = windows.join(earliest, ["h", "g"]).where((F.col("d") != F.col("_d")) | (F.col("s") != F.col("_s")))
    removed = later.select("d", "s", "n").unionByName(single.select("d", "s", F.lit(1).alias("n")))
    return held, removed


def _cut(window: int):
    """(d, kept, n_removed, spans) from texts and their runs of repeated windows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1):
            words = _Words(batch.column(1))
            s, n = _runs(words, batch.column(2))
            total, count = len(words.text), batch.num_rows
            edge = np.bincount(s, minlength=total + 1) - np.bincount(s + n + window - 1, minlength=total + 1)
            covered = np.cumsum(edge[:-1]) > 0
            left = words.lists.flatten().filter(pa.array(~covered))
            left = _lists(left, np.bincount(words.text[~covered], minlength=count))
            gone = np.bincount(words.text[covered], minlength=count)
            # a span ends with its text, whatever the next one starts with
            kind = np.where(covered, words.text + 1, 0)
            starts = np.flatnonzero(covered & (np.append(0, kind[:-1]) != kind))
            ends = np.flatnonzero(covered & (np.append(kind[1:], 0) != kind)) + 1
            text = words.text[starts]
            bounds = [pa.array((x - words.starts[text]).astype(np.int32)) for x in (starts, ends)]
            spans = _lists(pa.StructArray.from_arrays(bounds, ["start", "end"]), np.bincount(text, minlength=count))
            yield pa.record_batch(
                [batch.column(0), pc.binary_join(left, " "), pa.array(gone), spans],
                ["d", "kept", "n_removed", "spans"],
            )

    return emit


def repeated_passages(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row key, `n_words`, `n_removed`, and for those that lose words `spans` (word offsets, end
    exclusive) and `kept`, the other words joined by one space. `whole_sha256` is that of all words so joined.

    A word goes if a window of `window` words covers it whose word sequence also starts earlier: in a document
    with a smaller key, or before it in the same one. Windows are judged on the input. Later copies of a whole
    word sequence lose all words if there are `window` or more. Texts that are null or shorter lose nothing.
    Rows that repeat a key and its words are one document; texts that share a key but not their words are
    ordered by the hash of their words; a null key comes first.
    """
    rows = materialize(summaries(docs, key, text))
    held, removed = repeated_runs(docs, rows, window, key, text)
    runs = removed.groupBy("d").agg(F.collect_list(F.struct("s", "n")).alias("runs"))
    changed = held.select("d", "text").dropDuplicates(["d"]).join(runs, "d")
    changed = changed.mapInArrow(
        _cut(window), "d long, kept string, n_removed long, spans array<struct<start:int,end:int>>"
    )
    firsts = rows.where(F.col("n_words") >= window).groupBy("d").agg(F.min(F.struct("doc_id")).alias("first"))
    firsts = firsts.select("d", "first", F.lit(True).alias("_long"))
    copy = F.coalesce(F.col("_long"), F.lit(False)) & ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return (
        rows.join(firsts, "d", "left")
        .join(changed, "d", "left")
        .withColumn("_copy", copy)
        .select(
            F.col("doc_id").alias(key),
            "n_words",
            F.when(F.col("_copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("_copy"), whole).otherwise(F.col("spans")).alias("spans"),
            F.when(F.col("_copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
            "whole_sha256",
        )
    )
