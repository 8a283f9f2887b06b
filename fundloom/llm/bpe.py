"""Byte-pair encoding of whole texts with a given vocabulary, and decoding.

The merges run over a pair occurrence index: all new words of a batch lie in one array of symbols, each
adjacent pair that has a rank is mapped to all positions where it occurs, the ranks that occur are applied
in ascending order, each to all its positions at once, and the lists of the neighbouring pairs are updated.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fundloom.llm.common import give_back, packed, small_batches, unpacked

#: Pieces of text whose ids a task keeps; beyond, it keeps those of the last texts alone. Bounds memory, not results.
KEPT_PIECES = 200_000
#: Bytes of text, or of ids, that a worker turns into Python objects and passes on at once; a longer one stands alone.
PART_BYTES = 2_000_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from U+0100 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class PairMerger:
    """Encodes many words at once."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]], word_end: str):
        symbols = byte_symbols()
        self.plain = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + word_end] for s in symbols], np.int64)
        self.base = max(vocab.values()) + 1
        first = np.array([vocab[a] for a, _ in merges], np.int64)
        second = np.array([vocab[b] for _, b in merges], np.int64)
        self.left, self.right = first, second
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        codes = first * self.base + second
        self.rank_of_code = np.argsort(codes, kind="stable")
        self.codes = codes[self.rank_of_code]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 without one."""
        codes = left * self.base + right
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.rank_of_code[at], -1)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each word has. Words are not empty."""
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        raw = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(sizes) - 1
        sym = self.plain[raw]
        sym[ends] = self.final[raw[ends]]
        n = len(sym)
        follows = np.arange(1, n + 1)
        follows[ends] = -1
        before = np.arange(-1, n - 1)
        before[ends - sizes + 1] = -1

        left, right, made = self.left.tolist(), self.right.tolist(), self.made.tolist()
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            """Enter the pairs that start at these positions."""
            ranks = self.ranks(sym[positions], sym[follows[positions]])
            known = np.flatnonzero(ranks >= 0)
            if not len(known):
                return
            positions, ranks = positions[known], ranks[known]
            order = np.argsort(ranks)
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for a, b in zip(starts, starts[1:]):
                rank = int(ranks[a])
                if rank in index:
                    index[rank].append(positions[a:b])
                else:
                    index[rank] = [positions[a:b]]
                    heapq.heappush(active, rank)

        note(np.flatnonzero(follows >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.concatenate(lists) if len(lists) > 1 else lists[0]
            a, b = left[rank], right[rank]
            if a == b:
                at = np.unique(at)
            nxt = follows[at]
            live = (sym[at] == a) & (nxt >= 0) & (sym[nxt] == b)
            if not live.all():
                at, nxt = at[live], nxt[live]
            if a == b and len(at) > 1:  # in a run of the same symbol every other pair merges, from the left
                fresh = np.ones(len(at), bool)
                fresh[1:] = at[1:] != nxt[:-1]
                heads = np.flatnonzero(fresh)
                place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
                at, nxt = at[place % 2 == 0], nxt[place % 2 == 0]
            if not len(at):
                continue
            after = follows[nxt]
            sym[at] = made[rank]
            sym[nxt] = -1
            follows[at] = after
            inner = after >= 0
            before[after[inner]] = at[inner]
            earlier = before[at]
            note(np.concatenate([earlier[earlier >= 0], at[inner]]))
        live = sym >= 0
        word = np.repeat(np.arange(len(words)), sizes)[live]
        return sym[live].astype(np.int32), np.bincount(word, minlength=len(words))


class Vocabulary:
    """A tokenizer file with lower-case words that end in a mark."""

    def __init__(self, definition: str):
        data = json.loads(definition)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merger = PairMerger(self.vocab, merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        split = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split.replace(r"\s", r"\p{White_Space}"), regex.V0)
        names = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({names})")

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens as themselves."""
        found: list[str] = []
        parts = self.marks.split(text) if "<|" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                found.append(part)
            else:
                # Lower case is taken letter by letter, so a capital sigma at a word's end is not final.
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                found += self.pattern.findall(plain)
        return found


class Pool:
    """Ids by string: words, or space-separated pieces of text."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)

    def add(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        k = len(self.place)
        self.place.update(zip(strings, range(k, k + len(strings))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings of all lists in a row, and how many each list gets."""
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(lists)), np.int64, int(counts.sum()))
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        values = self.ids[np.arange(total) + np.repeat(self.start[at] - (ends - sizes), sizes)]
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return values, np.diff(edges)


class Encoder:
    """Encodes the texts of one task, chunk by chunk, and remembers words and space-separated pieces.

    No word reaches over a space, so a piece has the same ids wherever it stands.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.forget()

    def forget(self) -> None:
        self.words, self.pieces = Pool(), Pool()
        special = self.v.special
        self.words.add(list(special), np.array(list(special.values()), np.int32), np.ones(len(special), np.int64))

    def keep(self, pieces: list[str]) -> None:
        """Forget all but these pieces."""
        known = self.pieces.gather([[p] for p in pieces])
        self.forget()
        self.pieces.add(pieces, *known)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        per_text = [t.replace("\n", " ").split(" ") for t in texts]
        distinct = set().union(*per_text)
        if len(self.pieces.place) > KEPT_PIECES:
            self.keep(list(distinct.intersection(self.pieces.place)))
        pieces = list(distinct.difference(self.pieces.place))
        if pieces:
            per_piece = [self.v.words(p) for p in pieces]
            words = list(set().union(*per_piece).difference(self.words.place))
            if words:
                self.words.add(words, *self.v.merger.encode(words))
            self.pieces.add(pieces, *self.words.gather(per_piece))
        return self.pieces.gather(per_text)


def parts(values: pa.Array) -> Iterator[pa.Array]:
    """Texts or lists of ids in slices, in order, each of `PART_BYTES` at most or one value."""
    if pa.types.is_null(values.type):
        sizes = pa.nulls(len(values), pa.int32())
    elif pa.types.is_list(values.type):
        sizes = pc.multiply(pc.list_value_length(values), 4)
    else:
        sizes = pc.binary_length(values)
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, before = 0, 0
    while at < len(values):
        end = max(at + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
        yield values[at:end]
        at, before = end, int(ends[end - 1])


def _definition(spark: SparkSession, tokenizer_path: str):
    """The tokenizer's file, of fixed size, is read on the driver and sent with the job."""
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoded(encoder: Encoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts in a row, and where each text's begin."""
    ids, counts = encoder.encode([t or "" for t in texts.to_pylist()])
    return ids, np.concatenate([[0], np.cumsum(counts)])


def _listed(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids, pa.int32()))


class Decoder:
    """The text of ids: the file names no decoder, so tokens are joined by spaces, special ones included."""

    def __init__(self, definition: str):
        data = json.loads(definition)
        tokens = {i: t for t, i in data["model"]["vocab"].items()}
        tokens.update({t["id"]: t["content"] for t in data["added_tokens"]})
        self.tokens = [tokens.get(i) for i in range(max(tokens) + 1)]

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.tokens))]
        return " ".join(t for t in map(self.tokens.__getitem__, ids.tolist()) if t is not None)


def _encodings(definition: str, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    encoder = Encoder(Vocabulary(definition))
    for part in chain.from_iterable(map(parts, batches)):
        yield _listed(*_encoded(encoder, part))


def _decodings(definition: str, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    decoder = Decoder(definition)
    for part in chain.from_iterable(map(parts, batches)):
        texts = []
        for row in part:
            known = row.values.drop_null().to_numpy() if row.is_valid else np.empty(0, np.int32)
            texts.append(decoder.decode(known))
        yield pa.array(texts, pa.string())


def _round_trips(definition: str, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    encoder, decoder = Encoder(Vocabulary(definition)), Decoder(definition)
    for part in chain.from_iterable(map(parts, batches)):
        ids, starts = _encoded(encoder, part)
        texts = [decoder.decode(ids[s:e]) for s, e in zip(starts[:-1], starts[1:])]
        yield pa.StructArray.from_arrays([_listed(ids, starts), pa.array(texts, pa.string())], ["ids", "decoded"])


def encoded(spark: SparkSession, text: Column, tokenizer_path: str) -> Column:
    """The ids of a text, array<int>; none for a null or empty text."""
    definition = _definition(spark, tokenizer_path)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _encodings(definition.value, batches)
        give_back()

    return encode(text)


def decoded(spark: SparkSession, ids: Column, tokenizer_path: str) -> Column:
    """The text of ids. Unknown ids and nulls are passed over; a null array gives an empty text."""
    definition = _definition(spark, tokenizer_path)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _decodings(definition.value, batches)
        give_back()

    return decode(ids)


def there_and_back(spark: SparkSession, text: Column, tokenizer_path: str) -> Column:
    """Struct of `ids` and of `decoded`, the text decoded from those ids, in one worker."""
    definition = _definition(spark, tokenizer_path)

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _round_trips(definition.value, batches)
        give_back()

    return both(text)


def encode_documents(
    docs: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids", n: str = "n_tokens"
) -> DataFrame:
    """`docs` with the ids of each whole text and their number; every row stays, repeated ones too.

    A null or empty text has no ids. Columns named `ids` or `n` are replaced.
    """
    out = docs.withColumn(ids, encoded(docs.sparkSession, F.col(text), tokenizer_path))
    return out.withColumn(n, F.size(ids).cast("long"))


def decode_documents(
    tokens: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """`tokens` with the text of each array of ids."""
    return tokens.withColumn(text, decoded(tokens.sparkSession, F.col(ids), tokenizer_path))


def round_trip_documents(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    ids: str = "ids",
    n: str = "n_tokens",
    decoded_text: str = "decoded",
) -> DataFrame:
    """`docs` with ids, their number and the text decoded from them, as `decode_documents` after
    `encode_documents` gives it, with one Python worker for a task instead of two."""
    rows = packed(docs, found=there_and_back(docs.sparkSession, F.col(text), tokenizer_path))
    found = {ids: F.col("found.ids"), n: F.size("found.ids").cast("long"), decoded_text: F.col("found.decoded")}
    return unpacked(rows, docs, **found)
