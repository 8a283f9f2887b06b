"""Secrets in whole texts: fixed patterns, and random strings by how few characters a token holds."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fundloom.llm.common import packed, small_batches, unpacked

# The kinds in their order, their patterns and the least length of what they find.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
#: Candidates for random strings: their alphabet and least length.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Random strings have fewer characters per token than this; words and identifiers have more.
CHARS_PER_TOKEN = 2.0
#: Lengths of hexadecimal digests (MD5, SHA-1 and SHA-2), which are known and not secret by themselves.
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)
UUID = r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
#: Parts of an identifier: words by their capitals, and numbers, which have so many digits at most.
PART = r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+"
NUMBER_DIGITS = 4
#: Letters that a token of the vocabulary has at least to count as a known word.
WORD_CHARS = 3
#: Pieces between separators that count as names of any kind, such as x86, have so many characters at most.
PIECE_CHARS = 3
#: Further forms of identifiers: timestamps; stretches of the alphabet are parts like words.
TIMESTAMP = r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-]?[0-9]{2}-?[0-9]{2}(?:-?[0-9]{2})?Z?(?:[+_-][0-9]{1,6})?"
ALPHABET = "abcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:int,end:int>>"


class Scanner:
    """Finds the spans of one text after another; offsets count code points, ends are exclusive."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_CHARS - 4},}}")
        self.hex = re.compile(rf"[0-9a-f]{{{HEX_CHARS},}}")
        self.candidate = re.compile(CANDIDATE)
        self.part, self.timestamp = re.compile(PART), re.compile(TIMESTAMP)
        words = (t.strip().lower() for t in table)
        self.words = {w.decode() for w in words if len(w) >= WORD_CHARS and w.isalpha() and w.isascii()}
        self.uuid = re.compile(UUID)
        self.letter = re.compile("[A-Za-z]")
        self.digest = re.compile("[0-9a-f]+|[0-9A-F]+")

    def is_known(self, part: str) -> bool:
        """A known word, a stretch of the alphabet or a short number."""
        if part.isdigit():
            return len(part) <= NUMBER_DIGITS
        return part.lower() in self.words or (len(part) > PIECE_CHARS and part.lower() in ALPHABET)

    def is_identifier(self, found: str) -> bool:
        """A timestamp, or pieces that are short or made of known parts only."""
        pieces = re.split("[+/_=-]+", found)
        known = (len(p) <= PIECE_CHARS or all(map(self.is_known, self.part.findall(p))) for p in pieces)
        return bool(self.timestamp.fullmatch(found)) or all(known)

    def is_random(self, found: str) -> bool:
        if not self.letter.search(found):
            return False
        if len(found) >= CHARS_PER_TOKEN * len(self.encoding.encode_ordinary(found)):
            return False
        if len(found) in DIGEST_CHARS and self.digest.fullmatch(found):
            return False
        return not (self.uuid.fullmatch(found) or self.is_identifier(found))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) in order."""
        found = []
        lower = text.lower()
        if any(k in lower for k in KEYWORDS):
            for m in self.assign.finditer(text):
                if m.end(1) - m.start(1) >= ASSIGN_CHARS:
                    found.append((m.start(), 0, m.end()))
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        found.sort()
        covered, random = _runs(found), []
        at = 0
        for m in self.candidate.finditer(text):  # in order, as the covered runs are
            s, e = m.span()
            while at < len(covered) and covered[at][1] < e:
                at += 1
            whole = at < len(covered) and covered[at][0] <= s
            if not whole and self.is_random(m.group()):
                random.append((s, 3, e))
        return sorted(found + random)


def _runs(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """Spans in order as runs [start, end) that do not meet."""
    runs: list[list[int]] = []
    for s, _, e in spans:
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    return runs


def _scanner(spark: SparkSession, ranks_path: str):
    small_batches(spark)
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size


def secret_spans(spark: SparkSession, text: Column, ranks_path: str) -> Column:
    """The spans (kind, start, end) of a whole text by start, then kind in the order of `KINDS`."""
    ranks = _scanner(spark, ranks_path)

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(ranks.value)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t.as_py() or "")]
                for t in batch
            ]
            yield pa.array(rows, pa.list_(kind))

    return scan(text)


def find_secrets(docs: DataFrame, ranks_path: str, text: str = "text", name: str = "secrets") -> DataFrame:
    """`docs` with the spans of each whole text; a column of that name is replaced.

    assign, access and hex are the fixed patterns; random adds strings with few characters per token that are
    no digest, UUID or identifier; one that the other spans cover as a whole is not listed again. A null or empty text has none; every row stays.
    """
    return docs.withColumn(name, secret_spans(docs.sparkSession, F.col(text), ranks_path))


def redact_secrets(
    docs: DataFrame, ranks_path: str, text: str = "text", n_chars: str = "n_chars", mark: str = "[SECRET]"
) -> DataFrame:
    """`docs` with each run of overlapping spans replaced by `mark`, and the length of changed texts anew.

    Other texts, null ones too, and all other columns stay as they are; no row is dropped.
    """
    ranks = _scanner(docs.sparkSession, ranks_path)

    @F.arrow_udf("string")
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(ranks.value)
        for batch in batches:
            out = []
            for t in batch:
                whole = t.as_py() or ""
                parts, at = [], 0
                for s, _, e in scanner.spans(whole):
                    if s >= at:
                        parts += [whole[at:s], mark]
                    at = max(at, e)
                out.append("".join([*parts, whole[at:]]) if parts else None)
            yield pa.array(out, pa.string())

    rows = packed(docs, changed=redact(F.col(text)))
    new = {text: F.coalesce("changed", F.col(f"row.`{text}`"))}
    if n_chars in docs.columns:
        count = F.length("changed").cast(docs.schema[n_chars].dataType)
        new[n_chars] = F.coalesce(count, F.col(f"row.`{n_chars}`"))
    return unpacked(rows, docs, **new).select(*[F.col(f"`{c}`") for c in docs.columns])
