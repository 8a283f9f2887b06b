"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundloom.llm import bpe, langid, mixing, secret_scan, simhash
from fundloom.llm.catalog import BYTE_RANKS, WORD_BPE
from fundloom.llm.common import read
from fundloom.session import discard, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language stays doubtful, go."""
    return langid.in_known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles are alike by 0.8 or more, one stays."""
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and the length of changed texts counted anew; every document stays."""
    return secret_scan.redact_secrets(docs, BYTE_RANKS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the order of the mixture; every document stays."""
    return mixing.in_mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens and the decoded text of every document, and its block, slot and position in
    the mixture, which follow from the keys and sources of the rows: `ORDER BY position` restores it anywhere."""
    placed = mixing.mix(docs.select("doc_id", "source", "text"))
    found = bpe.round_trip_documents(placed, WORD_BPE)
    return found.select("doc_id", "source", "ids", "n_tokens", "decoded", "block", "slot", "position")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixture", mix_sources),
    ("tokens", encode),
]

#: Trained networks, fingerprints by XXH64 and a BPE vocabulary are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each earlier stage is a table in the shared folder, deleted when the next is written."""
    docs = read(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES[:-1]):
        kept = materialize(stage(spark, docs, sf_dir))
        if at:
            discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
