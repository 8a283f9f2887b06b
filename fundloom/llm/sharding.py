"""Shards by jump consistent hashing: a key and the number of shards decide, without a ring table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from fundloom.llm.common import numbered, packed, unpacked

_MULTIPLIER = Decimal(2862933555777941757)  # of the published generator
_WORD = Decimal(2**64)
#: Hexadecimal digits that deal a shard's rows to windows: 4096 of them.
BLOCK_DIGITS = 3


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of an integer key taken as an unsigned 64-bit number; null counts as 0.

    From `shards` to `shards + 1` a key stays where it is or moves to the new shard. The key walks through
    the shards it would jump to, at most `shards` steps.
    """
    whole = F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)")
    start = F.when(whole < 0, whole + F.lit(_WORD)).otherwise(whole).cast("decimal(20,0)")

    def step(state: Column, _: Column) -> Column:
        following = ((state["k"] * F.lit(_MULTIPLIER) + 1) % F.lit(_WORD)).cast("decimal(20,0)")
        jumped = F.transform(
            F.array(following),
            lambda k: F.struct(
                k.alias("k"),
                state["j"].alias("at"),
                F.floor(
                    (state["j"] + 1).cast("double")
                    * (F.lit(2147483648.0) / (F.floor(k / F.lit(2**33)).cast("double") + 1))
                )
                .cast("long")
                .alias("j"),
            ),
        )[0]
        return F.when(state["j"] >= shards, state).otherwise(jumped)

    state = F.struct(start.alias("k"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("j"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), state, step, lambda s: s["at"].cast("int"))


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with size, text_crc32, law, shard, slot and grown_shard; columns of these names are replaced.

    The shard follows from the key and the number of shards alone, so equal keys share a shard, repeated rows
    stay, and one more shard takes rows only into itself. A null key counts as 0; a null text has no bytes.
    Slots are gapless from 0 in each shard, by a digest of key, size and checksum, so that rows of one key spread
    over as many windows as others; rows equal in all three are interchangeable.
    """
    own = F.coalesce(F.col(text), F.lit("")).cast("binary")
    placed = packed(
        docs,
        key=F.col(key),
        size=(F.octet_length(own) + 1).cast("long"),
        crc=F.crc32(own),
        shard=jump_hash(F.col(key), shards),
        grown=jump_hash(F.col(key), shards + 1),
    )
    own_facts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("key", "size", "crc")]
    block = F.substring(F.md5(F.concat_ws("|", *own_facts).cast("binary")), 1, BLOCK_DIGITS)
    order = [F.col("key"), F.col("size"), F.col("crc")]
    found = numbered(placed, [F.col("shard")], block, order, "slot")
    return unpacked(
        found,
        docs,
        size=F.col("size"),
        text_crc32=F.col("crc"),
        law=F.lit("key"),
        shard=F.col("shard"),
        slot=F.col("slot"),
        grown_shard=F.col("grown"),
    )
