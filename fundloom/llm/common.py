"""What the text operators share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Words are runs without these: space and the control characters 09 to 0D (as `bytes.split` has it).
SPACES = r"[\x20\x09-\x0D]+"
#: Documents that one Arrow batch holds at most; a task's memory follows the length of so many texts.
BATCH_ROWS = 2000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of texts by a documented number of rows, unless the session has a smaller one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return to the system what Arrow and the C library hold of freed memory: Spark keeps workers for later tasks,
    two or more for each core, and idle ones count too. Other C libraries than glibc have no such call."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of `docs` as one column `row` beside the given ones, so that no name of theirs can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, *[c.alias(name) for name, c in columns.items()])


def unpacked(rows: DataFrame, docs: DataFrame, **columns: Column) -> DataFrame:
    """The columns of `docs` again, then the given ones, which take the place of columns of their names."""
    old = [F.col(f"row.`{c}`") for c in docs.columns if c not in columns]
    return rows.select(*old, *[c.alias(name) for name, c in columns.items()])


def numbered(df: DataFrame, group: list[Column], block: Column, order: list[Column], name: str) -> DataFrame:
    """0-based gapless numbers within each group, without one task per group.

    `block` splits a group into as many parts as the caller wants; rows are numbered inside (group, block)
    and start at the number of rows in the group's earlier blocks. Those counts are one row per group and
    block. `order` should tell rows apart: equal rows are interchangeable.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    rows = df.withColumns({**dict(zip(keys, group)), "_block": block})
    sizes = rows.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"_s{k}") for k in keys],
        F.col("_block").alias("_sblock"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    same = [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in keys] + [F.col("_block") == F.col("_sblock")]
    condition = same[0]
    for c in same[1:]:
        condition &= c
    return (
        rows.withColumn("_at", F.row_number().over(inside))
        .join(starts, condition)
        .withColumn(name, (F.col("_start") + F.col("_at") - 1).cast("long"))
        .drop(*keys, "_block", *[f"_s{k}" for k in keys], "_sblock", "_start", "_at")
    )
