"""Total order over large tables without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.session import materialize

_TASK_BITS = 33  # monotonically_increasing_id keeps the task number above these bits


def global_positions(
    df: DataFrame, order: Sequence[Column], name: str = "position", runs: Sequence[str] = ()
) -> DataFrame:
    """0-based place of every row in `order`, which should be total.

    The range partitioning splits even a heavily repeated leading key as long as the later columns tell
    its rows apart. The sorted rows are materialized, so the counts that give each task its offset and the
    rows that receive it come from the same files, also after an executor is lost.

    With `runs`, leading columns of the order, `<name>_run` is the first place of the run of rows that are equal in
    them: found within the sorted task, and for the run at a task's start taken from the tasks before, one row each.
    """
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    kept = materialize(ordered).withColumn("_task", F.shiftrightunsigned("_at", _TASK_BITS))
    local = F.col("_at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    facts = [F.count(F.lit(1)).alias("_size")]
    if runs:
        inside = Window.partitionBy("_task").orderBy("_at")
        value = F.struct(*[F.col(c) for c in runs])
        starts = ~F.lag(value).over(inside).eqNullSafe(value)
        kept = kept.withColumn("_starts", F.when(starts, local))
        kept = kept.withColumn("_run", F.last("_starts", ignorenulls=True).over(inside)).drop("_starts")
        facts += [F.min_by(value, "_at").alias("_head"), F.max_by(value, "_at").alias("_tail"), F.max("_run").alias("_last")]
    tasks = kept.groupBy("_task").agg(*facts)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    tasks = tasks.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    if runs:
        one = Window.orderBy("_task")
        fresh = ~F.lag("_tail").over(one).eqNullSafe(F.col("_head")) | (F.row_number().over(one) == 1)
        tasks = tasks.withColumn("_fresh", fresh)
        known = F.when((F.col("_last") > 0) | F.col("_fresh"), F.col("_offset") + F.col("_last"))
        tasks = tasks.withColumn("_known", known)
        carried = F.when(F.col("_fresh"), F.col("_offset")).otherwise(F.last("_known", ignorenulls=True).over(before))
        tasks = tasks.withColumn("_carried", carried)
    found = kept.join(F.broadcast(tasks.select("_task", "_offset", *(["_carried"] if runs else []))), "_task")
    found = found.withColumn(name, F.col("_offset") + local)
    if runs:
        run = F.when(F.col("_run") == 0, F.col("_carried")).otherwise(F.col("_offset") + F.col("_run"))
        found = found.withColumn(f"{name}_run", run).drop("_run", "_carried")
    return found.drop("_at", "_task", "_offset")


def rank_and_decile(scores: DataFrame, group: str, key: str, score: str, tiles: int = 10) -> DataFrame:
    """Competition rank by descending score and its tile within each group; ties fall by key.

    A group, or one score of it, may hold any share of the rows: places and the first place of each run of
    equal scores come from one range sort.
    """
    known = scores.where(F.col(score).isNotNull()).select(group, key, score)
    placed = global_positions(
        known, [F.col(group), F.col(score).desc(), F.col(key)], "_place", runs=[group, score]
    )
    groups = placed.groupBy(group).agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_n"))
    at = F.col("_place") - F.col("_start")
    small = F.floor(F.col("_n") / tiles)
    larger = F.col("_n") % tiles
    edge = larger * (small + 1)
    tile = F.when(at < edge, F.floor(at / (small + 1)) + 1).otherwise(
        F.floor(F.try_divide(at - edge, small)) + larger + 1
    )
    return placed.join(groups, group).select(
        group,
        F.col(key).alias("fund_id"),
        F.col(score).alias("expected_alpha"),
        (F.col("_place_run") - F.col("_start") + 1).alias("rank"),
        tile.alias("decile"),
    )


def generated_fund_ids(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sequential ids fund_0, fund_1, ... in the given order."""
    numbered = global_positions(df, order, "_no")
    return numbered.withColumn("fund_id", F.concat(F.lit("fund_"), F.col("_no").cast("string"))).drop("_no")


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_and_bottom(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The n best and n worst rows by a measure, nulls never among them unless nothing else is left."""
    best = top_rows(df, [F.desc_nulls_last(measure), F.asc(key)], n).withColumn("side", F.lit("top"))
    worst = top_rows(df, [F.asc_nulls_last(measure), F.asc(key)], n).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def spot_check_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 1011) -> DataFrame:
    """A repeatable random sample for manual checks: the n rows with the smallest MD5 of their keys and the seed,
    joined by bars, as any database has it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text.cast("binary")), *keys).limit(n)
