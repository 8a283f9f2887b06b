"""Writers. A result is written to a new path; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

REPORT_CODECS = {"parquet", "csv", "json"}


def sink_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def sink_parquet_partitioned(
    df: DataFrame, path: str, partition_cols: tuple[str, ...] = ("year", "month")
) -> str:
    """Hive-partitioned files. Rows are brought together by partition first, which bounds the open files of a
    task; measured sizes decide how many tasks share a large partition."""
    gathered = df.hint("rebalance", *partition_cols)
    gathered.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
    return path


def sink_sorted(df: DataFrame, path: str, partition_col: str, order: list[str]) -> str:
    """Files by one partition column, sorted inside, so that filters on the order skip row groups."""
    gathered = df.hint("rebalance", partition_col).sortWithinPartitions(partition_col, *order)
    gathered.write.mode("overwrite").partitionBy(partition_col).parquet(path)
    return path


def sink_by_format(df: DataFrame, path: str, fmt: str) -> str:
    if fmt not in REPORT_CODECS:
        raise ValueError(f"unsupported output format: {fmt}")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return path


def report_document(report: DataFrame, **config: Column) -> DataFrame:
    """A one-row report as one nested JSON text."""
    fields = [F.struct(*[F.col(f"`{c}`") for c in report.columns]).alias("summary")]
    fields += [c.alias(name) for name, c in config.items()]
    return report.select(F.to_json(F.struct(*fields)).alias("value"))


def sink_report_json(report: DataFrame, path: str, **config: Column) -> str:
    report_document(report, **config).coalesce(1).write.mode("overwrite").text(path)
    return path
