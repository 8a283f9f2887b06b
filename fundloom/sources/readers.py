"""Readers for Parquet, CSV, JSON and hive-partitioned returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fundloom.functions.scalars import (
    coerce_month_start, col, nan_to_null, strip_float_suffix, to_numeric_or_null,
)

RETURN_COLUMNS = ["fundno", "Date", "mret"]


def scan_parquet_projected(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the given columns are read; NaN measures become null."""
    raw = spark.read.parquet(path).select(*[col(c) for c in columns])
    measures = [f.name for f in raw.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return raw.withColumns({c: nan_to_null(c) for c in measures})


def scan_hive_returns(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Monthly returns below root/year=/month= with normalised types.

    A date range becomes a filter on the partition columns, so other months are never listed or read.
    """
    raw = spark.read.parquet(root)
    at = F.col("year") * 12 + F.col("month") if {"year", "month"} <= set(raw.columns) else None
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None and at is not None:
            raw = raw.where(keep(at, F.lit(int(bound[:4]) * 12 + int(bound[5:7]))))
    have = {f.name: f.dataType for f in raw.schema}
    shown = []
    for c in RETURN_COLUMNS:
        if c not in have:
            continue
        if c == "fundno":
            shown.append(strip_float_suffix(c).alias(c))
        elif c == "Date":
            is_date = isinstance(have[c], (T.DateType, T.TimestampType, T.TimestampNTZType))
            shown.append((F.trunc(c, "MM") if is_date else coerce_month_start(c)).alias(c))
        else:
            shown.append(to_numeric_or_null(c).alias(c))
    return raw.select(*shown)


def scan_csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV under a declared schema; identifiers and dates stay text."""
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_by_extension(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet, CSV or JSON by suffix; without a schema CSV types are inferred.

    JSON is one record a line, or one array a file, however it is laid out: the first line that is not blank
    tells which.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if suffix == "parquet":
        return reader.parquet(path)
    if suffix == "csv":
        return reader.option("header", True).option("inferSchema", schema is None).csv(path)
    if suffix == "json":
        head = spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''").first()
        return reader.option("multiLine", head is not None and head["value"].startswith("[")).json(path)
    raise ValueError(f"unsupported file format: .{suffix}")
