"""Newly landed quarters as a stream of files merged into the returns database.

The incremental update is a file stream: each micro-batch holds the filings that landed since the last one.
The database is kept by year, and a batch writes only the years it has months in, to a folder of its own. A small
version file then names the folder of every year: it appears under its number by one rename, so that readers see the
table before or after a merge, and a merge that fails leaves the last version as it is. The merge is idempotent,
latest filing per key, so a repeated batch leaves the same table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fundloom.functions.scalars import quarter_key
from fundloom.operators.dedup import dedup_latest_by_registrant, incremental_upsert
from fundloom.session import materialize

RETURNS_SCHEMA = (
    "cik string, class_id string, series_id string, month_end date, `return` double, "
    "filing_date date, report_period date, accession bigint"
)
COLUMNS = [c.split()[0].strip("`") for c in RETURNS_SCHEMA.split(", ")]


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the published versions, ascending."""
    files, where = _files(spark, f"{root}/versions")
    names = [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []
    return sorted(int(n) for n in names if n.isdigit())


def _folders(spark: SparkSession, root: str, version: int | None) -> dict[int, str]:
    """The folder of each year in a version; there are as many as calendar years."""
    if version is None:
        return {}
    rows = spark.read.text(f"{root}/versions/{version:08d}").collect()
    return {int(year): folder for year, folder in (r["value"].split(" ", 1) for r in rows)}


def _publish(spark: SparkSession, root: str, version: int, folders: dict[int, str]) -> None:
    """The version file is written under another name and renamed: it is there as a whole or not at all."""
    files, draft = _files(spark, f"{root}/versions/draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write("".join(f"{y} {f}\n" for y, f in sorted(folders.items())).encode())
    out.close()
    _, final = _files(spark, f"{root}/versions/{version:08d}")
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"version {version} of {root} was published by another writer")


def read_returns_database(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version (the last, if none is named); what is merged later does not change the frame."""
    found = versions(spark, root)
    folders = _folders(spark, root, version if version is not None else found[-1] if found else None)
    if not folders:
        return spark.createDataFrame([], f"{RETURNS_SCHEMA}, year int")
    reader = spark.read.schema(f"{RETURNS_SCHEMA}, batch string, year int").option("basePath", f"{root}/data")
    return reader.parquet(*[f"{root}/data/{f}/year={y}" for y, f in sorted(folders.items())]).drop("batch")


def merge_batch(spark: SparkSession, root: str, new: DataFrame) -> None:
    """Merge filings into the years they belong to; other years are neither read nor written."""
    batch = materialize(dedup_latest_by_registrant(new.select(*COLUMNS)).withColumn("year", F.year("month_end")))
    years = [row["year"] for row in batch.select("year").distinct().collect()]  # calendar years
    if not years:
        return
    last = max(versions(spark, root), default=None)
    stored = read_returns_database(spark, root, last).where(F.col("year").isin(years))
    folder = f"batch={uuid.uuid4().hex}"
    (
        incremental_upsert(stored, batch)
        .hint("rebalance", "year")  # as many writers for a year as its size asks for
        .write.partitionBy("year")
        .parquet(f"{root}/data/{folder}")
    )
    folders = _folders(spark, root, last) | dict.fromkeys(years, folder)
    _publish(spark, root, (last or 0) + 1, folders)


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the last `keep` versions and the data that only they name."""
    found = versions(spark, root)
    kept = {(y, f) for v in found[-keep:] for y, f in _folders(spark, root, v).items()}
    old = {(y, f) for v in found[:-keep] for y, f in _folders(spark, root, v).items()}
    for v in found[:-keep]:  # first the names, then what they name
        files, where = _files(spark, f"{root}/versions/{v:08d}")
        files.delete(where, False)
    for y, f in sorted(old - kept):
        files, where = _files(spark, f"{root}/data/{f}/year={y}")
        files.delete(where, True)


def stream_quarters(
    spark: SparkSession, landing: str, root: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Process everything that has landed, then stop."""
    landed = (
        spark.readStream.schema(RETURNS_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(landing)
    )
    return (
        landed.writeStream.foreachBatch(lambda df, _: merge_batch(spark, root, df))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def processed_quarters(db: DataFrame) -> DataFrame:
    return db.select(quarter_key("report_period").alias("quarter")).distinct()
