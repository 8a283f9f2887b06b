"""Session settings and the shared folder used to cut lineage and stage files."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

STAGING = "fundloom-staging"
_staged: set[str] = set()
_scopes: list[list[str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches, with a shared folder of its own if none is set; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fundloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    session = builder.getOrCreate()
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.stop()
        session = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fundloom-")).getOrCreate()
    return session


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it lasts until `remove_staged` or the end of the program."""
    own = f"{shared_root(spark)}/{STAGING}/{spark.sparkContext.applicationId}"
    if not _staged:
        atexit.register(remove_staged)
    _staged.add(own)
    return f"{own}/{uuid.uuid4().hex}/{name}"


def remove_staged() -> None:
    """Delete what this program's sessions have staged; frames that read it are of no use afterwards."""
    jvm = SparkContext._jvm
    while _staged:
        own = _staged.pop()
        if jvm is not None:
            where = jvm.org.apache.hadoop.fs.Path(own)
            where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized inside are deleted at the end, but for lasting ones."""
    _scopes.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _scopes.pop():
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, lasting: bool = False) -> DataFrame:
    """Cut the lineage with a table in the shared folder.

    Operators that read their input several times start from it: the input is computed once, every pass
    sees the same rows also after an executor is lost, and each pass reads only the columns it needs.
    """
    path = staging_path(df.sparkSession, "table")
    if _scopes and not lasting:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the staged table that a frame reads, once nothing needs it any more; other files are left alone."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if f"/{STAGING}/" in folder:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
