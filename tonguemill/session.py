"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts are wide: keep one Arrow batch at a few MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # A second attempt at a translator task repeats paid calls.
    "spark.speculation": "false",
}


def build_session(app_name: str = "tonguemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tonguemill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_area: ContextVar[str | None] = ContextVar("scratch area", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    area = _area.get() or f"{scratch_root(spark)}/tonguemill"
    return f"{area}/{uuid.uuid4().hex}/{name}"


COMMITTED = "_COMMITTED"


def commit_folder(spark: SparkSession, path: str) -> None:
    """Mark a folder as written whole; sessions may be set to write no mark of their own."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITTED}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, True).close()


def committed_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a glob that `commit_folder` marked, in order of name."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/{COMMITTED}")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(mark.getPath().getParent().toString() for mark in found or [])


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(folder) if system.exists(folder) else []
    return [entry.getPath().getName() for entry in found if entry.isDirectory()]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """What the files in a folder take."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_area(spark: SparkSession) -> Iterator[str]:
    """Tables materialized inside are deleted at the end, when their results have been stored elsewhere."""
    area = f"{scratch_root(spark)}/tonguemill/{uuid.uuid4().hex}"
    token = _area.set(area)
    try:
        yield area
    finally:
        _area.reset(token)
        remove(spark, area)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst the true size on disk, so a
    later join is broadcast only when that size is under the session's threshold.
    """
    return materialize_at(df, scratch_path(df.sparkSession, name))


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """As `materialize`, in a folder of the caller's."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
