"""Shared-storage locations and the few file operations the sinks need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, as in tests, may fall back to a temporary folder of this machine, which goes with the process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_fallback().name


@cache
def _local_fallback() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="wattline-", ignore_cleanup_errors=True)


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_dir(spark)}/wattline/{name}-{uuid.uuid4().hex}"


def cut(frame: DataFrame) -> DataFrame:
    """The frame checkpointed in the shared folder, so that an iteration's lineage does not grow."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(frame.sparkSession))
    return frame.checkpoint()


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a job's shuffle files go when the job ends, not when the driver next collects its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def row_group_options(size: int) -> dict[str, str]:
    """Parquet writer options for row groups of about so many bytes, their size checked often enough to hold."""
    return {
        "parquet.block.size": str(size),
        "parquet.page.size": str(max(1024, min(1 << 20, size // 8))),
        "parquet.page.size.row.check.min": "100",
        "parquet.block.size.row.check.min": "100",
        "parquet.block.size.row.check.max": "10000",
    }


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder."""
    fs, where = _hadoop(spark, path)
    return fs.getContentSummary(where).getLength()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if there is no such folder."""
    fs, where = _hadoop(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(where)) if fs.exists(where) else []


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fs, where = _hadoop(spark, path)
    _, temporary = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(temporary, where):
        raise OSError(f"{path} is already there or cannot be written")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where
