"""Written intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folder: list[str] = []
_scopes: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """Where this application's tables go: below the cluster's checkpoint folder.

    Only on a local master that has none, a temporary folder is made; it goes with the process.
    """
    base = spark.conf.get(_SETTING, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="roomlens-"))
            atexit.register(shutil.rmtree, _local_folder[0], ignore_errors=True)
        base = _local_folder[0]
    return f"{base.rstrip('/')}/roomlens/{spark.sparkContext.applicationId}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when the block ends; wrap a job whose results are written out."""
    _scopes.append(f"scope-{uuid.uuid4().hex}")
    folder = "/".join([scratch_folder(spark), *_scopes])
    try:
        yield
    finally:
        _scopes.pop()
        _delete(spark, folder)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; else they stay until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def shared_table(df: DataFrame, label: str, outer: bool = False) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a grouped result feeds several later steps that need different columns of it: an
    in-plan reuse would not hold after column pruning, so the event scan would run again for each.
    The written table also survives the loss of executors. Writing starts at once, so an operator
    that stores something works when it is called, not only when its result is read. An ``outer``
    table outlives the innermost scope that is open.
    """
    spark = df.sparkSession
    scopes = _scopes[:-1] if outer else _scopes
    path = "/".join([scratch_folder(spark), *scopes, f"{label}-{uuid.uuid4().hex}"])
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed_table(df: DataFrame, label: str, column: str) -> Iterator[DataFrame]:
    """Write ``df`` once in buckets of ``column``: a join on it deals out its other side only.

    Spark knows buckets by the name of a table, which stands in the session's catalog until the block
    ends; what is read from it must be written by then. The files stay with the other shared tables.
    """
    spark = df.sparkSession
    name = f"{label}-{uuid.uuid4().hex}"
    path = "/".join([scratch_folder(spark), *_scopes, name])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = name.replace("-", "_")
    with _shuffles_removed(spark):
        df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE `{table}`")


def drop_shared_tables(spark: SparkSession) -> None:
    """Delete all tables this application wrote outside a scope that is still open."""
    _delete(spark, scratch_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
