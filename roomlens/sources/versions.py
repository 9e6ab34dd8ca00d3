"""Folders in numbered versions: written aside, published by one marker, read whole or not at all."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

KEPT_VERSIONS = 2
_VERSION, _MARKER = re.compile(r"v(\d{8})"), re.compile(r"_published-(\d{8})")


def _names(spark: SparkSession, root: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []


def _numbers(pattern: re.Pattern, names: list[str]) -> list[int]:
    return sorted(int(m[1]) for name in names if (m := pattern.fullmatch(name)))


def folder(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v{number:08d}"


def current(spark: SparkSession, root: str) -> int | None:
    """Greatest published version, or none. Readers ask once and stay with what they got."""
    published = _numbers(_MARKER, _names(spark, root))
    return published[-1] if published else None


def begin(spark: SparkSession, root: str) -> int:
    """Number of a version to write: past all that were published or begun."""
    names = _names(spark, root)
    return max([0, *_numbers(_VERSION, names), *_numbers(_MARKER, names)]) + 1


def publish(spark: SparkSession, root: str, number: int, keep: int = KEPT_VERSIONS) -> None:
    """Make a written version the current one, by creating one empty file; drop old versions.

    Making a file is atomic on every file system, unlike replacing one. The ``keep`` versions before
    stay for those who read them. What a build that died left behind goes with the old versions.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(hadoop.Path(base, f"_published-{number:08d}"), False).close()
    names = _names(spark, root)
    published = _numbers(_MARKER, names)
    oldest = published[-keep - 1 :][0]
    for old in _numbers(_MARKER, names):
        if old < oldest:
            files.delete(hadoop.Path(base, f"_published-{old:08d}"), False)
    for old in _numbers(_VERSION, names):
        if old < oldest or (old < number and old not in published):
            files.delete(hadoop.Path(base, f"v{old:08d}"), True)
