"""Table, CSV and JSON-lines outputs, and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomlens.sources.scratch import shared_table


def replace_table(df: DataFrame, path: str) -> None:
    """Write a table anew; a rerun leaves the same content."""
    df.write.mode("overwrite").parquet(path)


def replace_partitioned(df: DataFrame, path: str, partition: str) -> None:
    """Write a table partitioned by ``partition``.

    The rebalance hint gathers each partition value into few files and, unlike a repartition by
    the column, lets the runtime split a value that holds a large share of the rows.
    """
    df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a folder of CSV parts with headers; ``single_file`` only for frames of fixed size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def dated_path(folder: str, name: str, run_date: str) -> str:
    return f"{folder.rstrip('/')}/{name}/run_date={run_date}"


def append_json_lines(df: DataFrame, path: str) -> None:
    """Append one JSON object per row; null fields are left out. A rerun appends again."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(path)


def replace_json_lines(df: DataFrame, path: str, run_date: str) -> None:
    """The rows of one run as JSON objects, null fields left out, in that run's partition of a log.

    The partition is exchanged when the job commits, so a rerun replaces what an earlier run of the date
    left, a job that dies leaves it as it was, and other dates are never touched.
    """
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"), F.lit(run_date).alias("run_date"))
    replace_partitions(lines, path, "run_date", "text", [run_date])


def replace_partitions(
    df: DataFrame, path: str, partition: str, kind: str = "parquet", values: Sequence[object] = (), stored: bool = False
) -> None:
    """Exchange the partitions that ``df`` has rows for; those of ``values`` without rows go.

    Nothing else of the table is read or written. ``None`` among the values is the null partition.
    Rows are written aside first, unless ``stored`` tells that they are, as they are read twice and may
    come from the partitions they replace.
    """
    rows = df if stored else shared_table(df, "partitions")
    rows.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).format(kind).save(path)
    left = {row[0] for row in rows.select(F.col(partition).cast("string")).distinct().collect()}
    for value in values:
        if (None if value is None else str(value)) not in left:
            name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            delete(df.sparkSession, f"{path.rstrip('/')}/{partition}={name}")


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
