"""Session settings the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results; call once on any session.

    Event times are UTC throughout, so hours and dates must be taken in UTC.
    Runtime re-planning is what splits hot join and rebalance partitions.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cpus: int = 8, app: str = "roomlens", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
