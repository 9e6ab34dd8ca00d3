"""Surrogate keys that stay: a registry of the products seen so far."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.text import literal
from roomlens.operators.model import dense_key
from roomlens.sources.scratch import shared_table

REGISTRY = "product_key BIGINT, asin STRING, copy BIGINT, first_seen DATE, closed DATE"


@dataclass(frozen=True)
class Keyed:
    """Rows with their keys, and the registry after them. Both are stored."""

    rows: DataFrame
    registry: DataFrame


def copies(rows: DataFrame) -> DataFrame:
    """``rows`` with position, a dense number in order of asin, and copy, which numbers rows of one asin.

    Rows of one asin may lie in several parts of the sort; only their least position is gathered.
    """
    placed = shared_table(dense_key(rows, "position", "asin"), "key-positions")
    firsts = placed.groupBy("asin").agg(F.min("position").alias("first")).withColumnRenamed("asin", "_asin")
    joined = placed.join(firsts, F.col("asin").eqNullSafe(F.col("_asin")))
    return joined.withColumn("copy", F.expr("position - first + 1")).drop("first", "_asin")


def assign_keys(rows: DataFrame, registry: DataFrame, run_date: str) -> Keyed:
    """Give every row of the stored catalogue ``rows`` its product_key.

    Products of the registry keep their keys; new ones are numbered from the greatest key on, in order of
    asin, by the sizes of sorted parts. A product that is gone keeps its line, closed with the run date;
    one that comes back is open again under its old key. A registry without lines gives the keys 1 to n.
    """
    numbered = shared_table(copies(rows), "key-copies")
    known = registry.withColumnsRenamed({"asin": "_asin", "copy": "_copy"})
    same = F.col("asin").eqNullSafe(F.col("_asin")) & (F.col("copy") == F.col("_copy"))
    joined = numbered.join(known, same, "left")
    fresh = shared_table(joined.where("product_key IS NULL").select("position", "asin", "copy"), "key-fresh")
    start = registry.agg(F.expr("coalesce(max(product_key), 0L)")).scalar()
    given = dense_key(fresh, "rank", "position").select("position", (F.col("rank") + start).alias("new_key"))
    keyed = shared_table(
        joined.join(given, "position", "left").selectExpr(
            "coalesce(product_key, new_key) AS product_key", *rows.columns, "copy", "first_seen"
        ),
        "key-rows",
    )
    day = f"DATE({literal(run_date)})"
    opened = keyed.selectExpr("product_key", "asin", "copy", f"coalesce(first_seen, {day}) AS first_seen", "CAST(NULL AS DATE) AS closed")
    gone = registry.join(keyed.select("product_key"), "product_key", "left_anti").selectExpr(
        "product_key", "asin", "copy", "first_seen", f"coalesce(closed, {day}) AS closed"
    )
    return Keyed(keyed.select("product_key", *rows.columns), shared_table(opened.union(gone), "key-registry"))
