"""Exact distinct users and sessions from bitmaps that can be merged over days and event types.

Values get dense numbers once; a day's distinct values are bitmaps over these numbers, in buckets of 32,768.
Counting over any days or types is merging bitmaps bucket by bucket and counting bits, without the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.operators.metrics import aggregates, measure
from roomlens.operators.model import dense_key
from roomlens.sources.scratch import shared_table

# What is counted, and the column that tells it apart.
KINDS = {"users": "user_id", "sessions": "user_session"}
GRAIN = ("event_date", "event_type")
NUMBERS = "kind STRING, value STRING, number BIGINT"
BITMAPS = "kind STRING, event_type STRING, bucket BIGINT, bits BINARY, event_date DATE"

MEASURED = (
    "event_type STRING, views BIGINT, cart_adds BIGINT, purchases BIGINT, events BIGINT, revenue DECIMAL(38,6), "
    "order_price DECIMAL(38,6), paid_revenue DECIMAL(38,6), paid_orders BIGINT, event_date DATE"
)


def seen(fact: DataFrame) -> DataFrame:
    """(event_date, event_type, kind, value) of the users and sessions of each day and type, once each."""
    entries = ", ".join(f"'{kind}', STRING({column})" for kind, column in KINDS.items())
    rows = fact.selectExpr(*GRAIN, f"stack({len(KINDS)}, {entries}) AS (kind, value)")
    return rows.where("value IS NOT NULL").distinct()


def new_numbers(seen_values: DataFrame, known: DataFrame) -> DataFrame:
    """Numbers of the values that have none yet, from the greatest known one on. No number is ever moved."""
    values = seen_values.select("kind", "value").distinct()
    fresh = shared_table(values.join(known.select("kind", "value"), ["kind", "value"], "left_anti"), "new-values")
    start = known.agg(F.expr("coalesce(max(number), 0L)")).scalar()
    return dense_key(fresh, "position", "value").select("kind", "value", (F.col("position") + start).alias("number"))


def bitmaps(seen_values: DataFrame, numbers: DataFrame) -> DataFrame:
    """One bitmap for each day, type, kind and bucket of numbers that occurs. Built in the tasks first."""
    numbered = seen_values.join(numbers, ["kind", "value"])
    return numbered.groupBy("kind", "event_type", F.expr("bitmap_bucket_number(number) AS bucket"), "event_date").agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(number)) AS bits")
    ).select("kind", "event_type", "bucket", "bits", "event_date")


def distinct_counts(maps: DataFrame, *keys: str) -> DataFrame:
    """(keys, users, sessions): distinct values of each group, over all other grouping of the bitmaps."""
    merged = maps.groupBy(*keys, "kind", "bucket").agg(F.expr("bitmap_or_agg(bits) AS bits"))
    counts = {kind: f"coalesce(sum(if(kind = '{kind}', bitmap_count(bits), 0L)), 0L)" for kind in KINDS}
    return merged.groupBy(*keys).agg(*aggregates(counts))


def with_counts(measures: DataFrame, maps: DataFrame, key: str) -> DataFrame:
    """Measures of each value of ``key``, the null one included, with its distinct users and sessions."""
    counts = distinct_counts(maps, key).withColumnRenamed(key, "_key")
    joined = measures.join(counts, measures[key].eqNullSafe(F.col("_key")), "left")
    return joined.drop("_key").withColumns({kind: F.expr(f"coalesce({kind}, 0L)") for kind in KINDS})


def day_measures(fact: DataFrame) -> DataFrame:
    """Counts and sums of each day and event type, the partner of the bitmaps."""
    return measure(fact, *GRAIN)
