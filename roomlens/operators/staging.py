"""Raw extracts to staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.text import literal
from roomlens.schemas import STG_EVENTS, STG_PRODUCTS, conform


def furniture_only(events: DataFrame, prefix: str = "furniture") -> DataFrame:
    """Events whose category starts with ``prefix``; a missing category is left out."""
    return events.where(F.startswith("category_code", F.lit(prefix)))


def stage_events(raw: DataFrame, run_ts: str) -> DataFrame:
    """The nine staged columns, time and price kept as text, stamped with the run time."""
    staged = raw.selectExpr(
        "event_time", "event_type",
        "try_cast(product_id AS BIGINT) AS product_id",
        "try_cast(category_id AS BIGINT) AS category_id",
        "category_code", "brand", "price",
        "try_cast(user_id AS BIGINT) AS user_id",
        "user_session",
        f"TIMESTAMP({literal(run_ts)}) AS loaded_at",
    )
    return conform(staged, STG_EVENTS)


def stage_products(raw: DataFrame, run_ts: str) -> DataFrame:
    """The thirteen staged catalogue columns, stamped with the run time."""
    return conform(raw.selectExpr("*", f"TIMESTAMP({literal(run_ts)}) AS loaded_at"), STG_PRODUCTS)
