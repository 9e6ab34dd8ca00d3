"""Additive event measures: the one aggregation every report is built from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roomlens.functions.numbers import MONEY, money

# Grain at which brand, room and price band are still group keys. Everything the detectors and
# the insight run need per product, room, band or in total can be rolled up from it, so the
# event table is scanned once. Text maxima are taken on the rolled-up rows: over events they
# would force a sort-based aggregation.
PRODUCT_GRAIN = ("product_id", "brand", "room_type", "price_segment")

# Grain of the report views that need no distinct counts: one scan serves all of them.
REPORT_GRAIN = (
    "event_hour", "day_type", "room_type", "item_type", "brand", "price_segment", "is_zero_price",
)


# Grain at which users and sessions can still be told apart: one stored table serves all exact
# distinct counts of the report.
SESSION_GRAIN = ("event_date", "event_type", "user_id", "user_session")


def stage_count(stage: str) -> str:
    return f"count(if(event_type = '{stage}', 1, NULL))"


def amount(column: str, kept: str) -> str:
    """Decimal sum over the kept rows; 0 when there is none."""
    return f"coalesce(sum(if({kept}, {money(column)}, NULL)), CAST(0 AS {MONEY}))"


_PAID = "event_type = 'purchase' AND revenue > 0"

STAGES = {
    "views": stage_count("view"),
    "cart_adds": stage_count("cart"),
    "purchases": stage_count("purchase"),
}

MEASURES = {
    **STAGES,
    "events": "count(*)",
    "revenue": amount("revenue", "revenue <> 0"),
    "order_price": amount("price", "event_type = 'purchase'"),
    "paid_revenue": amount("revenue", _PAID),
    "paid_orders": f"count(if({_PAID}, 1, NULL))",
}


def aggregates(named: dict[str, str]) -> list[Column]:
    return [F.expr(f"{sql} AS {name}") for name, sql in named.items()]


def measure(fact: DataFrame, *keys: str) -> DataFrame:
    """Stage counts and money sums per group; unused measures are pruned by the optimizer."""
    return fact.groupBy(*keys).agg(*aggregates(MEASURES))


def roll_up(grain: DataFrame, *keys: str) -> DataFrame:
    """Measures of a coarser grouping from those of a finer one."""
    return grain.groupBy(*keys).agg(*aggregates({name: f"sum({name})" for name in MEASURES}))


def report_grain(fact: DataFrame) -> DataFrame:
    return measure(fact, *REPORT_GRAIN)


def session_grain(fact: DataFrame) -> DataFrame:
    return measure(fact, *SESSION_GRAIN)


def product_days(fact: DataFrame) -> DataFrame:
    """The product grain per event date: additive, so a new day is added without the days before."""
    return fact.groupBy("event_date", *PRODUCT_GRAIN).agg(*aggregates({**MEASURES, "price": "max(price)"}))


def product_grain(fact: DataFrame) -> DataFrame:
    """Measures per product, brand, room and price band, with the highest price."""
    return fact.groupBy(*PRODUCT_GRAIN).agg(*aggregates({**MEASURES, "price": "max(price)"}))


def product_metrics(grain: DataFrame) -> DataFrame:
    """Measures per product with its highest price, brand, room and price band."""
    highest = {name: f"max({name})" for name in ("price", "brand", "room_type", "price_segment")}
    sums = {name: f"sum({name})" for name in MEASURES}
    return grain.groupBy("product_id").agg(*aggregates({**sums, **highest}))


def daily_metrics(fact: DataFrame) -> DataFrame:
    """Measures per event date; events without a date are one group of their own."""
    return measure(fact, "event_date")
