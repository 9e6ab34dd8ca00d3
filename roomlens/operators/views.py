"""The seven analytical views over the event fact, and the insight queries on top of them.

Views of plain counts and sums also take stored measures of a finer grain, with
``measured=roll_up``, instead of the fact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.numbers import money, rate_pct
from roomlens.operators.clean_events import calendar
from roomlens.operators.metrics import MEASURES, STAGES, aggregates, measure, roll_up

Measured = Callable[..., DataFrame]

REVENUE = "DOUBLE(round(revenue, 2))"
CONVERSION = f"{rate_pct('purchases', 'views')} AS conversion_rate_pct"

DATE_ATTRIBUTES = (
    "event_date", "year", "month", "month_name", "week_number", "day_of_week", "day_type",
)
GAP_KEYS = ("product_id", "brand", "room_type", "item_type", "price_segment")


def conversion_funnel(fact: DataFrame, stored: bool = False) -> DataFrame:
    """Events, users and sessions per event type, with the share of all events.

    ``stored``: what is given is the session grain of the fact.
    """
    counts = fact.groupBy("event_type").agg(
        F.expr(f"{'sum(events)' if stored else 'count(*)'} AS event_count"),
        F.expr("count(DISTINCT user_id) AS unique_users"),
        F.expr("count(DISTINCT user_session) AS unique_sessions"),
    )
    return funnel_shares(counts)


def funnel_shares(counts: DataFrame) -> DataFrame:
    """Counts per event type with the share of all events. The window sees a handful of rows."""
    share = rate_pct("event_count", "sum(event_count) OVER ()")
    return counts.selectExpr("*", f"{share} AS pct_of_total")


def room_performance(fact: DataFrame, measured: Measured = measure) -> DataFrame:
    keys = ("room_type", "item_type")
    return (
        measured(fact, *keys)
        .selectExpr(*keys, *STAGES, f"{REVENUE} AS total_revenue", CONVERSION)
        .orderBy(F.desc("total_revenue"), *keys)
    )


def price_segment_analysis(fact: DataFrame, measured: Measured = measure) -> DataFrame:
    return (
        measured(fact.where("is_zero_price = 0"), "price_segment")
        .selectExpr(
            "price_segment", *STAGES, f"{REVENUE} AS total_revenue", CONVERSION,
            "DOUBLE(round(try_divide(order_price, purchases), 2)) AS avg_purchase_price",
        )
        .orderBy(F.desc("conversion_rate_pct"), "price_segment")
    )


def brand_performance(
    fact: DataFrame, min_views: int = 100, measured: Measured = measure
) -> DataFrame:
    """Known brands with more than ``min_views`` views, zero prices left out."""
    return (
        measured(fact.where("brand <> 'Unknown' AND is_zero_price = 0"), "brand")
        .where(f"views > {min_views}")
        .selectExpr("brand", *STAGES, f"{REVENUE} AS total_revenue", CONVERSION)
        .orderBy(F.desc("total_revenue"), "brand")
    )


def daily_trend(fact: DataFrame, stored: bool = False) -> DataFrame:
    """Stage counts, revenue, users and sessions per date, from the fact or its ``stored`` session
    grain.

    The calendar attributes follow from the date; they are added to the daily rows rather than
    carried through the shuffle of users and sessions.
    """
    sums = {name: f"sum({name})" if stored else MEASURES[name] for name in (*STAGES, "revenue")}
    counts = {
        **sums,
        "active_users": "count(DISTINCT user_id)",
        "sessions": "count(DISTINCT user_session)",
    }
    return daily_rows(fact.groupBy("event_date").agg(*aggregates(counts)))


def daily_rows(days: DataFrame) -> DataFrame:
    """The daily view from one row of sums and counts per date."""
    return (
        days.selectExpr("*", *calendar("event_date"))
        .selectExpr(
            *DATE_ATTRIBUTES, *STAGES, f"{REVENUE} AS daily_revenue", "active_users", "sessions"
        )
        .orderBy("event_date")
    )


def hourly_behavior(fact: DataFrame, measured: Measured = measure) -> DataFrame:
    keys = ("event_hour", "day_type")
    return (
        measured(fact, *keys).selectExpr(*keys, *STAGES, f"{REVENUE} AS revenue").orderBy(*keys)
    )


_GAP_SUMS = {**STAGES, "price_sum": f"sum({money('price')})", "priced": "count(price)"}


def gap_sums(fact: DataFrame, *keys: str) -> DataFrame:
    """What the gap view needs of a group; sums, so that stored ones can be added up."""
    return fact.groupBy(*keys).agg(*aggregates(_GAP_SUMS))


def high_view_no_purchase(fact: DataFrame, min_views: int = 500, top: int = 30, stored: bool = False) -> DataFrame:
    """The ``top`` most viewed products with more than ``min_views`` views and no purchase, from the
    fact or from its ``stored`` gap sums."""
    sums = {name: f"sum({name})" for name in _GAP_SUMS} if stored else _GAP_SUMS
    return (
        fact.groupBy(*GAP_KEYS)
        .agg(*aggregates(sums))
        .where(f"views > {min_views} AND purchases = 0")
        .selectExpr(
            *GAP_KEYS, *STAGES, "DOUBLE(round(try_divide(price_sum, priced), 2)) AS avg_price"
        )
        .orderBy(F.desc("views"), *GAP_KEYS)
        .limit(top)
    )


def all_views(
    fact: DataFrame, brand_views: int = 100, gap_views: int = 500, grain: DataFrame | None = None,
    sessions: DataFrame | None = None, gaps: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All views by name. ``grain``, stored report measures, spares four scans of the fact, and
    ``sessions``, its stored session grain, two more; ``gaps``, its stored gap sums, the last."""
    source, measured = (fact, measure) if grain is None else (grain, roll_up)
    stored = sessions is not None
    visits = sessions if stored else fact
    return {
        "vw_conversion_funnel": conversion_funnel(visits, stored),
        "vw_room_performance": room_performance(source, measured),
        "vw_price_segment_analysis": price_segment_analysis(source, measured),
        "vw_brand_performance": brand_performance(source, brand_views, measured),
        "vw_daily_trend": daily_trend(visits, stored),
        "vw_hourly_behavior": hourly_behavior(source, measured),
        "vw_high_view_no_purchase": high_view_no_purchase(fact if gaps is None else gaps, gap_views, stored=gaps is not None),
    }


# Insight queries: each takes the view it reads.


def funnel_by_size(funnel: DataFrame) -> DataFrame:
    return funnel.orderBy(F.desc("event_count"), "event_type")


def _regrouped(view: DataFrame, key: str, revenue: str) -> DataFrame:
    """Views, purchases and revenue over a coarser key; revenue is already rounded once."""
    return view.groupBy(key).agg(
        F.expr("sum(views) AS views"),
        F.expr("sum(purchases) AS purchases"),
        F.expr(f"DOUBLE(round(sum({money(revenue)}), 2)) AS revenue"),
    )


def best_rooms(rooms: DataFrame) -> DataFrame:
    return (
        _regrouped(rooms, "room_type", "total_revenue")
        .selectExpr(
            "room_type", "views", "purchases", f"{rate_pct('purchases', 'views')} AS cvr_pct",
            "revenue",
        )
        .orderBy(F.desc("cvr_pct"), "room_type")
    )


def segment_conversion(segments: DataFrame) -> DataFrame:
    return segments.select(
        "price_segment", "views", "purchases", "conversion_rate_pct", "total_revenue"
    ).orderBy(F.desc("conversion_rate_pct"), "price_segment")


def top_brands(brands: DataFrame, top: int = 10) -> DataFrame:
    return (
        brands.select("brand", "views", "purchases", "total_revenue", "conversion_rate_pct")
        .orderBy(F.desc("total_revenue"), "brand")
        .limit(top)
    )


def peak_hours(hours: DataFrame, top: int = 8) -> DataFrame:
    return (
        _regrouped(hours, "event_hour", "revenue")
        .orderBy(F.desc("purchases"), "event_hour")
        .limit(top)
    )


def gap_list(gaps: DataFrame, top: int = 10) -> DataFrame:
    """First rows of the gap view, sorted again: a view has no order of its own."""
    return gaps.select(*GAP_KEYS, *STAGES).orderBy(F.desc("views"), *GAP_KEYS).limit(top)
