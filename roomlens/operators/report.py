"""KPIs and the datasets of the management report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from roomlens.functions.numbers import half_even, money, ratio_pct
from roomlens.operators.metrics import aggregates, stage_count
from roomlens.operators.profiling import table_counts

# Stage order of the funnel chart.
STAGE_ORDER = ("view", "cart", "purchase")

# Report table and the view it shows.
REPORT_TABLES = {
    "Funnel Data": "vw_conversion_funnel",
    "Room Performance": "vw_room_performance",
    "Price Segments": "vw_price_segment_analysis",
    "Brand Performance": "vw_brand_performance",
    "Hourly Behavior": "vw_hourly_behavior",
}


def kpi_summary(fact: DataFrame, stored: bool = False, users: Column | None = None) -> DataFrame:
    """One row of totals and rates, from the fact or its ``stored`` session grain. A stage that never
    occurs is null, its rate 0. With ``users``, their number, the stored grain need not tell them apart."""

    def stage(name: str, column: str) -> str:
        return f"nullif({f'sum({column})' if stored else stage_count(name)}, 0)"

    sums = {
        "revenue_sum": f"sum({money('revenue')})",
        "total_events": "sum(events)" if stored else "count(*)",
        "total_purchases": stage("purchase", "purchases"),
        "total_views": stage("view", "views"),
        "total_cart_adds": stage("cart", "cart_adds"),
        "ordered": f"sum(if(event_type = 'purchase', {money('revenue')}, NULL))",
    }
    if users is None:
        sums["unique_users"] = "count(DISTINCT user_id)"
    totals = fact.agg(*aggregates(sums))
    totals = totals if users is None else totals.withColumn("unique_users", users)
    conversion = ratio_pct("total_purchases", "total_views")
    abandoned = ratio_pct("total_cart_adds - total_purchases", "total_cart_adds")
    return totals.selectExpr(
        "DOUBLE(revenue_sum) AS total_revenue",
        "total_events", "total_purchases", "total_views", "total_cart_adds", "unique_users",
        "try_divide(DOUBLE(ordered), DOUBLE(total_purchases)) AS avg_order_value",
        f"coalesce({half_even(conversion, 2)}, 0D) AS conversion_rate",
        f"coalesce({half_even(abandoned, 2)}, 0D) AS cart_abandonment_rate",
    )


def kpi_sheet(kpis: DataFrame) -> DataFrame:
    """The eight formatted lines of the KPI sheet."""
    # Names and formats of the lines.
    return metric_rows(
        kpis,
        {
            "Total Revenue": "concat('$', format_number(total_revenue, 0))",
            "Total Views": "format_number(total_views, 0)",
            "Total Purchases": "format_number(total_purchases, 0)",
            "Total Cart Adds": "format_number(total_cart_adds, 0)",
            "Unique Users": "format_number(unique_users, 0)",
            "Conversion Rate": "concat(conversion_rate, '%')",
            "Cart Abandonment Rate": "concat(cart_abandonment_rate, '%')",
            "Avg Order Value": "concat('$', format_number(avg_order_value, 2))",
        },
    )


def metric_rows(one_row: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Turn one row into (line, metric, value) rows."""
    entries = ", ".join(
        f"{line}, '{metric}', {value}" for line, (metric, value) in enumerate(values.items(), 1)
    )
    return one_row.selectExpr(f"stack({len(values)}, {entries}) AS (line, metric, value)")


def funnel_stages(funnel: DataFrame) -> DataFrame:
    """Funnel rows in stage order with display labels; other event types come last."""
    order = ", ".join(f"'{stage}'" for stage in STAGE_ORDER)
    return (
        funnel.selectExpr("*", f"nullif(array_position(array({order}), event_type), 0) AS place")
        .orderBy(F.asc_nulls_last("place"), "event_type")
        .selectExpr("concat(upper(left(event_type, 1)), lower(substr(event_type, 2))) AS stage", "event_count")
    )


def room_rates(rooms: DataFrame, top: int = 8) -> DataFrame:
    """Plain mean of the item rates of each known room, best first."""
    rate = "CAST(conversion_rate_pct AS decimal(18,2))"
    mean = f"try_divide(DOUBLE(sum({rate})), DOUBLE(count(conversion_rate_pct)))"
    return (
        rooms.where("room_type IS NOT NULL")
        .groupBy("room_type")
        .agg(F.expr(f"{mean} AS conversion_rate_pct"))
        .orderBy(F.desc("conversion_rate_pct"), "room_type")
        .limit(top)
    )


def segment_revenue(segments: DataFrame) -> DataFrame:
    return segments.select("price_segment", "total_revenue", "conversion_rate_pct")


def hourly_purchases(hours: DataFrame) -> DataFrame:
    return hours.select("event_hour", "day_type", "purchases").orderBy("event_hour", "day_type")


def hourly_peak(hours: DataFrame) -> DataFrame:
    """The (hour, day type) row with most purchases, the earliest on ties."""
    return (
        hours.select("event_hour", "day_type", "purchases")
        .orderBy(F.desc("purchases"), "event_hour", "day_type")
        .limit(1)
    )


def daily_revenue(days: DataFrame) -> DataFrame:
    return days.select("event_date", "daily_revenue").orderBy("event_date")


def gap_table(gaps: DataFrame, highlight_views: int = 1000) -> DataFrame:
    """Gap view with a mark on products viewed more than ``highlight_views`` times."""
    return gaps.selectExpr("*", f"views > {highlight_views} AS highlight")


def heading(name: str) -> str:
    return name.replace("_", " ").title()


def with_headings(df: DataFrame) -> DataFrame:
    """Column names as printed in the report tables."""
    return df.toDF(*[heading(name) for name in df.columns])


def report_tables(views: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {title: with_headings(views[view]) for title, view in REPORT_TABLES.items()}


def report_row_counts(views: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each dataset read for the report."""
    return table_counts(views)
