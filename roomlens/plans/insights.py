"""Insight job: the five statistical analyses from two stored aggregates and the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roomlens.operators import metrics, outputs, statistics
from roomlens.sources import writers
from roomlens.sources.scratch import shared_table
from roomlens.thresholds import DEFAULTS, Thresholds


def datasets(
    fact: DataFrame, limits: Thresholds = DEFAULTS, grain: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All results. The fact is scanned for the product grain, for the (date, hour) cells and,
    reading purchases only, for the amounts of orders; the rest works on those small tables. ``grain`` is
    the stored product grain, if another job of the day already has it."""
    if grain is None:
        grain = shared_table(metrics.product_grain(fact), "product-grain")
    cells = shared_table(metrics.measure(fact, "event_date", "event_hour"), "hour-cells")
    orders = shared_table(statistics.paid_orders(fact), "paid-orders")

    totals = metrics.roll_up(grain)
    funnel = statistics.funnel_stats(totals, limits)
    funnel_p = statistics.funnel_p(totals, limits)
    anova = statistics.segment_anova(orders)
    anova_p = statistics.segment_anova_p(orders, limits)
    anova_raw = statistics.segment_anova(orders, with_raw=True)
    segments = statistics.group_cvr(metrics.roll_up(grain, "price_segment"), "price_segment")
    hours = statistics.hourly_counts(cells)
    rank_test = statistics.hourly_rank_test(cells)
    rank_p = statistics.hourly_rank_p(rank_test, limits)
    hour_results = statistics.hourly_results(hours, rank_test)
    ranked = statistics.room_ranking(metrics.roll_up(grain, "room_type"), limits)
    rooms = statistics.wilson_interval(ranked)
    room = statistics.room_test(ranked)
    room_p = statistics.room_test_p(ranked, limits)
    products = shared_table(metrics.product_metrics(grain), "products")
    scores = statistics.gap_scores(products, limits)
    gaps = statistics.gap_summary(scores)
    return {
        "funnel_stats": funnel,
        "funnel_p": funnel_p,
        "anova": anova,
        "anova_p": anova_p,
        "segment_descriptive": statistics.segment_descriptive(orders),
        "segment_cvr": segments,
        "hourly_behavior": hours,
        "hourly_results": hour_results.drop("kw_raw", "kw_df"),
        "kruskal_p": rank_p,
        "room_cvr_with_ci": rooms,
        "room_test": room,
        "room_test_p": room_p,
        "anomaly_products": statistics.gap_anomalies(scores),
        "gap_summary": gaps,
        "gap_top10": statistics.gap_listing(scores),
        "gap_top15": statistics.gap_chart(scores, limits=limits),
        "kpi_summary": statistics.insight_summary(
            funnel, statistics.hourly_extremes(hours), gaps
        ),
        "findings": outputs.findings(
            funnel, anova_raw, hour_results, statistics.room_test(ranked, with_raw=True), gaps, limits.benchmark_rate
        ),
        "chart_funnel": outputs.funnel_chart(funnel),
        "chart_benchmark": outputs.benchmark_chart(funnel, limits.benchmark_rate * 100),
        "chart_hourly": outputs.hourly_chart(hours, statistics.hourly_interval(hours)),
        "chart_segments": outputs.segment_chart(segments),
        "chart_rooms": outputs.room_error_bars(rooms),
    }


# The exported datasets.
EXPORTS = ("kpi_summary", "room_cvr_with_ci", "anomaly_products", "segment_cvr", "hourly_behavior")
# Those whose length is fixed by the calendar, the price bands or the layout.
SHORT = {"kpi_summary", "segment_cvr", "hourly_behavior", "findings"}


def run(fact: DataFrame, folder: str, run_date: str, limits: Thresholds = DEFAULTS) -> None:
    """Write the exported datasets and the findings as dated CSV folders."""
    frames = datasets(fact, limits)
    for name in (*EXPORTS, "findings"):
        path = writers.dated_path(folder, name, run_date)
        writers.write_csv(frames[name], path, single_file=name in SHORT)
