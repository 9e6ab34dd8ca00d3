"""Every operator as a named query over the driver's tables.

A query derives the retail inputs it needs and applies the operator to them. All thresholds come
from one profile, low enough for the small test scales; the operators default to the real ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from roomlens.functions.numbers import text_to_double
from roomlens.operators import (
    changes,
    clean_events,
    clean_products,
    detect,
    frequent,
    metrics,
    model,
    outputs,
    profiling,
    quantiles,
    report,
    staging,
    statistics,
    views,
)
from roomlens.plans import detection, insights, profile, reporting
from roomlens.plans.visits import Visits
from roomlens.session import configure
from roomlens.sources.scratch import scratch_folder, shared_table
from roomlens.testbed import adapter
from roomlens.thresholds import Thresholds

RUN_DATE = "2024-02-01"
RUN_TS = "2024-02-01 08:00:00"

PROFILE = Thresholds(
    zero_purchase_min_views=15,
    zero_purchase_critical_views=23,
    zero_purchase_high_views=20,
    min_views_for_analysis=15,
    cvr_z_alert=-1.0,
    cvr_z_critical=-1.2,
    cvr_z_high=-1.1,
    gap_view_min_views=15,
    gap_view_highlight=20,
    gap_min_views=15,
    gap_z=-0.6,
    gap_severe_z=-1.0,
)


class Inputs:
    """Lazily derived frames of one call; only what a query touches is built."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    # Events

    @cached_property
    def raw_events(self) -> DataFrame:
        return adapter.raw_events(self.spark, self.sf_dir)

    @cached_property
    def furniture(self) -> DataFrame:
        return staging.furniture_only(self.raw_events)

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stage_events(self.furniture, RUN_TS)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_events.clean_events(self.stg_events)

    @cached_property
    def fact(self) -> DataFrame:
        return model.fact_events(self.clean)

    @cached_property
    def stored_fact(self) -> DataFrame:
        """The fact as the jobs read it; for queries that scan it more than once."""
        return shared_table(self.fact, "fact")

    # Catalogue

    @cached_property
    def raw_products(self) -> DataFrame:
        return adapter.raw_products(self.spark, self.sf_dir)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stage_products(self.raw_products, RUN_TS)

    @cached_property
    def clean_products(self) -> DataFrame:
        return clean_products.clean_products(self.stg_products)

    @cached_property
    def stored_products(self) -> DataFrame:
        return shared_table(self.clean_products, "clean-products")

    @cached_property
    def dim_products(self) -> DataFrame:
        return model.dim_products(self.stored_products)

    # Aggregates

    @cached_property
    def grain(self) -> DataFrame:
        return shared_table(metrics.product_grain(self.fact), "product-grain")

    @cached_property
    def products(self) -> DataFrame:
        return shared_table(metrics.product_metrics(metrics.product_grain(self.fact)), "products")

    @cached_property
    def orders(self) -> DataFrame:
        return shared_table(statistics.paid_orders(self.fact), "paid-orders")

    @cached_property
    def totals(self) -> DataFrame:
        return metrics.measure(self.fact)

    @cached_property
    def cells(self) -> DataFrame:
        return metrics.measure(self.fact, "event_date", "event_hour")

    @cached_property
    def hours(self) -> DataFrame:
        return statistics.hourly_counts(self.cells)

    @cached_property
    def stored_hours(self) -> DataFrame:
        return statistics.hourly_counts(shared_table(self.cells, "hour-cells"))

    @cached_property
    def rooms(self) -> DataFrame:
        return metrics.measure(self.fact, "room_type")

    @cached_property
    def segments(self) -> DataFrame:
        return metrics.measure(self.fact, "price_segment")

    # Views

    @cached_property
    def funnel_view(self) -> DataFrame:
        return views.conversion_funnel(self.fact)

    @cached_property
    def room_view(self) -> DataFrame:
        return views.room_performance(self.fact)

    @cached_property
    def segment_view(self) -> DataFrame:
        return views.price_segment_analysis(self.fact)

    @cached_property
    def brand_view(self) -> DataFrame:
        return views.brand_performance(self.fact, PROFILE.brand_min_views)

    @cached_property
    def daily_view(self) -> DataFrame:
        return views.daily_trend(self.fact)

    @cached_property
    def hourly_view(self) -> DataFrame:
        return views.hourly_behavior(self.fact)

    @cached_property
    def gap_view(self) -> DataFrame:
        return views.high_view_no_purchase(self.fact, PROFILE.gap_view_min_views)

    # Analyses and detectors

    @cached_property
    def scores(self) -> DataFrame:
        return statistics.gap_scores(self.products, PROFILE)

    @cached_property
    def ranked_rooms(self) -> DataFrame:
        return statistics.room_ranking(self.rooms, PROFILE)

    @cached_property
    def zero(self) -> DataFrame:
        return detect.zero_purchase(self.products, RUN_DATE, PROFILE)

    @cached_property
    def anomalies(self) -> DataFrame:
        return detect.cvr_anomalies(self.products, RUN_DATE, PROFILE)

    @cached_property
    def days(self) -> DataFrame:
        return shared_table(metrics.daily_metrics(self.fact), "days")

    @cached_property
    def trend(self) -> DataFrame:
        return detect.daily_trend(self.days, PROFILE)

    @cached_property
    def drops(self) -> DataFrame:
        return detect.daily_drops(self.trend, RUN_DATE, PROFILE)

    @cached_property
    def detectors(self) -> dict[str, DataFrame]:
        return detection.detectors(self.grain, self.days, RUN_DATE, RUN_TS, PROFILE)

    @cached_property
    def visits(self) -> Visits:
        """The bitmap store after two loads: the first half of the days, then the others."""
        dates = changes.touched_dates(self.stored_fact)
        store = Visits(self.spark, f"{scratch_folder(self.spark)}/visits-{uuid.uuid4().hex}")
        half = len(dates) // 2
        return store.add_days(self.stored_fact, dates[:half]).add_days(self.stored_fact, dates[half:])

    @cached_property
    def late_days(self) -> DataFrame:
        """Stored measures per product and date, after a batch of late events of all dates."""
        store = f"{scratch_folder(self.spark)}/product-days-{uuid.uuid4().hex}"
        late = "coalesce(user_id, 0) % 10 = 3"
        detection.add_days(self.stored_fact.where(f"NOT ({late})"), store)
        touched = changes.touched_dates(self.stored_fact.where(late))
        return detection.add_days(self.stored_fact, store, dates=touched)

    @cached_property
    def insights(self) -> dict[str, DataFrame]:
        return insights.datasets(self.stored_fact, PROFILE)


def _table_counts(i: Inputs) -> DataFrame:
    staged = shared_table(i.stg_events, "stg-events")
    clean = clean_events.clean_events(staged)
    return profiling.table_counts(
        {
            "stg_user_events": staged,
            "stg_products": i.stg_products,
            "clean_user_events": clean,
            "clean_products": i.stored_products,
            "dim_products": model.product_attributes(i.stored_products),
            "dim_date": model.dim_date(clean),
            "fact_user_events": model.fact_events(clean),
        }
    )


def _impute(i: Inputs) -> DataFrame:
    rows = clean_products.furniture_products(i.stg_products)
    return clean_products.impute_price(rows).select("asin", "sub_category", "price")


def _product_metrics(i: Inputs) -> DataFrame:
    money = ("revenue", "order_price", "paid_revenue")
    rows = metrics.product_metrics(metrics.product_grain(i.fact))
    return rows.selectExpr(*[f"DOUBLE({c}) AS {c}" if c in money else c for c in rows.columns])


def _kpis(i: Inputs) -> DataFrame:
    return report.kpi_summary(i.fact)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # Sources and staging
    "stg_events": lambda i: i.stg_events.drop("loaded_at"),
    "stg_products": lambda i: i.stg_products.drop("loaded_at"),
    "table_counts": _table_counts,
    "product_preview": lambda i: clean_products.product_preview(i.raw_products),
    "report_row_counts": lambda i: reporting.datasets(i.stored_fact, PROFILE)["report_row_counts"],
    # Profiles
    "profile_shape": lambda i: profiling.shape(i.raw_events),
    "profile_shape_products": lambda i: profiling.shape(i.raw_products),
    "profile_nulls": lambda i: profiling.null_profile(i.raw_events),
    "profile_nulls_products": lambda i: profiling.null_profile(i.raw_products, only_with_nulls=True),
    "profile_key_nulls": lambda i: profiling.null_profile(i.furniture, profile.KEY_COLUMNS),
    "event_type_counts": lambda i: profiling.value_counts(i.raw_events, "event_type"),
    "top_values_category": lambda i: profiling.value_counts(i.raw_events, "category_code", 20),
    "top_values_user": lambda i: frequent.top_values(i.raw_events, "user_id", 10),
    "top_values_product": lambda i: frequent.top_values(i.raw_events, "product_id", 15),
    "furniture_event_types": lambda i: profiling.value_counts(i.furniture, "event_type"),
    "furniture_categories": lambda i: profiling.value_counts(i.furniture, "category_code"),
    "top_values_brand": lambda i: profiling.value_counts(i.furniture, "brand", 10),
    "top_values_product_brand": lambda i: profiling.value_counts(i.raw_products, "brand", 10),
    "top_values_availability": lambda i: profiling.value_counts(i.raw_products, "availability", 8),
    "top_values_material": lambda i: profiling.value_counts(i.raw_products, "material", 10),
    "top_main_categories": lambda i: profiling.value_counts(
        clean_products.product_preview(i.raw_products), "main_category", 10
    ),
    "top_sub_categories": lambda i: profiling.value_counts(
        clean_products.product_preview(i.raw_products), "sub_category", 15
    ),
    "room_counts": lambda i: profiling.value_counts(i.clean, "room_type"),
    "price_segment_counts": lambda i: profiling.value_counts(i.clean, "price_segment"),
    "clean_event_type_counts": lambda i: profiling.value_counts(i.clean, "event_type"),
    "day_type_counts": lambda i: profiling.value_counts(model.dim_date(i.clean), "day_type"),
    "product_sub_category_counts": lambda i: profiling.value_counts(i.clean_products, "sub_category"),
    "product_price_segment_counts": lambda i: profiling.value_counts(i.clean_products, "price_segment"),
    "price_describe": lambda i: quantiles.describe(
        i.furniture.selectExpr(f"{text_to_double('price')} AS price"), "price"
    ),
    "product_price_describe": lambda i: quantiles.describe(
        i.raw_products.selectExpr(f"{clean_products.price_number()} AS price"), "price"
    ),
    "clean_price_describe": lambda i: quantiles.describe(i.clean_products, "price"),
    "unique_brands": lambda i: profiling.distinct_count(i.raw_products, "brand"),
    "date_range": lambda i: profiling.value_range(i.furniture, "event_time"),
    "dim_date_range": lambda i: profiling.value_range(model.dim_date(i.clean), "event_date"),
    "furniture_share": lambda i: profiling.selectivity(
        i.raw_events, "startswith(category_code, 'furniture')"
    ),
    "dq_event_types": lambda i: profiling.event_type_check(i.stg_events),
    "dq_null_brands": lambda i: profiling.missing_brand_check(i.stg_events),
    "dq_zero_price": lambda i: profiling.zero_price_check(i.stg_events),
    "dq_null_prices": lambda i: profiling.missing_price_check(i.stg_products),
    "dq_main_categories": lambda i: profiling.category_text_check(i.stg_products),
    "clean_summary": lambda i: profiling.clean_summary(i.clean),
    "product_filter_counts": lambda i: profiling.selectivity(
        clean_products.with_categories(i.stg_products), "main_category = 'Furniture'"
    ),
    "price_null_counts": lambda i: profiling.price_nulls(
        i.raw_products, clean_products.price_number()
    ),
    # Cleaning
    "furniture_events": lambda i: i.furniture,
    "clean_events": lambda i: i.clean,
    "clean_products": lambda i: i.clean_products,
    "price_imputed": _impute,
    "availability_clean": lambda i: profiling.value_counts(i.clean_products, "availability"),
    "material_counts": lambda i: profiling.value_counts(i.clean_products, "material", 10),
    # Star schema
    "dim_products": lambda i: i.dim_products,
    "in_stock_counts": lambda i: profiling.value_counts(
        model.product_attributes(i.clean_products), "in_stock_flag"
    ),
    "dim_date": lambda i: model.dim_date(i.clean),
    "fact_events": lambda i: i.fact,
    # Views
    "vw_conversion_funnel": lambda i: i.funnel_view,
    "vw_room_performance": lambda i: i.room_view,
    "vw_price_segment_analysis": lambda i: i.segment_view,
    "vw_brand_performance": lambda i: i.brand_view,
    "vw_daily_trend": lambda i: i.daily_view,
    "vw_hourly_behavior": lambda i: i.hourly_view,
    "vw_high_view_no_purchase": lambda i: i.gap_view,
    "q_funnel": lambda i: views.funnel_by_size(i.funnel_view),
    "q_best_rooms": lambda i: views.best_rooms(i.room_view),
    "q_price_segments": lambda i: views.segment_conversion(i.segment_view),
    "q_top_brands": lambda i: views.top_brands(i.brand_view),
    "q_peak_hours": lambda i: views.peak_hours(i.hourly_view),
    "q_gap_top10": lambda i: views.gap_list(i.gap_view),
    # Report
    "kpi_summary": _kpis,
    "visits_conversion_funnel": lambda i: i.visits.conversion_funnel(),
    "visits_daily_trend": lambda i: i.visits.daily_trend(),
    "visits_kpi_summary": lambda i: i.visits.kpi_summary(),
    "kpi_sheet": lambda i: report.kpi_sheet(_kpis(i)),
    "report_funnel": lambda i: report.funnel_stages(i.funnel_view),
    "report_room_top8": lambda i: report.room_rates(i.room_view),
    "report_price_segment": lambda i: report.segment_revenue(i.segment_view),
    "report_hourly": lambda i: report.hourly_purchases(i.hourly_view),
    "report_hourly_peak": lambda i: report.hourly_peak(i.hourly_view),
    "report_daily_revenue": lambda i: report.daily_revenue(i.daily_view),
    "report_gap": lambda i: report.gap_table(
        i.gap_view, PROFILE.gap_view_highlight
    ),
    # Statistics
    "funnel_stats": lambda i: statistics.funnel_stats(i.totals, PROFILE).drop(
        "vs_industry_pct", "chi2_statistic"
    ),
    "funnel_chi2": lambda i: statistics.funnel_stats(i.totals, PROFILE).select(
        "views", "purchases", "chi2_statistic", "vs_industry_pct"
    ),
    "funnel_chi2_p": lambda i: statistics.funnel_p(i.totals, PROFILE),
    "anova_segments": lambda i: statistics.segment_anova(i.orders),
    "anova_segments_p": lambda i: statistics.segment_anova_p(i.orders, PROFILE),
    "segment_descriptive": lambda i: statistics.segment_descriptive(i.orders),
    "segment_cvr": lambda i: statistics.group_cvr(i.segments, "price_segment"),
    "hourly_behavior": lambda i: i.hours,
    "hourly_ci": lambda i: statistics.hourly_interval(i.hours),
    "hourly_peak_trough": lambda i: statistics.hourly_extremes(i.hours),
    "business_hours_share": lambda i: statistics.business_hours(i.hours),
    "kruskal_hours": lambda i: statistics.hourly_rank_summary(statistics.hourly_rank_test(i.cells)),
    "kruskal_hours_p": lambda i: statistics.hourly_rank_p(
        statistics.hourly_rank_test(i.cells), PROFILE
    ),
    "room_ranking": lambda i: i.ranked_rooms,
    "room_wilson_ci": lambda i: statistics.wilson_interval(i.ranked_rooms),
    "room_chi2": lambda i: statistics.room_test(i.ranked_rooms),
    "room_chi2_p": lambda i: statistics.room_test_p(i.ranked_rooms, PROFILE),
    "gap_scores": lambda i: i.scores,
    "gap_anomalies": lambda i: statistics.gap_anomalies(i.scores),
    "gap_summary": lambda i: statistics.gap_summary(i.scores),
    "gap_top10": lambda i: statistics.gap_listing(i.scores),
    "gap_top15": lambda i: statistics.gap_chart(i.scores, limits=PROFILE),
    "insight_kpi_summary": lambda i: statistics.insight_summary(
        statistics.funnel_stats(metrics.roll_up(i.products), PROFILE),
        statistics.hourly_extremes(i.hours),
        statistics.gap_summary(i.scores),
    ),
    "findings": lambda i: i.insights["findings"],
    # Detectors
    "product_metrics": _product_metrics,
    "detect_zero_purchase": lambda i: i.zero,
    "detect_cvr_anomalies": lambda i: i.anomalies,
    "daily_cvr_trend": lambda i: i.trend,
    "detect_daily_drops": lambda i: i.drops,
    "worst_daily_drop": lambda i: detect.worst_drop(i.drops),
    "monitor_rooms": lambda i: detect.monitor(i.rooms, "room_type", RUN_DATE, PROFILE),
    "monitor_segments": lambda i: detect.monitor(i.segments, "price_segment", RUN_DATE, PROFILE),
    "severity_counts": lambda i: detect.severity_counts(i.zero, i.anomalies),
    "zero_purchase_top5": lambda i: detect.top_zero_purchase(i.zero),
    "cvr_anomaly_top5": lambda i: detect.top_cvr_anomalies(i.anomalies),
    "detector_summary": lambda i: detect.detector_summary(
        i.products, i.zero, i.anomalies, i.trend, i.days, PROFILE
    ),
    # Alert outputs and dashboard datasets
    "alert_log": lambda i: i.detectors["alert_log"].drop("timestamp"),
    "alert_records": lambda i: outputs.alert_records(i.detectors["alert_log"], RUN_DATE).drop("timestamp"),
    "late_event_trend": lambda i: detect.daily_trend(metrics.roll_up(i.late_days, "event_date"), PROFILE),
    "watchlist": lambda i: outputs.watchlist(i.zero, i.anomalies),
    "alert_summary": lambda i: i.detectors["alert_summary"],
    "zero_purchase_top10": lambda i: outputs.zero_purchase_chart(i.zero),
    "z_histogram": lambda i: outputs.histogram(i.anomalies, "z_score"),
    "daily_cvr_chart": lambda i: detect.daily_chart(i.trend, PROFILE),
    "funnel_chart": lambda i: outputs.funnel_chart(statistics.funnel_stats(i.totals, PROFILE)),
    "cvr_vs_benchmark": lambda i: outputs.benchmark_chart(statistics.funnel_stats(i.totals, PROFILE)),
    "hourly_with_ci": lambda i: outputs.hourly_chart(
        i.stored_hours, statistics.hourly_interval(i.stored_hours)
    ),
    "segment_cvr_chart": lambda i: outputs.segment_chart(
        statistics.group_cvr(i.segments, "price_segment")
    ),
    "room_ci_error_bars": lambda i: outputs.room_error_bars(
        statistics.wilson_interval(i.ranked_rooms)
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
