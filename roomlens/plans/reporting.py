"""Report job: views, KPIs and report datasets of one fact table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from roomlens.operators import metrics, report, views
from roomlens.plans.cells import Cells, partition_digests
from roomlens.plans.visits import Visits
from roomlens.sources import writers
from roomlens.sources.scratch import shared_table
from roomlens.thresholds import DEFAULTS, Thresholds


def datasets(
    fact: DataFrame, limits: Thresholds = DEFAULTS, visits: Visits | None = None, cells: Cells | None = None
) -> dict[str, DataFrame]:
    """Everything the report shows, from three scans of the fact: one stored aggregate for the views
    of counts and sums, one for those that tell users and sessions apart, and the product list.

    With ``visits``, a store that is up to date, the second scan is not made: funnel, daily view and
    KPIs come from its bitmaps. With ``cells`` that are up to date, neither are the others."""
    grain = cells.grain(fact, "report") if cells else shared_table(metrics.report_grain(fact), "report-grain")
    gaps = cells.grain(fact, "gaps") if cells else None
    sessions = None if visits else shared_table(metrics.session_grain(fact), "session-grain")
    frames = views.all_views(fact, limits.brand_min_views, limits.gap_view_min_views, grain, sessions, gaps)
    if visits:
        frames |= {"vw_conversion_funnel": visits.conversion_funnel(), "vw_daily_trend": visits.daily_trend()}
    writers.register_views(frames)
    kpis = visits.kpi_summary() if visits else report.kpi_summary(sessions, stored=True)
    return {
        **frames,
        "kpi_summary": kpis,
        "kpi_sheet": report.kpi_sheet(kpis),
        "report_funnel": report.funnel_stages(frames["vw_conversion_funnel"]),
        "report_room_top8": report.room_rates(frames["vw_room_performance"]),
        "report_price_segment": report.segment_revenue(frames["vw_price_segment_analysis"]),
        "report_hourly": report.hourly_purchases(frames["vw_hourly_behavior"]),
        "report_hourly_peak": report.hourly_peak(frames["vw_hourly_behavior"]),
        "report_daily_revenue": report.daily_revenue(frames["vw_daily_trend"]),
        "report_gap": report.gap_table(
            frames["vw_high_view_no_purchase"], limits.gap_view_highlight
        ),
        "report_row_counts": report.report_row_counts(frames),
    }


def insight_queries(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "q_funnel": views.funnel_by_size(frames["vw_conversion_funnel"]),
        "q_best_rooms": views.best_rooms(frames["vw_room_performance"]),
        "q_price_segments": views.segment_conversion(frames["vw_price_segment_analysis"]),
        "q_top_brands": views.top_brands(frames["vw_brand_performance"]),
        "q_peak_hours": views.peak_hours(frames["vw_hourly_behavior"]),
        "q_gap_top10": views.gap_list(frames["vw_high_view_no_purchase"]),
    }


# Tables whose length is fixed by the calendar, the funnel, the price bands or a limit.
SHORT_TABLES = {"KPI Summary", "Funnel Data", "Price Segments", "Hourly Behavior", "Gap Analysis"}


def run(
    fact: DataFrame, folder: str, run_date: str, limits: Thresholds = DEFAULTS, dates: Sequence[date | None] | None = None
) -> None:
    """Write the KPI sheet, the report tables and the insight queries as CSV folders.

    Aggregates of counts and sums, and bitmaps of users and sessions, are kept in the folder by date. A run
    builds those of ``dates``, or if not told of the dates whose files changed since the last run, from
    their events alone; a run after no change reads no event. A run that dies builds them again.
    """
    cells = Cells(fact.sparkSession, f"{folder.rstrip('/')}/cells")
    digests = partition_digests(fact)
    outdated = cells.outdated(digests)
    if dates is not None and outdated is not None:
        outdated = sorted({*outdated, *dates}, key=lambda d: (d is not None, d))
    cells.build(fact, outdated)
    store = Visits(fact.sparkSession, f"{folder.rstrip('/')}/visits")
    if outdated is None or outdated:
        store.add_days(fact, outdated)
    cells.record(digests)
    frames = datasets(fact, limits, store, cells)
    for name, frame in insight_queries(frames).items():
        writers.write_csv(frame, writers.dated_path(folder, name, run_date))
    sheets = {"KPI Summary": frames["kpi_sheet"].select("metric", "value")}
    sheets.update(report.report_tables(frames))
    sheets["Gap Analysis"] = report.with_headings(frames["report_gap"])
    for title, sheet in sheets.items():
        path = writers.dated_path(folder, title.lower().replace(" ", "_"), run_date)
        writers.write_csv(sheet, path, single_file=title in SHORT_TABLES)
