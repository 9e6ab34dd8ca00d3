"""Daily detection job: four detectors, alert log and watchlist."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from roomlens.functions.text import literal
from roomlens.operators import changes, detect, metrics, outputs
from roomlens.sources import writers
from roomlens.sources.scratch import shared_table
from roomlens.thresholds import DEFAULTS, Thresholds


def detectors(
    grain: DataFrame, days: DataFrame, run_date: str, run_ts: str, limits: Thresholds = DEFAULTS
) -> dict[str, DataFrame]:
    """Results of all detectors from the stored product grain and the daily measures."""
    products = shared_table(metrics.product_metrics(grain), "products")
    # Scored once; the log, the lists and the summaries read the stored alerts.
    zero = shared_table(detect.zero_purchase(products, run_date, limits), "zero-purchase")
    anomalies = shared_table(detect.cvr_anomalies(products, run_date, limits), "cvr-anomalies")
    trend = detect.daily_trend(days, limits)
    drops = detect.daily_drops(trend, run_date, limits)
    rooms = detect.monitor(metrics.roll_up(grain, "room_type"), "room_type", run_date, limits)
    segments = detect.monitor(
        metrics.roll_up(grain, "price_segment"), "price_segment", run_date, limits
    )
    log = shared_table(outputs.alert_log(zero, anomalies, drops, rooms, segments, run_ts), "alert-log")
    return {
        "zero_purchase": zero,
        "cvr_anomalies": anomalies,
        "daily_trend": trend,
        "daily_drops": drops,
        "rooms": rooms,
        "segments": segments,
        "alert_log": log,
        "watchlist": outputs.watchlist(zero, anomalies),
        "alert_summary": outputs.alert_summary(log),
        "detector_summary": detect.detector_summary(products, zero, anomalies, trend, days, limits),
        "severity_counts": detect.severity_counts(zero, anomalies),
        "worst_drop": detect.worst_drop(drops),
        "z_histogram": outputs.histogram(anomalies, "z_score"),
    }


def datasets(
    fact: DataFrame,
    run_date: str,
    run_ts: str,
    limits: Thresholds = DEFAULTS,
    grain: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All detector results from two scans of the fact: product grain and days. ``grain`` is the
    stored product grain, if another job of the day already has it."""
    if grain is None:
        grain = shared_table(metrics.product_grain(fact), "product-grain")
    days = shared_table(metrics.daily_metrics(fact), "days")
    return detectors(grain, days, run_date, run_ts, limits)


def add_days(
    fact: DataFrame, store: str, since: str | None = None, dates: Sequence[date | None] | None = None
) -> DataFrame:
    """Bring the stored measures per product and date up to date; return all of them.

    With ``dates``, those that load batches touched, exactly the events of these are read, late ones
    included; a date whose events are all gone loses its measures. With ``since`` events of that date and
    later, or without a date, are read. Other days keep what an earlier run stored. The first run has none.
    """
    if dates is not None:
        days = metrics.product_days(changes.on_dates(fact, list(dates)))
        if dates:
            writers.replace_partitions(days, store, "event_date", values=dates)
        return fact.sparkSession.read.schema(days.schema).parquet(store)
    new = fact if since is None else fact.where(f"event_date IS NULL OR event_date >= DATE({literal(since)})")
    days = metrics.product_days(new)
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if since else "static").partitionBy(
        "event_date"
    ).parquet(store)
    return fact.sparkSession.read.schema(days.schema).parquet(store)


def run(
    fact: DataFrame, folder: str, run_date: str, run_ts: str, limits: Thresholds = DEFAULTS, since: str | None = None,
    dates: Sequence[date | None] | None = None,
) -> DataFrame:
    """Write the alerts of the run to its partition of the log, and the dated watchlist; return the summary.

    Measures per product and date are kept in the folder, so that a daily run reads only the days from
    ``since`` on, or the ``dates`` that load batches touched. Rolling means are taken over the stored days,
    so a late event also changes the verdicts of the days after it. A rerun of a date replaces its alerts.
    """
    days = add_days(fact, f"{folder.rstrip('/')}/product_days", since, dates)
    frames = detectors(days, metrics.roll_up(days, "event_date"), run_date, run_ts, limits)
    records = outputs.alert_records(frames["alert_log"], run_date)
    writers.replace_json_lines(records, f"{folder.rstrip('/')}/alert_log", run_date)
    writers.write_csv(frames["watchlist"], writers.dated_path(folder, "watchlists", run_date))
    return frames["alert_summary"]
