"""Stored bitmaps of users and sessions: a day adds its own; views and KPIs read no event."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roomlens.operators import changes, metrics, report, views, visits
from roomlens.sources import writers
from roomlens.sources.scratch import shared_table


@dataclass(frozen=True)
class Visits:
    """Three tables below a folder: numbers of users and sessions, bitmaps and measures by date."""

    spark: SparkSession
    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def numbers(self) -> DataFrame:
        """All numbers given so far; none before the first day."""
        if not writers.exists(self.spark, self.path("numbers")):
            return self.spark.createDataFrame([], visits.NUMBERS)
        return self.spark.read.schema(visits.NUMBERS).parquet(self.path("numbers"))

    def bitmaps(self) -> DataFrame:
        return self.spark.read.schema(visits.BITMAPS).parquet(self.path("bitmaps"))

    def measures(self) -> DataFrame:
        return self.spark.read.schema(visits.MEASURED).parquet(self.path("measures"))

    def add_days(self, fact: DataFrame, dates: Sequence[date | None] | None = None) -> Visits:
        """Bring the tables up to date: all days, or those of ``dates`` from their events alone.

        Numbers are added before bitmaps that use them. A run that dies between the steps leaves numbers
        without bits, which count nothing; run again, it finds them and goes on, and gives each date's
        partition the same bits.
        """
        new = fact if dates is None else changes.on_dates(fact, list(dates))
        seen = shared_table(visits.seen(new), "visits-seen")
        fresh = shared_table(visits.new_numbers(seen, self.numbers()), "visits-numbers")
        fresh.write.mode("append").parquet(self.path("numbers"))
        maps = visits.bitmaps(seen, self.numbers())
        for frame, table in ((maps, "bitmaps"), (visits.day_measures(new), "measures")):
            if dates is None:
                writers.replace_partitioned(frame, self.path(table), "event_date")
            else:
                writers.replace_partitions(frame, self.path(table), "event_date", values=list(dates))
        return self

    def conversion_funnel(self) -> DataFrame:
        per_type = metrics.roll_up(self.measures(), "event_type")
        return views.funnel_shares(
            visits.with_counts(per_type, self.bitmaps(), "event_type").selectExpr(
                "event_type", "events AS event_count", "users AS unique_users", "sessions AS unique_sessions"
            )
        )

    def daily_trend(self) -> DataFrame:
        per_day = metrics.roll_up(self.measures(), "event_date")
        return views.daily_rows(
            visits.with_counts(per_day, self.bitmaps(), "event_date").withColumnsRenamed({"users": "active_users"})
        )

    def kpi_summary(self) -> DataFrame:
        users = visits.distinct_counts(self.bitmaps()).select("users").scalar()
        return report.kpi_summary(self.measures(), stored=True, users=users)
