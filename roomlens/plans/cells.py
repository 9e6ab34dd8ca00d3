"""Stored report aggregates by grain and date: a run builds the cells that changed and reads the rest."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roomlens.operators import changes, metrics, views
from roomlens.sources import writers

# Grain by name: its measures per date. All are sums, so any days and any fewer keys can be rolled up from them.
GRAINS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "report": lambda events: metrics.measure(events, "event_date", *metrics.REPORT_GRAIN),
    "gaps": lambda events: views.gap_sums(events, "event_date", *views.GAP_KEYS),
}
# Which grain a view is rolled up from; the other views come from the bitmaps of users and sessions.
VIEW_GRAINS = {
    "vw_room_performance": "report", "vw_price_segment_analysis": "report", "vw_brand_performance": "report",
    "vw_hourly_behavior": "report", "vw_high_view_no_purchase": "gaps",
}
_RECORD = "event_date date, digest string"
_PARTITION = re.compile(r"/event_date=([^/]+)/")


def partition_digests(fact: DataFrame) -> dict[date | None, str] | None:
    """Per date, a digest of the names of its files; None if the fact is no table partitioned by date.

    Files are never changed in place, so a partition with the same names holds the same rows. Only names
    are listed, as planning any scan does; no file is opened.
    """
    names: dict[date | None, list[str]] = defaultdict(list)
    for file in fact.inputFiles():
        found = _PARTITION.search(file)
        if not found:
            return None
        day = None if found[1] == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(found[1])
        names[day].append(file)
    return {day: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for day, files in names.items()}


@dataclass(frozen=True)
class Cells:
    """The stored grains below a folder, and a record of the files that each date was built from."""

    spark: SparkSession
    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def grain(self, fact: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(GRAINS[name](fact).schema).parquet(self.path(name))

    def recorded(self) -> dict[date | None, str]:
        if not writers.exists(self.spark, self.path("record")):
            return {}
        return {r.event_date: r.digest for r in self.spark.read.schema(_RECORD).parquet(self.path("record")).collect()}

    def outdated(self, digests: dict[date | None, str] | None) -> list[date | None] | None:
        """Dates whose files changed since they were recorded, gone ones included; None for all dates."""
        known = self.recorded()
        if digests is None or not known:
            return None
        return sorted(
            (d for d in {*digests, *known} if digests.get(d) != known.get(d)), key=lambda d: (d is not None, d)
        )

    def build(self, fact: DataFrame, dates: Sequence[date | None] | None) -> Cells:
        """Build the cells of ``dates`` from their events alone, or of all dates."""
        if dates is None:
            for name, measured in GRAINS.items():
                writers.replace_partitioned(measured(fact), self.path(name), "event_date")
        elif dates:
            new = changes.on_dates(fact, list(dates))
            for name, measured in GRAINS.items():
                writers.replace_partitions(measured(new), self.path(name), "event_date", values=list(dates))
        return self

    def record(self, digests: dict[date | None, str] | None) -> None:
        """Say what the cells were built from; the last step of a run, as what is not recorded is built again."""
        rows = list((digests or {}).items())
        writers.replace_table(self.spark.createDataFrame(rows, _RECORD).coalesce(1), self.path("record"))
