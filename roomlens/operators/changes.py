"""Load batches that change stored events: which dates they touch, and rebuilding these alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F


def touched_dates(*frames: DataFrame | None) -> list[date | None]:
    """Event dates of the given rows, ``None`` for rows without a date. Days are few, however many the rows."""
    found: set[date | None] = set()
    for frame in frames:
        if frame is not None:
            found |= {row[0] for row in frame.select("event_date").distinct().collect()}
    return sorted(found, key=lambda d: (d is not None, d))


def on_dates(events: DataFrame, dates: list[date | None]) -> DataFrame:
    """Rows of these dates; of a table partitioned by event_date, no other partition is read."""
    known = [d for d in dates if d is not None]
    wanted = F.col("event_date").isin(*known) if known else F.lit(False)
    return events.where(wanted | F.col("event_date").isNull() if None in dates else wanted)


def changed(events: DataFrame, inserted: DataFrame | None, deleted: DataFrame | None) -> DataFrame:
    """``events`` without the deleted rows and with the inserted ones.

    A deleted row takes away one equal row; a row that moved or was mended is deleted in its old form
    and inserted in its new one. Deleting a row that is not there is no error.
    """
    rows = events if deleted is None else events.exceptAll(deleted.select(*events.columns))
    return rows if inserted is None else rows.unionByName(inserted.select(*events.columns))
