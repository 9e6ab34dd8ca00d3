"""The most frequent values of a column of very many: a mergeable summary proposes, exact counts decide."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.text import name
from roomlens.operators import profiling
from roomlens.operators.metrics import aggregates
from roomlens.sources.scratch import shared_table

TRACKED = 4096  # values a summary keeps
# A summary's table is the next power of two that holds its values three quarters full; its counts of N
# rows are off by 3.5 N / size at most, and it names every value of more than twice that. The published
# bound leaves room for the sampling of 1,024 counters by which a full table is thinned out.
_ERROR = 3.5


def _table_size(tracked: int) -> int:
    return 1 << (-(-tracked * 4 // 3) - 1).bit_length()


def summary(values: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row: total rows and the values that may be frequent. A task gives out ``tracked`` values at most."""
    return values.agg(*aggregates({"total": "count(*)", "items": f"approx_top_k(value, {tracked}, {tracked})"}))


def top_values(df: DataFrame, column: str, top: int, tracked: int = TRACKED) -> DataFrame:
    """The rows of ``profiling.value_counts(df, column, top)`` without a shuffle of all values.

    The first pass merges summaries of ``tracked`` values; the second counts these values exactly. Where
    the last of ``top`` values is more frequent than any value that the summary may have missed, the
    result holds by that bound; otherwise, as for values all about as rare, all values are counted. Both passes
    read one column. Null values do not count; no rows give no rows.
    """
    values = df.selectExpr(f"{name(column)} AS value").where("value IS NOT NULL")
    seen = shared_table(summary(values, tracked), "frequent-summary")
    proposed = seen.selectExpr("explode(items.item) AS value")  # at most ``tracked`` rows
    counts = shared_table(
        values.join(F.broadcast(proposed), "value", "left_semi").groupBy("value").agg(F.expr("count(*) AS row_count"))
        .orderBy(F.desc("row_count"), "value").limit(top),
        "frequent-counts",
    )
    missed = seen.selectExpr(f"{2 * _ERROR / _table_size(tracked)}D * total AS most").scalar()
    found, proven = counts.agg(F.count("*"), F.min("row_count") > missed).first()
    if found == top and proven:
        return counts.orderBy(F.desc("row_count"), "value")
    return profiling.value_counts(df, column, top)
