"""Profiles and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.numbers import ratio_pct
from roomlens.functions.text import literal, name
from roomlens.operators.metrics import aggregates


def _count_where(predicate: str) -> str:
    return f"count(if({predicate}, 1, NULL))"


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and column names."""
    return df.agg(F.expr("count(*) AS row_count")).selectExpr(
        "row_count",
        f"{len(df.columns)} AS column_count",
        f"{literal(', '.join(df.columns))} AS column_names",
    )


def null_profile(
    df: DataFrame, columns: Sequence[str] | None = None, only_with_nulls: bool = False
) -> DataFrame:
    """Nulls and null share of each column, from one scan."""
    names = list(columns or df.columns)
    nulls = {name(column): _count_where(f"{name(column)} IS NULL") for column in names}
    counts = df.agg(*aggregates({"total": "count(*)", **nulls}))
    profile = counts.unpivot("total", [name(column) for column in names], "column_name", "null_count").selectExpr(
        "column_name", "null_count", f"{ratio_pct('null_count', 'total')} AS null_pct"
    )
    return profile.where("null_count > 0") if only_with_nulls else profile


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = (
        df.selectExpr(f"{name(column)} AS value")
        .where("value IS NOT NULL")
        .groupBy("value")
        .agg(F.expr("count(*) AS row_count"))
        .orderBy(F.desc("row_count"), "value")
    )
    return counts if top is None else counts.limit(top)


def distinct_count(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """Distinct non-null values; ``approx`` uses a sketch."""
    column = name(column)
    count = f"approx_count_distinct({column})" if approx else f"count(DISTINCT {column})"
    return df.agg(F.expr(f"{count} AS distinct_count"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    column = name(column)
    return df.agg(*aggregates({"range_from": f"min({column})", "range_to": f"max({column})"}))


def selectivity(df: DataFrame, predicate: str) -> DataFrame:
    """Rows before and after a filter, and the share kept, in one pass."""
    counts = {"total_rows": "count(*)", "kept_rows": _count_where(predicate)}
    return df.agg(*aggregates(counts)).selectExpr(
        "*", f"{ratio_pct('kept_rows', 'total_rows')} AS kept_pct"
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named table."""
    parts = [
        frame.agg(F.expr("count(*) AS row_count")).selectExpr(f"{literal(title)} AS table_name", "row_count")
        for title, frame in tables.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def event_type_check(stage: DataFrame) -> DataFrame:
    """Rows per event type, a missing type counted as its own group."""
    return stage.groupBy("event_type").agg(F.expr("count(*) AS cnt"))


def missing_brand_check(stage: DataFrame) -> DataFrame:
    missing = "brand IS NULL OR brand = ''"
    return stage.agg(F.expr(f"{_count_where(missing)} AS null_brands"))


def zero_price_check(stage: DataFrame) -> DataFrame:
    """Prices that are zero as DECIMAL(10,2); text that is no number reads as zero."""
    zero = "price IS NOT NULL AND coalesce(try_cast(price AS decimal(10,2)), 0) = 0"
    return stage.agg(F.expr(f"{_count_where(zero)} AS zero_price_events"))


def missing_price_check(stage: DataFrame) -> DataFrame:
    missing = "price IS NULL OR price = 'nan'"
    return stage.agg(F.expr(f"{_count_where(missing)} AS null_prices"))


def rejected_lines(rejects: DataFrame) -> DataFrame:
    """Lines of the event files that are no records, per file and reason."""
    return rejects.groupBy("file", "reason").agg(F.expr("count(*) AS cnt")).orderBy("file", "reason")


def category_text_check(stage: DataFrame, top: int = 8) -> DataFrame:
    """Second comma item of the raw category text, most frequent first (quotes kept)."""
    item = "trim(substring_index(substring_index(translate(categories, '[]', ''), ',', 2), ',', -1))"
    return (
        stage.selectExpr(f"{item} AS main_cat")
        .groupBy("main_cat")
        .agg(F.expr("count(*) AS cnt"))
        .orderBy(F.desc("cnt"), "main_cat")
        .limit(top)
    )


def clean_summary(clean: DataFrame) -> DataFrame:
    """Zero-price rows and rows whose time did not parse."""
    return clean.agg(
        *aggregates(
            {
                "total_rows": "count(*)",
                "zero_price_rows": _count_where("is_zero_price = 1"),
                "null_event_time_rows": _count_where("event_time IS NULL"),
            }
        )
    )


def price_nulls(products: DataFrame, cleaned_price: str) -> DataFrame:
    """Missing prices before and after the text is cleaned."""
    return products.selectExpr("price", f"{cleaned_price} AS cleaned").agg(
        *aggregates(
            {
                "raw_nulls": _count_where("price IS NULL"),
                "clean_nulls": _count_where("cleaned IS NULL"),
            }
        )
    )
