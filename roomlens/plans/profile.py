"""Exploration job: what the raw files, the staging tables and the clean tables hold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from roomlens.functions.numbers import text_to_double
from roomlens.operators import clean_products, frequent, profiling, quantiles, staging
from roomlens.sources import writers

KEY_COLUMNS = ("user_id", "product_id", "category_code", "price", "brand")


def write(frames: Mapping[str, DataFrame], folder: str, run_date: str) -> None:
    """Write every profile whole, as a dated CSV folder of its own."""
    for name, frame in frames.items():
        writers.write_csv(frame, writers.dated_path(folder, name, run_date))


def raw_events(raw: DataFrame) -> dict[str, DataFrame]:
    """Profile of the clickstream and of its furniture part.

    Pass a columnar copy of a large export (``shared_table``): every profile reads only its own
    columns, which a text file cannot offer.
    """
    furniture = staging.furniture_only(raw)
    return {
        "shape": profiling.shape(raw),
        "nulls": profiling.null_profile(raw),
        "event_types": profiling.value_counts(raw, "event_type"),
        "top_categories": profiling.value_counts(raw, "category_code", 20),
        "furniture_share": profiling.selectivity(raw, "startswith(category_code, 'furniture')"),
        "furniture_categories": profiling.value_counts(furniture, "category_code"),
        "furniture_event_types": profiling.value_counts(furniture, "event_type"),
        "furniture_prices": quantiles.describe(
            furniture.selectExpr(f"{text_to_double('STRING(price)')} AS price"), "price"
        ),
        "furniture_brands": frequent.top_values(furniture, "brand", 10),
        "furniture_dates": profiling.value_range(furniture, "event_time"),
        "furniture_key_nulls": profiling.null_profile(furniture, KEY_COLUMNS),
    }


def raw_products(raw: DataFrame) -> dict[str, DataFrame]:
    """Profile of the catalogue, its prices and its parsed categories."""
    preview = clean_products.product_preview(raw)
    return {
        "shape": profiling.shape(raw),
        "nulls": profiling.null_profile(raw, only_with_nulls=True),
        "price_nulls": profiling.price_nulls(raw, clean_products.price_number()),
        "prices": quantiles.describe(preview, "price_clean"),
        "main_categories": profiling.value_counts(preview, "main_category", 10),
        "sub_categories": profiling.value_counts(preview, "sub_category", 15),
        "brand_count": profiling.distinct_count(raw, "brand"),
        "brands": profiling.value_counts(raw, "brand", 10),
        "availability": profiling.value_counts(raw, "availability", 8),
        "materials": profiling.value_counts(raw, "material", 10),
    }


def staging_checks(events: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """Data-quality checks of the two staging tables."""
    return {
        "event_types": profiling.event_type_check(events),
        "null_brands": profiling.missing_brand_check(events),
        "zero_prices": profiling.zero_price_check(events),
        "null_prices": profiling.missing_price_check(products),
        "main_categories": profiling.category_text_check(products),
    }


def clean_tables(
    events: DataFrame, staged_products: DataFrame, products: DataFrame
) -> dict[str, DataFrame]:
    """Distributions after cleaning, and what the catalogue filter kept."""
    return {
        "summary": profiling.clean_summary(events),
        "event_types": profiling.value_counts(events, "event_type"),
        "rooms": profiling.value_counts(events, "room_type"),
        "price_segments": profiling.value_counts(events, "price_segment"),
        "products_kept": profiling.selectivity(
            clean_products.with_categories(staged_products), "main_category = 'Furniture'"
        ),
        "sub_categories": profiling.value_counts(products, "sub_category"),
        "product_price_segments": profiling.value_counts(products, "price_segment"),
        "availability": profiling.value_counts(products, "availability"),
        "materials": profiling.value_counts(products, "material", 10),
        "product_prices": quantiles.describe(products, "price"),
    }
