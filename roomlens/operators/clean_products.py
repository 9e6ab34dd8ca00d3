"""Cleaning and enrichment of the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.numbers import text_to_double
from roomlens.functions.segments import CATALOGUE_BANDS, price_band
from roomlens.functions.literals import category_entries
from roomlens.functions.text import literal, strip, title_case
from roomlens.operators.quantiles import frequencies, quantiles
from roomlens.schemas import CLEAN_PRODUCTS, conform
from roomlens.sources.scratch import shared_table

# Phrases and labels. The first matching phrase decides, so a temporary stock-out counts as out of stock.
AVAILABILITY_LABEL = """
    CASE WHEN availability IS NULL THEN 'Unknown'
         WHEN contains(lower(availability), 'in stock') THEN 'In Stock'
         WHEN contains(lower(availability), 'out of stock')
           OR contains(lower(availability), 'unavailable') THEN 'Out of Stock'
         WHEN contains(lower(availability), 'temporarily') THEN 'Temporarily Unavailable'
         WHEN contains(lower(availability), '1-2 days')
           OR contains(lower(availability), 'ship') THEN 'Ships Soon'
         ELSE 'Other' END"""


# Date formats of catalogues, tried in this order; the first that fits decides.
DATE_FORMATS = (
    "yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy/M/d", "yyyyMMdd",
)


def date_text(text: str) -> str:
    """Date written in ``text`` in one of the known formats; null when it is none."""
    trimmed = strip(text)
    tries = ", ".join(f"try_to_date({trimmed}, '{form}')" for form in DATE_FORMATS)
    return f"coalesce({tries}, try_to_date({trimmed}))"


def price_number(price: str = "price") -> str:
    """Price text without ``$`` and thousands commas, as a number; null when it is none."""
    return text_to_double(strip(f"translate({price}, '$,', '')"))


def with_categories(products: DataFrame) -> DataFrame:
    """Second and third entry of the category list as main and sub category."""
    return products.withColumn("_entry", category_entries("categories")).selectExpr(
        "* EXCEPT (_entry)", "_entry.main AS main_category", "_entry.sub AS sub_category"
    )


def impute_price(products: DataFrame, price: str = "price") -> DataFrame:
    """Replace a null price by the exact median of its sub category.

    Without a sub category the median over all rows is used; a sub category without any price
    keeps the null. Both medians come from one stored frequency table. The lookup join is left to
    the runtime, which broadcasts the medians when they are few and splits hot sub categories
    otherwise.
    """
    prices = shared_table(frequencies(products, price, ["sub_category"]), "price-frequencies")
    medians = quantiles(prices, {"_median": 0.5}, ["sub_category"], stored=True)
    overall = quantiles(prices, {"_overall": 0.5}).agg(F.first("_overall")).scalar()
    return (
        products.join(medians, "sub_category", "left")
        .withColumn("_overall", overall)
        .selectExpr(
            *[name for name in products.columns if name != price],
            f"coalesce({price}, if(sub_category IS NULL, _overall, _median)) AS {price}",
        )
    )


def furniture_products(products: DataFrame, main: str = "Furniture") -> DataFrame:
    """Catalogue rows of one main category with categories parsed and the price a number."""
    parsed = with_categories(products).where(f"main_category = {literal(main)}")
    return parsed.withColumn("price", F.expr(price_number()))


def clean_products(products: DataFrame, null_text: str = "None") -> DataFrame:
    """Clean staged products into the 14-column table.

    A missing brand or material becomes the text ``null_text``, as in the tables this replaces.
    """
    brand = strip(f"replace(coalesce(brand, {literal(null_text)}), ' Store', '')")
    material = title_case(strip(f"coalesce(material, {literal(null_text)})"))
    cleaned = impute_price(furniture_products(products)).selectExpr(
        "asin", "title",
        f"{brand} AS brand",
        "price",
        f"{price_band('price', CATALOGUE_BANDS)} AS price_segment",
        "main_category", "sub_category",
        f"{AVAILABILITY_LABEL} AS availability",
        f"coalesce(nullif({material}, 'Nan'), 'Unknown') AS material",
        "color", "style", "country_of_origin",
        f"{date_text('date_first_available')} AS date_first_available",
        "manufacturer",
    )
    return conform(cleaned, CLEAN_PRODUCTS)


def product_preview(products: DataFrame) -> DataFrame:
    """Exploration extract: cleaned price and parsed categories next to the raw fields.

    Here a list of one entry gives that entry as main category.
    """
    return products.withColumn("_entry", category_entries("categories")).selectExpr(
        "asin", "title", "brand",
        f"{price_number()} AS price_clean",
        "_entry.shown_main AS main_category",
        "_entry.shown_sub AS sub_category",
        "availability", "material", "color", "style", "country_of_origin", "date_first_available",
    )
