"""Declared schema of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def _schema(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


RAW_EVENTS = _schema(
    event_time="string", event_type="string", product_id="string", category_id="string",
    category_code="string", brand="string", price="string", user_id="string",
    user_session="string",
)

RAW_PRODUCTS = _schema(
    asin="string", title="string", brand="string", price="string", availability="string",
    categories="string", material="string", color="string", style="string",
    country_of_origin="string", date_first_available="string", package_dimensions="string",
    manufacturer="string",
)

STG_EVENTS = _schema(
    event_time="string", event_type="string", product_id="long", category_id="long",
    category_code="string", brand="string", price="string", user_id="long",
    user_session="string", loaded_at="timestamp",
)

STG_PRODUCTS = StructType(RAW_PRODUCTS.fields + [StructField("loaded_at", TimestampType())])

CLEAN_EVENTS = _schema(
    event_time="timestamp", event_date="date", event_type="string", product_id="long",
    category_id="long", category_code="string", furniture_type="string", room_type="string",
    item_type="string", brand="string", price="double", price_segment="string",
    is_zero_price="int", user_id="long", user_session="string", event_hour="int",
    day_of_week="string", day_type="string", week_number="int", month="int",
    month_name="string", year="int",
)

CLEAN_PRODUCTS = _schema(
    asin="string", title="string", brand="string", price="double", price_segment="string",
    main_category="string", sub_category="string", availability="string", material="string",
    color="string", style="string", country_of_origin="string", date_first_available="date",
    manufacturer="string",
)

DIM_PRODUCTS = _schema(
    product_key="long", asin="string", title="string", brand="string", price="double",
    price_segment="string", main_category="string", sub_category="string",
    availability="string", in_stock_flag="int", material="string", color="string",
    style="string", country_of_origin="string", date_first_available="date",
    manufacturer="string",
)

DIM_DATE = _schema(
    event_date="date", year="int", month="int", month_name="string", week_number="int",
    day_of_week="string", day_type="string", quarter="int", quarter_name="string",
    is_month_start="int", is_month_end="int",
)

FACT_EVENTS = _schema(
    user_id="long", user_session="string", product_id="long", event_type="string",
    event_time="timestamp", event_date="date", event_hour="int", category_code="string",
    room_type="string", item_type="string", brand="string", price="double",
    price_segment="string", revenue="double", is_view="int", is_cart="int",
    is_purchase="int", is_zero_price="int", year="int", month="int", month_name="string",
    week_number="int", day_of_week="string", day_type="string",
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to exactly the columns, order and types of ``schema``."""
    return df.to(schema)
