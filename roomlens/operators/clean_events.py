"""Cleaning and enrichment of clickstream events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roomlens.functions.numbers import text_to_double
from roomlens.functions.segments import EVENT_BANDS, price_band
from roomlens.schemas import CLEAN_EVENTS, conform

# A time of day alone would be read as a time of the current day; require a date.
DATE_FIRST = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


# Calendar attributes of an event, as functions of its time or of its date alone.
CALENDAR = {
    "day_of_week": "date_format({0}, 'EEEE')",
    "day_type": """CASE WHEN weekday({0}) >= 5 THEN 'Weekend'
                        WHEN {0} IS NOT NULL THEN 'Weekday' END""",
    "week_number": "weekofyear({0})",
    "month": "month({0})",
    "month_name": "date_format({0}, 'MMMM')",
    "year": "year({0})",
}


def calendar(column: str) -> list[str]:
    return [f"{sql.format(column)} AS {name}" for name, sql in CALENDAR.items()]


def _typed(events: DataFrame) -> DataFrame:
    """Time and price as values; text that does not parse gives null and 0, as does no finite number."""
    types = dict(events.dtypes)
    time = "CAST(event_time AS TIMESTAMP)"
    if types["event_time"] == "string":
        time = f"CASE WHEN event_time RLIKE r'{DATE_FIRST}' THEN try_to_timestamp(event_time) END"
    price = text_to_double("price")
    if types["price"] != "string":
        price = "if(abs(DOUBLE(price)) < DOUBLE('Infinity'), DOUBLE(price), NULL)"
    return events.selectExpr(
        f"{time} AS event_time", "event_type", "product_id", "category_id", "category_code",
        "coalesce(brand, 'Unknown') AS brand", f"coalesce({price}, 0D) AS price", "user_id",
        "user_session", r"split(category_code, r'\.') AS tokens",
    )


def clean_events(events: DataFrame) -> DataFrame:
    """Clean staged (text) or already typed events into the 22-column table.

    A time that does not parse leaves all date parts null and keeps the row.
    """
    enriched = _typed(events).selectExpr(
        "* EXCEPT (tokens)",
        "to_date(event_time) AS event_date",
        "replace(category_code, 'furniture.', '') AS furniture_type",
        "get(tokens, 1) AS room_type",
        "get(tokens, 2) AS item_type",
        f"{price_band('price', EVENT_BANDS)} AS price_segment",
        "INT(price = 0) AS is_zero_price",
        "hour(event_time) AS event_hour",
        *calendar("event_time"),
    )
    return conform(enriched, CLEAN_EVENTS)
