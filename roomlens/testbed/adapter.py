"""Retail inputs derived from the driver's ``events`` and ``part`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
PART = (
    "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
)

# Category by remainder of the product number.
CATEGORIES = (
    "furniture.living_room.sofa",
    "furniture.living_room.cabinet",
    "furniture.bedroom.bed",
    "furniture.kitchen.chair",
    "furniture.kitchen.table",
    "furniture.bathroom.bath",
)

# Availability text by remainder of the part number, from 1.
AVAILABILITY = (
    "In Stock", "Only 3 left in stock - order soon.", "Temporarily out of stock.",
    "Currently unavailable.", "Temporarily on hold", "Usually ships within 1-2 days", "Preorder",
)

# One product takes a seventh of all events; a third of the rest are of a hundred old products, and
# every 2,500 events bring a hundred new ones, so products grow with the events.
HOT_PRODUCT = 10
IS_HOT = "event_id % 7 = 0"
VARIANT = f"if({IS_HOT} OR event_id % 3 = 0, 0L, 1 + event_id DIV 2500)"

# Purchases that the planted weak products, rooms, bands and days lose, and every other one, are views.
STAGE = """
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'cart'
         WHEN event_type = 'click' THEN 'remove_from_cart'
         WHEN event_type = 'purchase' AND event_id % 2 = 0 AND k % 20 <> 3
              AND (k % 25 <> 7 OR event_id % 20 = 0)
              AND (k % 6 <> 5 OR event_id % 4 = 0)
              AND (k < 88 OR event_id % 4 = 0)
              AND (day(ts) NOT IN (12, 24) OR event_id % 16 = 0)
              AND (day(ts) <> 18 OR event_id % 4 = 0) THEN 'purchase'
         ELSE 'view' END"""

# Texts as an export holds them, some of them bad.
# The month's last day has only events of a day later than given.
TIME = """
    if(event_id % 101 = 0, 'no time',
       concat(date_format(if(event_id % 59 = 0, ts + INTERVAL 1 DAY, ts), 'yyyy-MM-dd HH:mm:ss.SSSSSS'), '+00:00'))"""
PRICE = """
    CASE WHEN event_id % 97 = 0 THEN '0.00' WHEN event_id % 103 = 0 THEN 'abc'
         WHEN event_id % 107 = 0 THEN 'nan' WHEN event_id % 109 = 0 THEN NULL
         ELSE STRING(CAST(k * 8 + 0.99 AS decimal(10,2))) END"""
BRAND = "CASE WHEN event_id % 113 = 0 THEN '' WHEN k % 5 <> 0 THEN concat('brand_', k % 12) END"

# List literals of the catalogue in forms that are no JSON, by number of the form.
LIST_FORMS = (
    "['A', 'Furniture', 'Sofas',]", "['A', None, 'x']", "('A', 'Furniture')", "'B' 'C'",
    "['A', 'Furniture', 'S'] junk", "['A', 5, 'x']", r"['A', 'Furniture', 'x\xa0']",
)


def _list(values: tuple[str, ...]) -> str:
    quoted = (value.replace("\\", "\\\\").replace("'", "\\'") for value in values)
    return "array(" + ", ".join(f"'{value}'" for value in quoted) + ")"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream export, one row per event: time and price are text, as in the CSV file."""
    return (
        spark.read.schema(EVENTS)
        .parquet(f"{sf_dir}/events.parquet")
        .selectExpr("*", f"if({IS_HOT}, {HOT_PRODUCT}, INT(get_json_object(props, '$.k'))) AS k")
        .selectExpr(
            f"{TIME} AS event_time",
            f"{STAGE} AS event_type",
            f"17200000L + k + 100 * {VARIANT} AS product_id",
            "2053013559000000000L + k % 6 AS category_id",
            f"""if(k >= 96, 'electronics.smartphone', get({_list(CATEGORIES)}, k % 6))
                AS category_code""",
            f"{BRAND} AS brand",
            f"{PRICE} AS price",
            "user_id",
            "concat(user_id, '-', DATE(ts)) AS user_session",
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue with gaps, bad texts and every availability phrase, all columns text."""
    return (
        spark.read.schema(PART)
        .parquet(f"{sf_dir}/part.parquet")
        .selectExpr("*", "p_partkey AS n")
        .selectExpr(
            "concat('B', lpad(n, 9, '0')) AS asin",
            "p_name AS title",
            "if(n % 11 <> 0, concat(p_brand, ' Store'), NULL) AS brand",
            """CASE WHEN n % 7 = 0 OR (p_type = 'SMALL' AND n % 3 = 0) THEN NULL
                    WHEN n % 13 = 0 THEN '$1,049.99' WHEN n % 19 = 0 THEN 'n/a'
                    ELSE concat('$', p_size * 4, '.50') END AS price""",
            f"get({_list(AVAILABILITY)}, INT(n % 8) - 1) AS availability",
            rf"""CASE WHEN n % 17 = 0 THEN 'garbage'
                    WHEN n % 31 = 0 THEN get({_list(LIST_FORMS)}, INT(n DIV 31 % 7))
                    WHEN n % 9 = 0 THEN concat('[\'Home & Kitchen\', \'Bedding\', \'', p_type, '\']')
                    WHEN n % 23 = 0 THEN '[\'Home & Kitchen\', \'Furniture\']'
                    ELSE concat('[\'Home & Kitchen\', \'Furniture\', \'', p_type, '\']') END
                AS categories""",
            "if(n % 10 <> 3, lower(p_type), NULL) AS material",
            "get(array('Brown', 'Grey', ''), INT(n % 4)) AS color",
            "if(n % 6 = 1, 'Modern', NULL) AS style",
            "if(n % 5 = 2, 'Denmark', NULL) AS country_of_origin",
            """CASE n % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN 'November 3, 2019' WHEN 2 THEN 'Nov 3, 2019'
                    WHEN 3 THEN '11/03/2019' WHEN 4 THEN '3 November 2019' WHEN 5 THEN NULL
                    ELSE concat('2020-0', n % 9 + 1, '-15') END AS date_first_available""",
            "if(n % 3 = 0, '20 x 30 x 40 inches', NULL) AS package_dimensions",
            "if(n % 4 = 3, concat('Maker ', n % 9), NULL) AS manufacturer",
        )
    )
