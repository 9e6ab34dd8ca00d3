from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomlens.operators import clean_products as products, staging
from roomlens.operators.clean_events import clean_events
from roomlens.operators.clean_products import date_text
from roomlens.testbed import adapter
from tests.conftest import SMALL_DIR


def test_prices_and_flags(make_events, rows):
    texts = ["", "abc", "nan", "1d", "0", "-5", "99.99", "100", "300", "700", None]
    frame = clean_events(make_events([{"price": p, "user_id": i} for i, p in enumerate(texts)]))
    found = rows(frame.orderBy("user_id"))
    assert [r["price"] for r in found] == [0, 0, 0, 0, 0, -5, 99.99, 100, 300, 700, 0]
    assert [r["is_zero_price"] for r in found] == [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 1]
    assert [r["price_segment"] for r in found] == ["Unknown"] * 5 + [
        "Budget", "Budget", "Mid-Range", "Premium", "Luxury", "Unknown",
    ]


def test_times(make_events, rows):
    texts = [
        "2019-11-01 00:00:03+00:00", "2019-11-02 23:59:59 UTC", "2021-01-03 12:00:00+00:00",
        "2020-02-29 05:00:00+02:00", "bad", "12:30", None,
    ]
    frame = clean_events(make_events([{"event_time": t, "user_id": i} for i, t in enumerate(texts)]))
    found = rows(frame.orderBy("user_id"))
    assert [r["event_date"] for r in found[:4]] == [
        dt.date(2019, 11, 1), dt.date(2019, 11, 2), dt.date(2021, 1, 3), dt.date(2020, 2, 29),
    ]
    assert [r["event_hour"] for r in found[:4]] == [0, 23, 12, 3]
    assert [r["day_of_week"] for r in found[:4]] == ["Friday", "Saturday", "Sunday", "Saturday"]
    assert [r["day_type"] for r in found[:4]] == ["Weekday", "Weekend", "Weekend", "Weekend"]
    assert [r["week_number"] for r in found[:4]] == [44, 44, 53, 9]
    assert found[2]["year"] == 2021 and found[2]["month_name"] == "January"
    for bad in found[4:]:
        parts = ("event_time", "event_date", "event_hour", "day_type", "week_number", "year")
        assert all(bad[name] is None for name in parts)


def test_categories_and_brands(make_events, rows):
    codes = [None, "furniture.bed", "furniture.a.furniture.b", "electronics.x", "furniture"]
    frame = clean_events(
        make_events([{"category_code": c, "user_id": i, "brand": b} for i, (c, b) in enumerate(zip(codes, [None, "", "x", "y", "z"]))])
    )
    found = rows(frame.orderBy("user_id"))
    assert [r["furniture_type"] for r in found] == [None, "bed", "a.b", "electronics.x", "furniture"]
    assert [r["room_type"] for r in found] == [None, "bed", "a", "x", None]
    assert [r["item_type"] for r in found] == [None, None, "furniture", None, None]
    assert [r["brand"] for r in found] == ["Unknown", "", "x", "y", "z"]


def test_filter_drops_missing_category(make_events):
    codes = [None, "furniture.bed", "electronics.x", "furniture"]
    frame = make_events([{"category_code": c} for c in codes])
    assert staging.furniture_only(frame).count() == 2


def test_text_and_typed_paths_agree(spark):
    staged = staging.stage_events(
        staging.furniture_only(adapter.raw_events(spark, SMALL_DIR)), "2024-02-01 00:00:00"
    )
    typed = staged.selectExpr(
        "* EXCEPT (event_time, price)", "try_to_timestamp(event_time) AS event_time",
        "try_cast(price AS DOUBLE) AS price",
    )
    assert typed.where("isnan(price)").count() > 0
    a, b = clean_events(typed), clean_events(staged)
    assert a.schema == b.schema
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_prices_that_are_no_finite_number_count_as_zero(spark, make_events):
    typed = make_events([{}] * 4).drop("price").limit(1).selectExpr(
        "*", "explode(array(DOUBLE('NaN'), DOUBLE('Infinity'), DOUBLE(NULL), 5D)) AS price"
    )
    found = {(r.price, r.price_segment, r.is_zero_price) for r in clean_events(typed).collect()}
    assert found == {(0.0, "Unknown", 1), (5.0, "Budget", 0)}


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_adapter_keeps_every_event(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    raw = adapter.raw_events(spark, folder)
    assert raw.count() == spark.read.parquet(f"{folder}/events.parquet").count()
    assert {r[0] for r in raw.select("event_type").distinct().collect()} == {
        "view", "cart", "purchase", "remove_from_cart", None,
    }


def test_adapter_plants_bad_rows_and_growing_products(spark):
    raw = adapter.raw_events(spark, "/root/testdata/sf0.1")
    (row,) = raw.selectExpr(
        "count_if(event_time = 'no time') AS times", "count_if(price IN ('abc', 'nan')) AS prices",
        "count_if(brand = '') AS brands", "count(DISTINCT product_id) AS products",
    ).collect()
    assert min(row.times, row.prices, row.brands) > 500 and row.products > 1000
    hot = raw.groupBy("product_id").count().agg(F.max("count")).first()[0]
    assert hot > 0.1 * raw.count()


def test_catalogue_dates(spark):
    texts = [
        "November 3, 2019", "Nov 3, 2019", "2019-11-03", "2019-11-3", "11/03/2019", "3 November 2019",
        "03 Nov 2019", " 2019/11/03 ", "20191103", "unknown", "", None, "13/45/2019",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    found = [r[0] for r in df.selectExpr(f"{date_text('t')} AS d", "i").orderBy("i").collect()]
    assert found == [dt.date(2019, 11, 3)] * 9 + [None] * 4


def test_staging_keeps_text_and_stamps(make_events, rows):
    frame = make_events([{"price": "1d"}]).withColumn("product_id", F.lit("12x"))
    (row,) = rows(staging.stage_events(frame, "2024-02-01 08:00:00"))
    assert row["price"] == "1d" and row["product_id"] is None
    assert row["loaded_at"] == dt.datetime(2024, 2, 1, 8)


PRODUCT_FIELDS = (
    "asin", "title", "brand", "price", "availability", "categories", "material", "color", "style",
    "country_of_origin", "date_first_available", "package_dimensions", "manufacturer",
)


@pytest.fixture(scope="module")
def catalogue(spark):
    def build(records):
        data = [
            tuple({"categories": "['H', 'Furniture', 'X']", "asin": f"A{i:03d}", **r}.get(f) for f in PRODUCT_FIELDS)
            for i, r in enumerate(records)
        ]
        return spark.createDataFrame(data, ", ".join(f"{f} STRING" for f in PRODUCT_FIELDS))

    return build


def test_product_labels(catalogue, rows):
    phrases = {
        None: "Unknown", "In Stock": "In Stock", "Only 3 left in stock": "In Stock",
        "Temporarily out of stock.": "Out of Stock", "Currently unavailable": "Out of Stock",
        "Temporarily on hold": "Temporarily Unavailable", "Usually ships soon": "Ships Soon",
        "within 1-2 days": "Ships Soon", "": "Other", "Preorder": "Other",
    }
    frame = products.clean_products(catalogue([{"availability": p, "price": "$1"} for p in phrases]))
    assert rows(frame.orderBy("asin"), "availability") == list(phrases.values())


def test_product_text_fields(catalogue, rows):
    frame = products.clean_products(
        catalogue(
            [
                {"brand": None, "material": None, "date_first_available": "January 5, 2020", "price": "$1,049.99"},
                {"brand": "X Store", "material": " men's engineered-wood ", "date_first_available": "2020-01-06", "price": "29"},
                {"brand": "X Store Y", "material": "nan", "date_first_available": "bad", "price": "0"},
            ]
        )
    )
    found = rows(frame.orderBy("asin"))
    assert [r["brand"] for r in found] == ["None", "X", "X Y"]
    assert [r["material"] for r in found] == ["None", "Men'S Engineered-Wood", "Unknown"]
    assert [r["date_first_available"] for r in found] == [dt.date(2020, 1, 5), dt.date(2020, 1, 6), None]
    assert [r["price"] for r in found] == [1049.99, 29.0, 0.0]
    assert [r["price_segment"] for r in found] == ["Luxury", "Budget", "Unknown"]


def test_imputation(catalogue, rows):
    frame = products.clean_products(
        catalogue(
            [
                {"price": "$10"}, {"price": "$20"}, {"price": None}, {"price": "n/a"},
                {"price": None, "categories": "['H', 'Furniture', 'Empty']"},
                {"price": None, "categories": "['H', 'Furniture']"},
                {"price": "$90", "categories": "['H', 'Furniture', 'Y']"},
                {"price": "$9999", "categories": "['H', 'Bedding', 'X']"},
                {"price": "$9999", "categories": "garbage"},
                {"price": "$9999", "categories": None},
            ]
        )
    )
    found = rows(frame.orderBy("asin"))
    # Known median, none for a sub category without prices, the overall median without one.
    assert [r["price"] for r in found] == [10, 20, 15, 15, None, 20, 90]
    assert [r["sub_category"] for r in found] == ["X"] * 4 + ["Empty", None, "Y"]


def test_preview_uses_single_entry(catalogue, rows):
    lists = ["['H']", "['H', 'F']", "['H', 'F', 'S']", "garbage", "['H', None]"]
    found = rows(products.product_preview(catalogue([{"categories": c} for c in lists])))
    assert [(r["main_category"], r["sub_category"]) for r in found][:4] == [
        ("H", None), ("F", None), ("F", "S"), (None, None),
    ]


def test_median_matches_pandas(spark):
    raw = staging.stage_products(adapter.raw_products(spark, SMALL_DIR), "2024-02-01 00:00:00")
    before = products.furniture_products(raw).select("asin", "sub_category", "price").toPandas()
    after = products.impute_price(products.furniture_products(raw)).select("asin", "price").toPandas()
    by_sub = before.groupby("sub_category")["price"].median()
    overall = before["price"].median()
    filled = before["price"].where(
        before["price"].notna(), before["sub_category"].map(by_sub).where(before["sub_category"].notna(), overall)
    )
    expected = dict(zip(before["asin"], filled))
    assert all(np.isclose(expected[a], p, equal_nan=True) for a, p in zip(after["asin"], after["price"]))
