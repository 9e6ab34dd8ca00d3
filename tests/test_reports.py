from __future__ import annotations

import pytest

from roomlens.operators import metrics, profiling, report, views
from roomlens.testbed.registry import Inputs
from tests.conftest import SMALL_DIR, events


@pytest.fixture(scope="module")
def fact(make_fact):
    chair, bed = "furniture.kitchen.chair", "furniture.bedroom.bed"
    return make_fact(
        events("view", 128, product_id=1, category_code=chair, price="50", user_id=1, brand="acme")
        + events("purchase", 1, product_id=1, category_code=chair, price="50", user_id=2, brand="acme")
        + events("view", 40, product_id=2, category_code=bed, price="800", user_id=3, brand=None)
        + events("cart", 4, product_id=2, category_code=bed, price="800", user_id=3, brand=None)
        + events("cart", 3, product_id=3, category_code=None, price="0", user_id=4, brand="void")
    )


def test_funnel(fact, rows):
    found = {r["event_type"]: r for r in rows(views.conversion_funnel(fact))}
    assert found["view"] == dict(
        event_type="view", event_count=168, unique_users=2, unique_sessions=1, pct_of_total=95.45
    )
    assert sum(r["pct_of_total"] for r in found.values()) == pytest.approx(100, abs=0.05)


def test_rooms_and_segments(fact, rows):
    found = {r["room_type"]: r for r in rows(views.room_performance(fact))}
    assert found["kitchen"]["conversion_rate_pct"] == 0.78
    assert found["kitchen"]["total_revenue"] == 50.0
    assert found[None]["views"] == 0 and found[None]["conversion_rate_pct"] is None
    segments = rows(views.price_segment_analysis(fact))
    assert [r["price_segment"] for r in segments] == ["Budget", "Luxury"]
    assert [r["avg_purchase_price"] for r in segments] == [50.0, None]


def test_brand_and_gap_limits_are_strict(fact, rows):
    assert rows(views.brand_performance(fact, 127), "brand") == ["acme"]
    assert rows(views.brand_performance(fact, 128)) == []
    assert rows(views.high_view_no_purchase(fact, 39), "product_id") == [2]
    assert rows(views.high_view_no_purchase(fact, 40)) == []
    assert len(rows(views.high_view_no_purchase(fact, -1, top=1))) == 1


def test_kpis(fact, rows, make_fact):
    (kpis,) = rows(report.kpi_summary(fact))
    assert kpis["conversion_rate"] == 0.6 and kpis["cart_abandonment_rate"] == 85.71
    assert kpis["avg_order_value"] == kpis["total_revenue"] == 50.0
    (none,) = rows(report.kpi_summary(make_fact(events("cart", 2))))
    assert none["total_views"] is None and none["total_purchases"] is None
    assert none["conversion_rate"] == 0.0 and none["avg_order_value"] is None
    sheet = {r["metric"]: r["value"] for r in rows(report.kpi_sheet(report.kpi_summary(fact)))}
    assert sheet["Total Revenue"] == "$50" and sheet["Conversion Rate"] == "0.6%"
    assert sheet["Avg Order Value"] == "$50.00"


def test_report_shapes(fact, rows):
    stages = rows(report.funnel_stages(views.conversion_funnel(fact)), "stage")
    assert stages == ["View", "Cart", "Purchase"]
    assert [r["room_type"] for r in rows(report.room_rates(views.room_performance(fact)))] == [
        "kitchen", "bedroom",
    ]
    assert report.heading("conversion_rate_pct") == "Conversion Rate Pct"
    gaps = rows(report.gap_table(views.high_view_no_purchase(fact, 10), 39), "highlight")
    assert gaps == [True]


def test_profiles(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None), (None, 2)], "s STRING, n INT")
    assert rows(profiling.null_profile(df)) == [
        {"column_name": "s", "null_count": 1, "null_pct": 25.0},
        {"column_name": "n", "null_count": 2, "null_pct": 50.0},
    ]
    assert rows(profiling.null_profile(df.where("s = 'a'"), only_with_nulls=True), "column_name") == ["n"]
    assert rows(profiling.value_counts(df, "s")) == [
        {"value": "a", "row_count": 2}, {"value": "b", "row_count": 1},
    ]
    assert rows(profiling.value_counts(df, "s", 1), "value") == ["a"]
    assert rows(profiling.distinct_count(df, "s"), "distinct_count") == [2]
    assert rows(profiling.distinct_count(df, "s", approx=True), "distinct_count") == [2]
    assert rows(profiling.shape(df))[0]["column_names"] == "s, n"


def test_quality_checks(spark, rows):
    prices = ["0", "0.00", "0.004", "abc", "", None, "12.5", "nan"]
    df = spark.createDataFrame([(p, b) for p, b in zip(prices, ["", None] + ["x"] * 6)], "price STRING, brand STRING")
    assert rows(profiling.zero_price_check(df), "zero_price_events") == [6]
    assert rows(profiling.missing_brand_check(df), "null_brands") == [2]
    assert rows(profiling.missing_price_check(df), "null_prices") == [2]
    lists = spark.createDataFrame([("['a', 'b', 'c']",), ("['a', 'b']",), ("x",), (None,)], "categories STRING")
    assert rows(profiling.category_text_check(lists)) == [
        {"main_cat": "'b'", "cnt": 2}, {"main_cat": None, "cnt": 1}, {"main_cat": "x", "cnt": 1},
    ]


def test_sums_agree_over_groupings(spark):
    fact = Inputs(spark, SMALL_DIR).fact
    total = metrics.measure(fact).first()
    for keys in (["room_type"], ["price_segment"], ["event_date", "event_hour"]):
        rolled = metrics.roll_up(metrics.measure(fact, *keys)).first()
        assert rolled == total
    assert metrics.roll_up(metrics.product_grain(fact)).first() == total
    assert metrics.roll_up(metrics.measure(fact.repartition(7), "brand")).first() == total


def test_product_metrics_take_maxima(make_fact, rows):
    fact = make_fact(
        events("view", 2, price="50", brand="a") + events("view", 1, price="900", brand="b")
        + events("purchase", 1, price="0", brand=None)
    )
    (row,) = rows(metrics.product_metrics(metrics.product_grain(fact)))
    assert (row["views"], row["purchases"], row["price"]) == (3, 1, 900.0)
    assert (row["brand"], row["price_segment"]) == ("b", "Unknown")
    assert row["paid_orders"] == 0 and row["order_price"] == 0


def test_views_from_stored_grain_equal_views_from_fact(spark, rows):
    fact = Inputs(spark, SMALL_DIR).fact
    direct = views.all_views(fact, 10, 2)
    stored = views.all_views(fact, 10, 2, metrics.report_grain(fact))
    for name in direct:
        assert rows(stored[name]) == rows(direct[name]), name
