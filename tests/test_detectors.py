from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest

from roomlens.operators import detect, outputs
from roomlens.plans import detection
from roomlens.sources import writers
from roomlens.sources.scratch import shared_table
from roomlens.testbed.registry import Inputs
from roomlens.thresholds import Thresholds
from tests.conftest import SMALL_DIR

RUN = "2024-02-01"
LOW = Thresholds(zero_purchase_min_views=5, min_views_for_analysis=5, cvr_z_alert=-1.0)


@pytest.fixture(scope="module")
def products(spark):
    def build(records):
        data = [
            (i, v, c, p, 10.0 * i, "b", "room", "Budget", str(price), str(paid), n)
            for i, v, c, p, price, paid, n in records
        ]
        df = spark.createDataFrame(
            data,
            "product_id BIGINT, views BIGINT, cart_adds BIGINT, purchases BIGINT, price DOUBLE, "
            "brand STRING, room_type STRING, price_segment STRING, order_price STRING, "
            "paid_revenue STRING, paid_orders BIGINT",
        )
        return df.selectExpr(
            "* EXCEPT (order_price, paid_revenue)",
            "CAST(order_price AS decimal(38,6)) AS order_price",
            "CAST(paid_revenue AS decimal(38,6)) AS paid_revenue",
        )

    return build


def test_zero_purchase_uses_mean_price_of_all_purchases(products, rows):
    data = [(1, 2000, 1, 0, 0, 0, 0), (2, 1000, 1, 0, 0, 0, 0), (3, 500, 0, 0, 0, 0, 0),
            (4, 499, 0, 0, 0, 0, 0), (5, 900, 0, 4, 300, 300, 3)]
    found = rows(detect.zero_purchase(products(data), RUN))
    assert [(r["product_id"], r["severity"]) for r in found] == [
        (1, "CRITICAL"), (2, "HIGH"), (3, "MEDIUM"),
    ]
    assert [r["est_revenue_lost"] for r in found] == [750.0, 375.0, 188.0]
    assert found[0]["alert_type"] == "ZERO_PURCHASE" and found[0]["run_date"] == RUN


def test_cvr_anomalies_match_direct_arithmetic(products, rows):
    data = [(i, 100 + i, 0, 10, 100, 90, 9) for i in range(8)] + [(50, 300, 2, 3, 30, 30, 3), (51, 400, 0, 0, 0, 0, 0)]
    found = rows(detect.cvr_anomalies(products(data), RUN, LOW))
    population = pd.DataFrame([d[:4] for d in data if d[3] > 0], columns=["id", "v", "c", "p"])
    cvr = (population.p / population.v * 100).round(4)
    z = ((cvr - cvr.mean()) / cvr.std()).round(3)
    assert [r["product_id"] for r in found] == population.id[z < -1.0].tolist() == [50]
    (row,) = found
    expected = round(300 * cvr.mean() / 100)
    order_value = (8 * 90 + 30) / (8 * 9 + 3)
    assert row["z_score"] == z.iloc[-1] and row["mean_cvr_pct"] == round(cvr.mean(), 4)
    assert (row["expected_purchases"], row["purchase_gap"]) == (expected, expected - 3)
    assert row["est_revenue_lost"] == round((expected - 3) * order_value)


def test_equal_products_give_no_alert(products, rows):
    same = [(i, 100, 0, 5, 50, 50, 5) for i in range(4)]
    assert rows(detect.cvr_anomalies(products(same), RUN, LOW)) == []
    assert rows(detect.cvr_anomalies(products(same[:1]), RUN, LOW)) == []


def days(spark, records):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, d), v, p, str(r)) for d, v, p, r in records],
        "event_date DATE, views BIGINT, purchases BIGINT, revenue STRING",
    )
    return df.selectExpr("* EXCEPT (revenue)", "CAST(revenue AS decimal(38,6)) AS revenue")


def test_trend_matches_pandas_rolling(spark, rows):
    rng = np.random.default_rng(3)
    records = [(d, int(v), int(p), float(r)) for d, v, p, r in zip(
        [1, 2, 3, 4, 6, 7, 8, 9, 12, 13, 14], rng.integers(50, 99, 11), rng.integers(1, 20, 11), rng.integers(1, 999, 11))]
    records[4] = (6, 0, 0, 0.0)
    found = pd.DataFrame(rows(detect.daily_trend(days(spark, records))))
    frame = pd.DataFrame(records, columns=["d", "v", "p", "r"])
    cvr = (frame.p / frame.v.replace(0, np.nan) * 100).round(4)
    rolling = cvr.rolling(7, min_periods=3).mean()
    assert np.allclose(found.rolling_avg, rolling, equal_nan=True)
    assert np.allclose(found.cvr_vs_avg, ((cvr - rolling) / rolling * 100).round(2), equal_nan=True, atol=0.011)
    assert np.allclose(found.rev_rolling, frame.r.rolling(7, min_periods=3).mean(), equal_nan=True)
    assert found.rolling_avg.isna().tolist()[:3] == [True, True, False]


def test_drops_and_severity(spark, rows):
    records = [(d, 100, 10, 1) for d in range(1, 8)] + [(8, 100, 1, 1), (9, 100, 6, 1), (10, 100, 5, 1), (11, 0, 0, 0)]
    trend = detect.daily_trend(days(spark, records))
    drops = rows(detect.daily_drops(trend, RUN))
    assert [(r["event_date"].day, r["severity"]) for r in drops] == [
        (8, "CRITICAL"), (9, "MEDIUM"), (10, "HIGH"),
    ]
    (worst,) = rows(detect.worst_drop(detect.daily_drops(trend, RUN)))
    assert worst["event_date"] == dt.date(2024, 1, 8)
    assert rows(detect.worst_drop(detect.daily_drops(trend.limit(3), RUN))) == []
    assert sum(rows(detect.daily_chart(trend), "alert")) == 3


def test_few_days_never_alert(spark, rows):
    trend = detect.daily_trend(days(spark, [(1, 100, 50, 1), (2, 100, 1, 1)]))
    assert rows(detect.daily_drops(trend, RUN)) == []


def test_monitor_pools_all_groups(spark, rows):
    data = [("a", 100, 20, "5"), ("b", 300, 20, "7"), (None, 100, 9, "0"), ("none", 0, 0, "0")]
    groups = spark.createDataFrame(data, "room_type STRING, views BIGINT, purchases BIGINT, revenue STRING")
    found = {r["room_type"]: r for r in rows(detect.monitor(groups, "room_type", RUN))}
    pool = 49 / 500 * 100
    assert found["b"]["vs_avg_pct"] == round((6.6667 - pool) / pool * 100, 2)
    assert [found[k]["alert"] for k in ("a", "b", None, "none")] == [False, True, False, False]


@pytest.fixture(scope="module")
def run(spark):
    inputs = Inputs(spark, SMALL_DIR)
    limits = Thresholds(
        zero_purchase_min_views=3, zero_purchase_critical_views=8, zero_purchase_high_views=6,
        min_views_for_analysis=3, cvr_z_alert=-0.5,
    )
    return inputs, limits


def test_log_is_the_union_of_all_alerts(run, rows, tmp_path, spark):
    inputs, limits = run
    frames = detection.datasets(inputs.fact, RUN, f"{RUN} 08:00:00", limits)
    log = rows(frames["alert_log"])
    alerts = {
        "ZERO_PURCHASE": rows(frames["zero_purchase"]),
        "CVR_ANOMALY": rows(frames["cvr_anomalies"]),
        "DAILY_CVR_DROP": rows(frames["daily_drops"]),
        "ROOM_UNDERPERFORM": rows(frames["rooms"].where("alert")),
        "SEGMENT_UNDERPERFORM": rows(frames["segments"].where("alert")),
    }
    for name, expected in alerts.items():
        assert sum(r["alert_type"] == name for r in log) == len(expected)
    assert alerts["ZERO_PURCHASE"] and alerts["CVR_ANOMALY"]
    (summary,) = rows(frames["alert_summary"])
    at_risk = sum(r["est_revenue_lost"] for n in ("ZERO_PURCHASE", "CVR_ANOMALY") for r in alerts[n])
    assert summary["total_alerts"] == len(log) and summary["revenue_at_risk"] == at_risk
    assert summary["critical"] + summary["high"] + summary["medium"] == len(log)

    watch = rows(frames["watchlist"])
    assert len(watch) == len(alerts["ZERO_PURCHASE"]) + len(alerts["CVR_ANOMALY"])
    keys = [(r["severity"], -r["est_revenue_lost"]) for r in watch]
    assert keys == sorted(keys)
    assert all(r["price"] is None and r["brand"] is None for r in watch if r["alert_type"] == "CVR_ANOMALY")
    assert all(r["z_score"] is None for r in watch if r["alert_type"] == "ZERO_PURCHASE")

    path = str(tmp_path / "log")
    writers.append_json_lines(frames["alert_log"], path)
    writers.append_json_lines(frames["alert_log"], path)
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    assert len(lines) == 2 * len(log)
    zero = next(r for r in lines if r["alert_type"] == "ZERO_PURCHASE")
    assert set(zero) == {
        "timestamp", "alert_type", "severity", "product_id", "views", "purchases", "est_rev_lost",
        "room_type", "message",
    }


def test_messages(spark, rows, products):
    zero = detect.zero_purchase(
        products([(7, 2000, 0, 0, 0, 0, 0), (8, 100, 0, 1, 10, 10, 1)]), RUN).withColumnRenamed("room_type", "x").selectExpr("*", "STRING(NULL) AS room_type")
    low = detect.cvr_anomalies(products([(i, 100, 0, 10, 1, 1, 1) for i in range(9)] + [(9, 128, 0, 1, 1, 1, 1)]), RUN, LOW)
    drops = spark.createDataFrame(
        [("DAILY_CVR_DROP", "HIGH", dt.date(2024, 1, 9), 1.5, -30.25)],
        "alert_type STRING, severity STRING, event_date DATE, cvr_pct DOUBLE, cvr_vs_avg DOUBLE")
    rooms = spark.createDataFrame([(None, 1.0, -25.55, True), ("ok", 1.0, 2.0, False)],
                                  "room_type STRING, cvr_pct DOUBLE, vs_avg_pct DOUBLE, alert BOOLEAN")
    segments = rooms.withColumnRenamed("room_type", "price_segment")
    log = rows(outputs.alert_log(zero, low, drops, rooms, segments, "t"))
    assert [r["message"] for r in log] == [
        "Product 7 has 2000 views and 0 purchases",
        "Product 9 CVR 0.7812% is -2.85 std devs below mean",
        "CVR dropped -30.2% vs 7-day rolling avg on 2024-01-09",
        "Room 'None' CVR is -25.6% below overall avg",
        "Segment 'None' CVR is -25.6% below overall avg",
    ]
    assert log[0]["room_type"] == "None"


def test_top_lists_break_ties_by_product(products, rows):
    zero = detect.zero_purchase(products([(i, 600, 0, 0, 0, 0, 0) for i in (5, 3, 9)] + [(1, 10, 0, 1, 5, 5, 1)]), RUN)
    assert rows(detect.top_zero_purchase(zero, 2), "product_id") == [3, 5]
    assert rows(outputs.zero_purchase_chart(zero, 1), "product_id") == [3]


def test_histogram_matches_numpy(spark, rows):
    rng = np.random.default_rng(5)
    for values in (np.round(rng.normal(size=200), 3), np.arange(-20, 21) / 10, np.array([1.5]), np.array([2.0, 2.0])):
        df = shared_table(spark.createDataFrame([(float(v),) for v in values] + [(None,)], "z DOUBLE"), "t")
        found = rows(outputs.histogram(df, "z").orderBy("bin"))
        counts, edges = np.histogram(values, bins=20)
        assert [r["row_count"] for r in found] == counts.tolist()
        assert np.allclose([r["bin_from"] for r in found], edges[:-1])
    empty = spark.createDataFrame([], "z DOUBLE")
    assert rows(outputs.histogram(empty, "z")) == []
