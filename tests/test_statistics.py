from __future__ import annotations

import math

import numpy as np
import pytest

from roomlens.functions import tails
from roomlens.operators import metrics, statistics
from roomlens.operators.quantiles import frequencies
from roomlens.sources.scratch import shared_table
from roomlens.thresholds import Thresholds
from tests.conftest import events


def counts(spark, pairs, key="room_type"):
    return spark.createDataFrame(
        [(k, v, p) for k, v, p in pairs], f"{key} STRING, views BIGINT, purchases BIGINT"
    )


def test_funnel(make_fact, rows):
    totals = metrics.measure(make_fact(events("view", 250) + events("cart", 20) + events("purchase", 10)))
    (row,) = rows(statistics.funnel_stats(totals))
    assert (row["view_to_cart_pct"], row["cart_to_purchase_pct"]) == (8.0, 50.0)
    assert (row["overall_cvr_pct"], row["drop_off_pct"], row["vs_industry_pct"]) == (4.0, 96.0, 2.0)
    assert row["chi2_statistic"] == 5.1
    (test,) = rows(statistics.funnel_p(totals))
    assert test["p_value"] == 0.023898 and test["significant"]


def test_funnel_without_views(make_fact, rows):
    totals = metrics.measure(make_fact(events("cart", 2)))
    (row,) = rows(statistics.funnel_stats(totals))
    assert row["views"] == 0 and row["overall_cvr_pct"] is None and row["chi2_statistic"] is None
    (test,) = rows(statistics.funnel_p(totals))
    assert test["p_value"] is None and test["significant"] is False


def amounts(spark, data):
    orders = spark.createDataFrame(data, "price_segment STRING, revenue DOUBLE")
    return frequencies(orders, "revenue", ["price_segment"])


def test_anova_textbook(spark, rows):
    groups = {"a": [6, 8, 4, 5, 3, 4], "b": [8, 12, 9, 11, 6, 8], "c": [13, 9, 11, 8, 7, 12]}
    orders = amounts(spark, [(k, float(v)) for k, values in groups.items() for v in values])
    (row,) = rows(statistics.segment_anova(orders))
    assert (row["df_between"], row["df_within"], row["f_statistic"]) == (2, 15, 9.26)
    assert row["eta_squared"] == 0.5526 and row["effect"] == "large"
    (test,) = rows(statistics.segment_anova_p(orders))
    assert test["p_value"] == pytest.approx(0.002399, abs=1e-6)


def test_anova_counts_orders_without_band_in_total_only(spark, rows):
    data = [("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 100.0)]
    orders = amounts(spark, data)
    (row,) = rows(statistics.segment_anova(orders))
    values = np.array([v for _, v in data])
    grand = values.mean()
    between = 2 * (1.5 - grand) ** 2 + (5 - grand) ** 2
    assert row["eta_squared"] == round(between / ((values - grand) ** 2).sum(), 4)
    pooled = np.mean([1, 2, 5])
    f = (2 * (1.5 - pooled) ** 2 + (5 - pooled) ** 2) / 1 / (0.5 / 1)
    assert (row["df_between"], row["df_within"], row["f_statistic"]) == (1, 1, round(f, 2))


def test_segment_descriptive(spark, rows):
    orders = amounts(spark, [("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 4.0), (None, 3.0)])
    found = {r["price_segment"]: r for r in rows(statistics.segment_descriptive(orders))}
    assert found["a"] == dict(price_segment="a", count=3, mean=4.0, median=2.0, std=4.36)
    assert found["b"]["std"] is None and set(found) == {"a", "b"}


def cells(spark, per_hour):
    data = [(d, h, n) for h, values in per_hour.items() for d, n in enumerate(values)]
    return spark.createDataFrame(data, "d INT, event_hour INT, purchases BIGINT")


def brute_kruskal(groups):
    values = np.concatenate([np.array(g, dtype=float) for g in groups])
    order = np.argsort(values, kind="stable")
    ranks = np.empty(len(values))
    for v in np.unique(values):
        places = np.where(values[order] == v)[0] + 1
        ranks[values == v] = places.mean()
    n, at, total = len(values), 0, 0.0
    for g in groups:
        total += ranks[at : at + len(g)].sum() ** 2 / len(g)
        at += len(g)
    h = 12 / (n * (n + 1)) * total - 3 * (n + 1)
    sizes = np.unique(values, return_counts=True)[1].astype(float)
    return h / (1 - (sizes**3 - sizes).sum() / (n**3 - n))


def test_rank_test_matches_direct_ranks(spark, rows):
    rng = np.random.default_rng(7)
    per_hour = {h: rng.integers(0, 6, size=9).tolist() for h in range(8)}
    per_hour[None] = [50, 60]
    (row,) = rows(statistics.hourly_rank_test(cells(spark, per_hour)))
    groups = [[v for v in g if v > 0] for h, g in per_hour.items() if h is not None]
    groups = [g for g in groups if g]
    assert row["hours"] == len(groups) and row["samples"] == sum(map(len, groups))
    assert row["kw_statistic"] == pytest.approx(brute_kruskal(groups), rel=1e-12)
    (test,) = rows(statistics.hourly_rank_p(statistics.hourly_rank_test(cells(spark, per_hour))))
    assert test["p_value"] == round(tails.chi2_tail(row["kw_statistic"], len(groups) - 1), 6)


def test_hours(spark, rows):
    hours = spark.createDataFrame([(9, 5), (3, 5), (20, 1), (4, 1), (18, 2)], "hour INT, purchases BIGINT")
    (ends,) = rows(statistics.hourly_extremes(hours))
    assert ends == dict(peak_hour=3, peak_count=5, trough_hour=4, trough_count=1)
    assert rows(statistics.business_hours(hours), "biz_hours_pct") == [50.0]
    (band,) = rows(statistics.hourly_interval(hours))
    values = [5, 5, 1, 1, 2]
    margin = 2.7764451052 * np.std(values, ddof=1) / math.sqrt(5)
    assert (band["mean_per_hour"], band["ci_95_low"], band["ci_95_high"]) == (
        2.8, round(2.8 - margin, 1), round(2.8 + margin, 1),
    )
    (one,) = rows(statistics.hourly_interval(hours.limit(1)))
    assert one["mean_per_hour"] == 5.0 and one["ci_95_low"] is None


def test_rooms(spark, rows):
    rooms = counts(spark, [("a", 200, 10), ("b", 400, 20), (None, 300, 3), ("few", 100, 50)])
    ranked = statistics.room_ranking(rooms)
    assert rows(ranked, "room_type") == ["a", "b", None]
    (test,) = rows(statistics.room_test(ranked))
    rate = 23 / 700
    chi2 = (10 - 200 * rate) ** 2 / (200 * rate) + (190 - 200 * (1 - rate)) ** 2 / (200 * (1 - rate))
    assert test == dict(top_room="a", top_cvr=5.0, chi2=round(chi2, 2))
    (p,) = rows(statistics.room_test_p(ranked))
    assert p["p_value"] == pytest.approx(tails.chi2_tail(chi2, 1), abs=1e-6)


def test_wilson(spark, rows):
    (row,) = rows(statistics.wilson_interval(counts(spark, [("a", 100, 10)]).selectExpr("*", "10D AS cvr_pct")))
    assert row["ci_low"] == pytest.approx(5.5229, abs=1e-4)
    assert row["ci_high"] == pytest.approx(17.4366, abs=1e-4)
    assert "p" not in row and "n" not in row


def products(spark, triples):
    df = spark.createDataFrame(triples, "product_id BIGINT, views BIGINT, purchases BIGINT")
    return df.selectExpr("*", "CAST(purchases * 10 AS decimal(38,6)) AS revenue")


def test_gap_scores(spark, rows):
    data = [(1, 100, 4), (2, 200, 8), (3, 150, 0), (4, 100, 1), (5, 99, 0), (6, 128, 1)]
    found = {r["product_id"]: r for r in rows(statistics.gap_scores(products(spark, data)))}
    assert set(found) == {1, 2, 3, 4, 6}
    cvr = np.round(np.array([4.0, 4.0, 0.0, 1.0, 100 / 128]), 4)
    assert found[6]["cvr_pct"] == 0.7812
    z = np.round((cvr - cvr.mean()) / cvr.std(ddof=1), 3)
    assert [found[i]["z_score"] for i in (1, 2, 3, 4, 6)] == list(z)
    assert [found[i]["anomaly"] for i in (1, 2, 3, 4, 6)] == [False, False, True, False, False]
    lost = np.round((cvr.mean() / 100 * 150 - 0) * 220.35)
    assert found[3]["revenue_lost"] == lost and found[1]["revenue_lost"] == 0.0


def test_gap_without_spread_flags_only_zero_purchases(spark, rows):
    scores = statistics.gap_scores(products(spark, [(1, 100, 0), (2, 100, 0)]))
    assert rows(scores.orderBy("product_id"), "z_score") == [None, None]
    (row,) = rows(statistics.gap_summary(scores))
    assert (row["total_products"], row["anomaly_count"], row["std_cvr"]) == (2, 2, 0.0)
    single = statistics.gap_scores(products(spark, [(1, 100, 3)]))
    assert rows(single, "anomaly") == [False]
    (none,) = rows(statistics.gap_summary(statistics.gap_scores(products(spark, [(1, 5, 3)]))))
    assert none["total_products"] == 0 and none["total_rev_lost"] == 0.0


def test_gap_chart_takes_views_first(spark, rows):
    data = [(i, 100 + i, 0) for i in range(20)] + [(99, 1000, 900)]
    scores = shared_table(statistics.gap_scores(products(spark, data)), "t")
    chart = rows(statistics.gap_chart(scores, 3, Thresholds(gap_severe_z=-0.1)))
    assert {r["product_id"] for r in chart} == {17, 18, 19}
    assert [r["revenue_lost"] for r in chart] == sorted((r["revenue_lost"] for r in chart), reverse=True)
    assert rows(statistics.gap_listing(scores, 2), "product_id") == [19, 18]
