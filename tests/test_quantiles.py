from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from roomlens.operators.quantiles import describe, frequencies, moments, quantiles

SHARES = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q75": 0.75, "q100": 1.0}


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k STRING, v DOUBLE")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-1e6, 1e6))),
        min_size=1, max_size=60,
    )
)
def test_quantiles_match_numpy(spark, pairs):
    found = {
        r["k"]: r for r in quantiles(frequencies(frame(spark, pairs), "v", ["k"]), SHARES, ["k"]).collect()
    }
    groups = {k: [v for g, v in pairs if g == k and v is not None] for k in ("a", "b")}
    assert set(found) == {k for k, values in groups.items() if values}
    for k, row in found.items():
        for name, share in SHARES.items():
            assert row[name] == pytest.approx(float(np.quantile(groups[k], share)), rel=1e-9, abs=1e-6)


def test_hot_value_and_partitions(spark):
    pairs = [("a", 5.0)] * 500 + [("a", float(i)) for i in range(400)] + [("b", 1.0)]
    expected = np.quantile([v for k, v in pairs if k == "a"], [0.1, 0.5, 0.75])
    for parts in (1, 7):
        df = frame(spark, pairs).repartition(parts)
        row = quantiles(frequencies(df, "v", ["k"]), SHARES, ["k"]).where("k = 'a'").first()
        assert [row["q10"], row["q50"], row["q75"]] == pytest.approx(list(expected))


def test_empty_column(spark):
    df = frame(spark, [("a", None)])
    assert quantiles(frequencies(df, "v"), SHARES).count() == 0
    row = describe(df, "v").first()
    assert row["count"] == 0 and row["mean"] is None and row["q50"] is None


def test_describe_and_moments(spark):
    values = [3.5, 1.0, 1.0, 10.25, 7.0]
    row = describe(frame(spark, [("a", v) for v in values] + [("a", None)]), "v").first().asDict()
    q = np.quantile(values, [0.25, 0.5, 0.75])
    expected = dict(
        count=5, mean=np.mean(values), std=np.std(values, ddof=1), min=1.0, q25=q[0], q50=q[1],
        q75=q[2], max=10.25,
    )
    assert row == pytest.approx(expected, abs=1e-6)
    one = moments(frequencies(frame(spark, [("a", 2.0), ("b", 1.0), ("b", 1.0)]), "v", ["k"]), ["k"])
    assert {r["k"]: (r["count"], r["std"]) for r in one.collect()} == {"a": (1, None), "b": (2, 0.0)}


SPREADS = {
    "crowded beside one outlier": lambda n: np.r_[1.0 + np.arange(n - 1) * np.finfo(float).eps, 1e300],
    "within a thousandth": lambda n: 1e6 + np.arange(n) * 0.005,
    "all magnitudes": lambda n: np.r_[-np.logspace(-300, 300, n // 2), np.logspace(-300, 300, n - n // 2)],
}


@pytest.mark.parametrize("spread", SPREADS)
@pytest.mark.parametrize("range_rows", [1, 50, 1 << 18])
def test_ranges_are_cut_until_they_are_short(spark, monkeypatch, spread, range_rows):
    """Exact values, whatever the spread, and no range longer than the bound is left to rank."""
    from roomlens.operators import quantiles as module

    values = np.unique(SPREADS[spread](3000))
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in (values if k == "a" else values[:7])], "k STRING, v DOUBLE")
    left = []
    real = module._narrowed
    monkeypatch.setattr(module, "_narrowed", lambda *a: left.append(real(*a)) or left[-1])
    found = {r.k: r for r in quantiles(frequencies(df, "v", ["k"]), SHARES, ["k"], range_rows=range_rows).collect()}
    for k, given in (("a", values), ("b", values[:7])):
        assert [found[k][q] for q in SHARES] == pytest.approx([np.quantile(given, s) for s in SHARES.values()], rel=1e-12, abs=0)
    assert len(left) == (range_rows < 3000)
    for state in left:
        rows = state.groupBy("k", "part").count().collect()
        assert max(r["count"] for r in rows) <= range_rows and len(rows) <= 20


def test_a_million_values_beside_an_outlier(spark, monkeypatch):
    """One group, a million distinct values within 1e-9 of each other's size: no task ranks more than the bound."""
    from roomlens.operators import quantiles as module

    df = spark.range(1_000_001).selectExpr("if(id = 1000000, 1e12D, 1D + id * 1e-15D) AS v")
    left = []
    real = module._narrowed
    monkeypatch.setattr(module, "_narrowed", lambda *a: left.append(real(*a)) or left[-1])
    row = quantiles(frequencies(df, "v"), SHARES, range_rows=10_000).first()
    values = np.r_[1.0 + np.arange(1_000_000) * 1e-15, 1e12]
    assert [row[q] for q in SHARES] == [np.quantile(values, s) for s in SHARES.values()]
    assert left[0].groupBy("part").count().agg({"count": "max"}).first()[0] <= 10_000
