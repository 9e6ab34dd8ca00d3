"""Frequent values by summary and exact counts against the plain count."""

from __future__ import annotations

import pytest

from roomlens.operators import frequent, profiling


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """A million rows, nearly as many distinct values, and some frequent ones with ties."""
    value = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN concat('w', id % 7) WHEN id % 41 = 2 THEN NULL ELSE concat('b', id) END"
    return spark.range(1_000_000).selectExpr(f"{value} AS `a b`", "id AS value")


def test_same_rows_as_the_plain_count(skewed, monkeypatch):
    wanted = rows(profiling.value_counts(skewed, "a b", 8))
    with monkeypatch.context() as patch:
        patch.setattr(profiling, "value_counts", None)  # proven without counting all values
        assert rows(frequent.top_values(skewed, "a b", 8)) == wanted


def test_values_about_as_rare_are_all_counted(skewed):
    assert rows(frequent.top_values(skewed, "a b", 12)) == rows(profiling.value_counts(skewed, "a b", 12))
    assert rows(frequent.top_values(skewed, "value", 3)) == [(i, 1) for i in range(3)]


def test_first_pass_shuffles_summaries_only(skewed):
    plan = frequent.summary(skewed.selectExpr("`a b` AS value"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan and "hashpartitioning" not in plan


def test_few_values_and_no_rows(spark, skewed):
    few = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "v string")
    assert rows(frequent.top_values(few, "v", 1)) == [("x", 2)]
    assert rows(frequent.top_values(few, "v", 5)) == [("x", 2), ("y", 1)]
    assert rows(frequent.top_values(few.limit(0), "v", 5)) == []


@pytest.mark.parametrize("tracked, size", [(3, 4), (6, 8), (4096, 8192), (7, 16)])
def test_table_size(tracked, size):
    assert frequent._table_size(tracked) == size
