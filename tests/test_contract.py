"""Every registered query against its SQL oracle, and the shape of the plans."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from roomlens.testbed import oracle, registry
from roomlens.testbed.registry import Inputs
from tests.conftest import SMALL_DIR

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}
QUERIES, ORACLES = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def by_name(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([row[i] for i in order] for row in found), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def one_scan(name):
    single = ("vw_", "q_", "monitor_", "hourly_be", "kruskal", "dq_", "profile_")
    return name.startswith(single)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL_DIR)
    found = [tuple(row) for row in df.collect()]
    cursor = duck.execute(ORACLES[name])
    expected_types = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == expected_types
    names = [c[0] for c in cursor.description]
    assert by_name(df.columns, found) == by_name(names, cursor.fetchall())

    plan = final_plan(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if one_scan(name):
        # The initial part: an empty result lets the final one drop its scan.
        assert plan.split("== Initial Plan ==")[-1].count("FileScan parquet") == 1


def test_entry(spark):
    # view, cart, purchase, another type and none
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", ["detect_cvr_anomalies", "alert_summary"])
def test_product_results_read_the_stored_grain(spark, name):
    df = QUERIES[name](spark, SMALL_DIR)
    df.collect()
    plan = final_plan(df)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    raw = [line for line in scans if "events.parquet" in line]
    # Only the daily series of the alert log reads events besides the grain.
    assert len({line.split("ReadSchema")[-1] for line in raw}) <= (1 if name == "alert_summary" else 0)


def test_events_are_aggregated_by_hash(spark):
    inputs = Inputs(spark, SMALL_DIR)
    from roomlens.operators import metrics

    for frame in (metrics.product_grain(inputs.fact), inputs.totals, inputs.rooms, inputs.cells):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark, tmp_path):
    inputs = Inputs(spark, SMALL_DIR)
    inputs.fact.write.parquet(str(tmp_path / "fact"))
    from roomlens.operators import views

    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = views.brand_performance(fact)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "event_type", "brand", "revenue", "is_zero_price",
    }
    assert "EqualTo(is_zero_price,0)" in plan.split("PushedFilters: ")[1]


@pytest.mark.parametrize(
    ("query", "column"),
    [
        ("report_gap", "highlight"), ("gap_top15", "severe"), ("dim_date", "is_month_end"), ("clean_products", "color"),
        ("clean_products", "style"), ("clean_products", "country_of_origin"), ("clean_products", "manufacturer"),
        ("clean_products", "date_first_available"), ("monitor_rooms", "alert"), ("monitor_segments", "alert"),
        ("detect_zero_purchase", "severity"), ("detect_cvr_anomalies", "severity"), ("detect_daily_drops", "severity"),
        ("stg_events", "event_type"), ("daily_cvr_chart", "alert"),
    ],
)
def test_checked_columns_vary(query, column):
    """A column that is constant in the check proves nothing."""
    connection = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.01/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    values = connection.execute(f"SELECT DISTINCT {column} FROM ({ORACLES[query]})").fetchall()
    assert len(values) > 1
