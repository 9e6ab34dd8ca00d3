from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roomlens import schemas
from roomlens.operators import model
from roomlens.operators.clean_events import clean_events
from roomlens.sources.scratch import shared_table


def test_dense_key_is_gapless_ordered_and_repeatable(spark):
    df = spark.range(1000).selectExpr("concat('A', lpad(id * 37 % 1000, 4, '0')) AS asin", "id AS v")
    for parts in (1, 9):
        keyed = model.dense_key(shared_table(df.repartition(parts), "t"), "key", "asin")
        found = keyed.orderBy("key").collect()
        assert [r["key"] for r in found] == list(range(1, 1001))
        assert [r["asin"] for r in found] == sorted(r["asin"] for r in found)


def test_dense_key_cuts_a_hot_value(spark):
    df = spark.range(4000).selectExpr("if(id % 2 = 0, 'hot', concat('x', id)) AS asin", "1 AS v")
    keyed = model.dense_key(shared_table(df, "t"), "key", "asin")
    assert keyed.agg(F.countDistinct("key"), F.min("key"), F.max("key")).first()[:] == (4000, 1, 4000)
    hot = keyed.where("asin = 'hot'").agg(F.min("key"), F.max("key"), F.count("*")).first()
    assert hot[1] - hot[0] + 1 == hot[2] == 2000


def test_dim_products_material_and_stock(spark, rows):
    values = [("A", "In Stock", None), ("B", "Other", "None"), ("C", None, "Wood")]
    blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.CLEAN_PRODUCTS.fields}
    frame = spark.createDataFrame(values, "asin STRING, availability STRING, material STRING")
    frame = frame.select([F.col(n) if n in frame.columns else c.alias(n) for n, c in blank.items()])
    found = rows(model.dim_products(shared_table(frame, "t")).orderBy("product_key"))
    assert [r["material"] for r in found] == ["Unknown", "Unknown", "Wood"]
    assert [r["in_stock_flag"] for r in found] == [1, 0, 0]
    assert list(found[0]) == schemas.DIM_PRODUCTS.fieldNames()


def test_dim_date(make_events, rows):
    days = ["2020-02-29 01:00:00", "2020-03-01 02:00:00", "2020-03-01 05:00:00", "2019-12-31 00:00:00"]
    found = rows(model.dim_date(clean_events(make_events([{"event_time": d} for d in days]))))
    assert [r["event_date"] for r in found] == [
        dt.date(2019, 12, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 1),
    ]
    assert [r["quarter_name"] for r in found] == ["Q4", "Q1", "Q1"]
    assert [r["is_month_end"] for r in found] == [1, 1, 0]
    assert [r["is_month_start"] for r in found] == [0, 0, 1]


def test_fact_revenue_and_flags(make_fact, rows):
    kinds = ["view", "cart", "purchase", "purchase", "purchase", None, "remove_from_cart"]
    prices = ["5", "5", "5", "0", "-2", "5", "5"]
    fact = make_fact(
        [{"event_type": k, "price": p, "user_id": i} for i, (k, p) in enumerate(zip(kinds, prices))]
    )
    found = rows(fact.orderBy("user_id"))
    assert [r["revenue"] for r in found] == [0, 0, 5, 0, -2, 0, 0]
    assert [(r["is_view"], r["is_cart"], r["is_purchase"]) for r in found] == [
        (1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 1), (0, 0, 1), (0, 0, 0), (0, 0, 0),
    ]
    declared = [(f.name, f.dataType) for f in schemas.FACT_EVENTS]
    assert [(f.name, f.dataType) for f in fact.schema] == declared
