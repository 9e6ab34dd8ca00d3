"""Daily runs: bitmaps, late events, reruns, and event files of different shapes."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomlens import schemas
from roomlens.operators import changes, keys, model, report, views, visits as bits
from roomlens.plans import detection, reporting, warehouse
from roomlens.plans.cells import Cells, partition_digests
from roomlens.plans.visits import Visits
from roomlens.sources import readers, versions, writers
from roomlens.sources.scratch import shared_table
from tests.test_jobs import EVENTS, LIMITS, PRODUCTS


def sample(make_fact, days=9, extra=()):
    """Views and purchases of some users a day; some rows lack a date, a user or a type."""
    records = [
        dict(
            event_time=f"2019-11-{1 + i % days:02d} 10:00:00", event_type=["view", "view", "cart", "purchase", None][i * i % 5],
            product_id=1 + i % 4, user_id=None if i % 31 == 0 else i % 23, user_session=None if i % 37 == 0 else f"s{i % 41}",
            price=str(5 + i % 3),
        )
        for i in range(400)
    ]
    return make_fact(records + [dict(event_time="bad", user_id=77, user_session="s77")] * 3 + list(extra))


def found(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def same_views(store, fact):
    assert found(store.conversion_funnel()) == found(views.conversion_funnel(fact))
    assert found(store.daily_trend()) == found(views.daily_trend(fact))
    assert found(store.kpi_summary()) == found(report.kpi_summary(fact))


@pytest.fixture
def stored(spark, tmp_path):
    def write(fact, name="fact"):
        writers.replace_partitioned(fact, str(tmp_path / name), "event_date")
        return lambda: spark.read.schema(fact.schema).parquet(str(tmp_path / name))

    return write


def test_bitmaps_give_the_views_day_by_day(spark, make_fact, stored, tmp_path):
    read = stored(sample(make_fact))
    store = Visits(spark, str(tmp_path / "visits"))
    dates = changes.touched_dates(read())
    assert dates[0] is None and len(dates) == 10
    for upto in range(len(dates)):
        store.add_days(read(), [dates[upto]])
    same_views(store, read())
    before = store.numbers().orderBy("kind", "value").collect()
    store.add_days(read(), dates[3:5])  # again: the same bits, no new number
    same_views(store, read())
    assert store.numbers().orderBy("kind", "value").collect() == before
    assert len({(r.number) for r in before}) == len(before) == max(r.number for r in before)
    whole = Visits(spark, str(tmp_path / "whole")).add_days(read())
    same_views(whole, read())


def test_a_new_day_reads_its_own_events_only(spark, make_fact, stored, tmp_path, monkeypatch):
    """Neither adding a day nor any view reads an event of another day."""
    read = stored(sample(make_fact))
    store = Visits(spark, str(tmp_path / "visits"))
    dates = changes.touched_dates(read())
    store.add_days(read(), dates[:-1])
    plans = []
    original = bits.seen, bits.day_measures

    def watched(place):
        def call(frame):
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
            return original[place](frame)

        return call

    monkeypatch.setattr(bits, "seen", watched(0))
    monkeypatch.setattr(bits, "day_measures", watched(1))
    store.add_days(read(), dates[-1:])
    assert len(plans) == 2 and all("event_date#" in p and str(dates[-1]) in p.split("PartitionFilters")[1] for p in plans)
    for frame in (store.conversion_funnel(), store.daily_trend(), store.kpi_summary()):
        files = frame.inputFiles()
        assert files and all("/visits/measures/" in f or "/visits/bitmaps/" in f for f in files)
    same_views(store, read())


def test_a_run_that_dies_is_finished_by_the_next(spark, make_fact, stored, tmp_path, monkeypatch):
    read = stored(sample(make_fact))
    store = Visits(spark, str(tmp_path / "visits"))
    dates = changes.touched_dates(read())
    store.add_days(read(), dates[:4])
    for step in ("bitmaps", "day_measures"):
        with monkeypatch.context() as patch:
            patch.setattr(bits, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                store.add_days(read(), dates[4:])
    store.add_days(read(), dates[4:])
    same_views(store, read())


def test_users_past_one_bucket(spark, tmp_path):
    """70,000 users fill three buckets; a day that repeats them changes no number."""
    rows = spark.range(70_000).selectExpr(
        "id AS user_id", "concat('s', id % 50000) AS user_session", "DATE'2019-11-01' AS event_date", "'view' AS event_type"
    )
    seen = bits.seen(rows)
    numbers = bits.new_numbers(seen, spark.createDataFrame([], bits.NUMBERS))
    numbers.write.parquet(str(tmp_path / "n"))
    numbers = spark.read.parquet(str(tmp_path / "n"))
    maps = bits.bitmaps(seen, numbers)
    assert bits.distinct_counts(maps).first()[:] == (70_000, 50_000)
    assert maps.groupBy("kind", "bucket").count().count() >= 5
    assert bits.new_numbers(seen, numbers).count() == 0
    assert bits.distinct_counts(maps.limit(0)).first()[:] == (0, 0)


RUN = ("2019-12-01", "2019-12-01 08:00:00", LIMITS)


def alerts(spark, folder):
    return [json.loads(r.value) for r in spark.read.text(f"{folder}/alert_log").collect()]


def test_a_rerun_leaves_each_alert_once(spark, make_fact, tmp_path, monkeypatch):
    fact, folder = sample(make_fact), str(tmp_path / "out")
    first = detection.run(fact, folder, *RUN).first()
    ids = sorted(a["alert_id"] for a in alerts(spark, folder))
    assert len(set(ids)) == len(ids) == first.total_alerts > 0
    detection.run(fact, folder, *RUN)
    assert sorted(a["alert_id"] for a in alerts(spark, folder)) == ids
    with monkeypatch.context() as patch:  # dies after the log, before the watchlist
        patch.setattr(writers, "write_csv", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            detection.run(fact, folder, *RUN)
    detection.run(fact, folder, *RUN)
    assert sorted(a["alert_id"] for a in alerts(spark, folder)) == ids
    detection.run(fact, folder, "2019-12-02", "2019-12-02 08:00:00", LIMITS)
    both = alerts(spark, folder)
    assert len({a["alert_id"] for a in both}) == len(both) == 2 * len(ids)
    quiet = detection.run(fact.limit(0), folder, *RUN).first()  # a rerun without alerts empties its own date only
    assert quiet.total_alerts == 0 and len(alerts(spark, folder)) == len(ids)


def test_late_moved_and_deleted_events(spark, make_fact, stored, tmp_path, monkeypatch):
    """The incremental result equals the full one; only touched dates are read."""
    fact = sample(make_fact)
    read = stored(fact)
    detection.run(read(), str(tmp_path / "daily"), *RUN)

    late = make_fact([dict(event_time="2019-11-02 09:00:00", event_type="purchase", product_id=2, price="9")] * 40)
    moved = read().where("event_date = DATE'2019-11-04' AND user_id = 3").limit(2)
    moved_to = moved.selectExpr("* EXCEPT (event_date)", "DATE'2019-11-20' AS event_date").select(*fact.columns)
    gone = read().where("event_date = DATE'2019-11-07' OR event_date IS NULL")
    inserted, deleted = late.unionByName(moved_to), moved.unionByName(gone)
    dates = changes.touched_dates(inserted, deleted)
    assert dates == [None, *(dt.date(2019, 11, d) for d in (2, 4, 7, 20))]

    after = changes.changed(read(), inserted, deleted)
    read_after = stored(after, "after")
    incremental = detection.run(read_after(), str(tmp_path / "daily"), *RUN, dates=dates).first()
    full = detection.run(read_after(), str(tmp_path / "full"), *RUN).first()
    assert incremental == full
    days = [spark.read.parquet(str(tmp_path / f / "product_days")) for f in ("daily", "full")]
    assert found(days[0]) == found(days[1].select(*days[0].columns))
    assert days[0].where("event_date = DATE'2019-11-07' OR event_date IS NULL").count() == 0
    assert sorted(a["alert_id"] for a in alerts(spark, tmp_path / "daily")) == sorted(a["alert_id"] for a in alerts(spark, tmp_path / "full"))
    plan = changes.on_dates(read_after(), [dt.date(2019, 11, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "2019-11-02" in plan.split("PartitionFilters")[1]
    assert changes.on_dates(read_after(), []).count() == 0 and changes.touched_dates(None) == []


def test_load_batches_into_the_warehouse(spark, tmp_path):
    (tmp_path / "events.csv").write_text(EVENTS)
    (tmp_path / "products.csv").write_text(PRODUCTS, encoding="latin-1")
    house = warehouse.build(spark, str(tmp_path / "events.csv"), str(tmp_path / "products.csv"), str(tmp_path / "tables"), "2019-12-01 08:00:00")
    store = Visits(spark, str(tmp_path / "visits")).add_days(house.table("fact_user_events"))
    header = EVENTS.splitlines()[0]
    late = [
        "2019-11-01 23:00:00+00:00,view,12,21,furniture.kitchen.chair,x,5,9,zz",
        "2019-11-30 23:00:00+00:00,purchase,12,21,furniture.kitchen.chair,x,5,9,zz", "too,short", "2019,view,1,1,furniture.a.b,x,1,1,a,b,c",
    ]
    (tmp_path / "late.csv").write_text("\n".join([header, *late]))
    gone = house.table("fact_user_events").where("event_date = DATE'2019-11-02'")
    kept = Path(house.path("fact_user_events")) / "event_date=2019-11-03"
    untouched = sorted(f.name for f in kept.iterdir())
    dates = warehouse.load(house, str(tmp_path / "late.csv"), "2019-12-02 08:00:00", gone)
    assert dates == [dt.date(2019, 11, d) for d in (1, 2, 30)]
    assert warehouse.load(house, str(tmp_path / "late.csv"), "2019-12-02 08:00:00") == dates  # not added again
    fact = house.table("fact_user_events")
    assert {str(r[0]): r[1] for r in fact.groupBy("event_date").count().collect()} == {
        "None": 1, "2019-11-01": 4, "2019-11-03": 1, "2019-11-30": 1,
    }
    assert sorted(f.name for f in kept.iterdir()) == untouched
    same_views(store.add_days(fact, dates), fact)
    warehouse.write_checks(house, "2019-12-02")
    checks = spark.read.option("header", True).csv(str(tmp_path / "tables/checks/staging/rejected_lines/run_date=2019-12-02"))
    assert {r.reason: r.cnt for r in checks.collect()} == {"too few fields": "1", "too many fields": "1"}
    assert warehouse.load(house, None, "2019-12-03 08:00:00", fact.limit(0)) == []


def test_files_of_one_path_with_different_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [line.split(",") for line in EVENTS.splitlines() if '"' not in line]
    (folder / "a b.csv").write_text(EVENTS + 'a,b\n"x, y",view\n' + ",".join("z" * 12) + "\n\n")
    (folder / "b.csv").write_text("\n".join(",".join([*reversed(line), "more"]) for line in lines) + "\n1,2,3,4,5,6,7,8,9\n")
    (folder / "c.csv").write_text("﻿" + EVENTS.splitlines()[0] + "\n")
    (folder / "empty.csv").write_text("")
    events, rejects = readers.read_events(spark, str(folder))
    one, _ = readers.read_events(spark, str(folder / "a b.csv"))
    assert events.count() == 15 and one.count() == 8
    twice = [r for r in one.collect() if "\"" not in (r.brand or "")]
    assert found(events) == sorted(found(one) + [tuple(sorted(r.asDict().items())) for r in twice], key=repr)
    assert events.select("price").where("price = '437.33'").count() == 6
    assert sorted((r.file.split("/")[-1], r.line[:5], r.reason) for r in rejects.collect()) == [
        ("a%20b.csv", '"x, y', "too few fields"), ("a%20b.csv", "a,b", "too few fields"),
        ("a%20b.csv", "z,z,z", "too many fields"), ("b.csv", "1,2,3", "too few fields"),
    ]
    assert rejects.count() == 4
    (folder / "d.csv").write_text("event_time,price\n1,2\n")
    with pytest.raises(ValueError, match="d.csv: 0 headers"):
        readers.read_events(spark, str(folder))


def catalogue(spark, asins):
    blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.CLEAN_PRODUCTS.fields}
    frame = spark.createDataFrame([(a, f"t{n}") for n, a in enumerate(asins)], "asin STRING, title STRING")
    return shared_table(frame.select([F.col(n) if n in frame.columns else c.alias(n) for n, c in blank.items()]), "t")


def key_of(df):
    found = {}
    for row in df.collect():
        found.setdefault(row.asin, []).append(row.product_key)
    return {asin: sorted(ids) for asin, ids in found.items()}


def test_products_keep_their_keys(spark):
    empty = spark.createDataFrame([], keys.REGISTRY)
    first = catalogue(spark, ["C", "A", "B", "B", None, "E"])
    dim, registry = model.keyed_products(first, empty, "2019-12-01")
    assert dim.select("product_key", "asin", "title").collect().sort() == model.dim_products(first).select("product_key", "asin", "title").collect().sort()
    assert key_of(dim) == key_of(model.dim_products(first)) and list(dim.columns) == schemas.DIM_PRODUCTS.fieldNames()
    before = key_of(dim)

    second = catalogue(spark, ["AA", "C", "B", "A", "A", "D", None])  # E and a B are gone, four are new
    dim, registry = model.keyed_products(second, registry, "2019-12-02")
    after = key_of(dim)
    assert after["C"] == before["C"] and after[None] == before[None] and after["B"][0] in before["B"] and len(after["B"]) == 1
    assert before["A"][0] in after["A"] and sorted(set(sum(after.values(), [])) - set(sum(before.values(), []))) == [7, 8, 9]
    lines = {(r.asin, r.copy): r for r in registry.collect()}
    assert len(lines) == registry.count() == 9
    assert str(lines["E", 1].closed) == str(lines["B", 2].closed) == "2019-12-02" and lines["C", 1].closed is None
    assert str(lines["D", 1].first_seen) == "2019-12-02" and str(lines["C", 1].first_seen) == "2019-12-01"

    dim, registry = model.keyed_products(first, registry, "2019-12-03")  # all are back
    assert key_of(dim) == before
    lines = {(r.asin, r.copy): r for r in registry.collect()}
    assert lines["E", 1].closed is None and str(lines["D", 1].closed) == "2019-12-03"
    assert model.keyed_products(first.limit(0), registry, "2019-12-04")[0].count() == 0


def test_a_build_that_dies_leaves_the_last_one(spark, tmp_path, monkeypatch):
    """Whatever step is lost, readers have all tables of the build before; the next build takes over."""
    (tmp_path / "events.csv").write_text(EVENTS)
    (tmp_path / "products.csv").write_text(PRODUCTS, encoding="latin-1")
    args = (spark, str(tmp_path / "events.csv"), str(tmp_path / "products.csv"), str(tmp_path / "tables"))
    with pytest.raises(FileNotFoundError):
        warehouse.Warehouse(spark, args[3]).table("dim_date")
    warehouse.build(*args, "2019-12-01 08:00:00")

    def contents(house):
        return {name: found(house.table(name)) for name in warehouse.TABLES}

    reader = warehouse.Warehouse(spark, args[3])
    before = contents(reader)
    (tmp_path / "events.csv").write_text("\n".join(EVENTS.splitlines()[:4]))
    steps = [("replace_table", n) for n in range(7)] + [("write_csv", 0), ("write_csv", 1), ("replace_partitioned", 0)]
    for step, survives in steps[::3] + [("publish", 0)]:
        owner = versions if step == "publish" else writers
        real, calls = getattr(owner, step), []

        def dies(*a, **k):
            if len(calls) == survives:
                raise RuntimeError("lost")
            calls.append(1)
            return real(*a, **k)

        with monkeypatch.context() as patch:
            patch.setattr(owner, step, dies)
            with pytest.raises(RuntimeError):
                warehouse.build(*args, "2019-12-02 08:00:00")
        assert contents(warehouse.Warehouse(spark, args[3])) == before
    after = warehouse.build(*args, "2019-12-02 08:00:00")
    assert after.table("fact_user_events").count() == 3 and contents(reader) == before
    assert sorted(p.name for p in (tmp_path / "tables").iterdir() if p.name.startswith("v")) == [
        f"v{reader.version:08d}", f"v{after.version:08d}",
    ]
    for _ in range(2):
        warehouse.build(*args, "2019-12-03 08:00:00")
    assert versions.current(spark, args[3]) == after.version + 2
    assert not (tmp_path / f"tables/v{reader.version:08d}").exists() and Path(after.path("dim_date")).exists()


def report_frames(folder, fact):
    """The reports of a folder's stores, without a look at the events."""
    store, cells = Visits(fact.sparkSession, f"{folder}/visits"), Cells(fact.sparkSession, f"{folder}/cells")
    return {name: found(frame) for name, frame in reporting.datasets(fact, LIMITS, store, cells).items()}


def from_scratch(fact):
    return {name: found(frame) for name, frame in reporting.datasets(fact, LIMITS).items()}


def test_second_report_reads_no_event(make_fact, stored, tmp_path):
    read, folder = stored(sample(make_fact)), str(tmp_path / "report")
    wanted = from_scratch(read())
    reporting.run(read(), folder, "2019-12-01", LIMITS)
    for file in (tmp_path / "fact").rglob("*.parquet"):
        file.write_bytes(b"no table")  # whoever reads an event fails
    for file in (tmp_path / "fact").rglob(".*.crc"):
        file.unlink()
    reporting.run(read(), folder, "2019-12-02", LIMITS)
    assert report_frames(folder, read()) == wanted


def test_report_builds_the_changed_dates_alone(make_fact, stored, tmp_path, monkeypatch):
    read, folder = stored(sample(make_fact)), str(tmp_path / "report")
    reporting.run(read(), folder, "2019-12-01", LIMITS)
    cells = Cells(read().sparkSession, f"{folder}/cells")
    assert cells.outdated(partition_digests(read())) == []
    late = make_fact([dict(event_time="2019-11-03 23:00:00", user_id=900, user_session="late", price="7"), dict(event_time="bad", user_id=901)])
    late.write.mode("append").partitionBy("event_date").parquet(str(tmp_path / "fact"))
    writers.delete(read().sparkSession, f"{tmp_path}/fact/event_date=2019-11-05")
    wanted = [None, dt.date(2019, 11, 3), dt.date(2019, 11, 5)]
    assert cells.outdated(partition_digests(read())) == wanted

    with monkeypatch.context() as patch:  # a run that dies before its last step leaves the dates outdated
        patch.setattr(Visits, "add_days", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            reporting.run(read(), folder, "2019-12-02", LIMITS)
    assert cells.outdated(partition_digests(read())) == wanted
    reporting.run(read(), folder, "2019-12-02", LIMITS)
    assert cells.outdated(partition_digests(read())) == []
    assert report_frames(folder, read()) == from_scratch(read())


def test_a_fact_without_partitions_is_built_whole(make_fact, tmp_path):
    fact, folder = sample(make_fact), str(tmp_path / "report")
    assert partition_digests(shared_table(fact, "plain")) is None
    reporting.run(fact, folder, "2019-12-01", LIMITS)
    assert Cells(fact.sparkSession, f"{folder}/cells").outdated({}) is None
    assert report_frames(folder, fact) == from_scratch(fact)
