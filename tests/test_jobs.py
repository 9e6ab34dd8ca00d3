from __future__ import annotations

import pytest

from roomlens import __main__ as command_line, schemas
from roomlens.plans import detection, insights, profile, reporting, warehouse
from roomlens.sources import readers, scratch, writers
from roomlens.thresholds import Thresholds

EVENTS = """event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session
2019-11-01 00:00:03+00:00,view,11,20,furniture.living_room.sofa,,437.33,1,aa
2019-11-01 00:01:00+00:00,cart,11,20,furniture.living_room.sofa,,437.33,1,aa
2019-11-01 00:02:00+00:00,purchase,11,20,furniture.living_room.sofa,,437.33,1,aa
2019-11-02 10:00:00+00:00,view,12,21,furniture.kitchen.chair,"ac""me, inc",0.00,2,bb
2019-11-03 11:00:00+00:00,view,12,21,furniture.kitchen.chair,None,31.64,2,cc
bad time,view,13,21,furniture.kitchen.table,x,abc,3,dd
2019-11-03 11:00:00+00:00,view,99,21,electronics.phone,x,5,3,dd
2019-11-03 11:00:00+00:00,view,98,21,,x,5,3,dd
"""

PRODUCTS = """asin,title,brand,price,availability,categories,material,color,style,country_of_origin,date_first_available,package_dimensions,manufacturer,extra
A2,"Caf\xe9 table, ""round""
with leaf",Acme Store,"$1,049.99",In Stock,"['Home & Kitchen', 'Furniture', 'Tables']",engineered wood,Oak,,,"January 5, 2020",,Acme,x
A1,Chair,,,,"['Home & Kitchen', 'Furniture', 'Tables']",,,,,2020-01-06,,,x
A3,Sheet,Bed Store,$5,In Stock,"['Home & Kitchen', 'Bedding', 'Sheets']",,,,,,,,x
"""


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("house")
    (folder / "events.csv").write_text(EVENTS)
    (folder / "products.csv").write_text(PRODUCTS, encoding="latin-1")

    def build():
        return warehouse.build(
            spark, str(folder / "events.csv"), str(folder / "products.csv"),
            str(folder / "tables"), "2019-12-01 08:00:00",
        )

    return build


@pytest.fixture(scope="module")
def built(house):
    return house()


def table_rows(house):
    return {r["table_name"]: r["row_count"] for r in warehouse.table_counts(house).collect()}


def test_warehouse_from_csv(built, rows):
    assert table_rows(built) == dict(
        stg_user_events=6, stg_products=3, clean_user_events=6, clean_products=2, dim_products=2,
        dim_date=4, fact_user_events=6,
    )
    fact = built.table("fact_user_events")
    assert fact.columns == schemas.FACT_EVENTS.fieldNames()
    found = rows(fact.orderBy("user_id", "event_time"))
    assert sum(r["revenue"] for r in found) == 437.33
    assert [r["brand"] for r in found] == ["Unknown"] * 3 + ['ac"me, inc', "Unknown", "x"]
    assert found[-1]["event_date"] is None and found[-1]["price"] == 0.0
    products = rows(built.table("dim_products").orderBy("product_key"))
    assert [(p["product_key"], p["asin"], p["price"]) for p in products] == [
        (1, "A1", 1049.99), (2, "A2", 1049.99),
    ]
    assert products[1]["title"] == 'Caf\xe9 table, "round"\nwith leaf'
    assert products[0]["brand"] == "None" and products[0]["material"] == "Unknown"


def test_rerun_is_idempotent(house, built):
    first = table_rows(built)
    assert table_rows(house()) == first


def test_date_filter_prunes_partitions(built):
    fact = built.table("fact_user_events").where("event_date = DATE '2019-11-01'")
    assert fact.count() == 3
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_columns_are_taken_by_name(spark, tmp_path, rows):
    lines = [line.split(",") for line in EVENTS.splitlines() if '"' not in line]
    (tmp_path / "e.csv").write_text("\n".join(",".join([*reversed(line), "more"]) for line in lines))
    found = rows(readers.read_events_csv(spark, str(tmp_path / "e.csv")))
    assert list(found[0]) == schemas.RAW_EVENTS.fieldNames() and found[0]["price"] == "437.33"


def test_header_mismatch_fails(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b,c\n1,2,3\n")
    with pytest.raises(Exception, match="header|HEADER|schema|column"):
        readers.read_events_csv(spark, str(tmp_path / "e.csv")).collect()


LIMITS = Thresholds(
    zero_purchase_min_views=1, min_views_for_analysis=1, brand_min_views=0, gap_view_min_views=0,
    room_min_views=0, gap_min_views=1,
)


def test_jobs_write_their_outputs(built, spark, tmp_path):
    fact = built.table("fact_user_events")
    reporting.run(fact, str(tmp_path / "report"), "2019-12-01", LIMITS)
    sheet = spark.read.option("header", True).csv(str(tmp_path / "report/kpi_summary"))
    assert {r["metric"]: r["value"] for r in sheet.collect()}["Total Revenue"] == "$437"
    funnel = spark.read.option("header", True).csv(str(tmp_path / "report/funnel_data"))
    assert "Pct Of Total" in funnel.columns
    assert spark.sql("SELECT count(*) FROM vw_daily_trend").first()[0] == 4

    insights.run(fact, str(tmp_path / "insights"), "2019-12-01", LIMITS)
    best = spark.read.option("header", True).csv(str(tmp_path / "report/q_best_rooms"))
    assert best.count() > 0 and "cvr_pct" in best.columns
    for name in (*insights.EXPORTS, "findings"):
        assert spark.read.option("header", True).csv(str(tmp_path / "insights" / name)).count() > 0

    summary = detection.run(fact, str(tmp_path / "alerts"), "2019-12-01", "2019-12-01 08:00:00", LIMITS)
    logged = spark.read.text(str(tmp_path / "alerts/alert_log")).count()
    assert summary.first()["total_alerts"] == logged > 0


def test_daily_detection_reads_the_new_day_only(built, spark, tmp_path):
    fact = built.table("fact_user_events")
    args = ("2019-12-01", "2019-12-01 08:00:00", LIMITS)
    whole = detection.run(fact, str(tmp_path / "whole"), *args).first()
    detection.run(fact.where("event_date < DATE '2019-11-03'"), str(tmp_path / "daily"), *args)
    new = fact.where("event_date IS NULL OR event_date >= DATE '2019-11-03'")
    assert detection.run(new, str(tmp_path / "daily"), *args, since="2019-11-03").first() == whole
    stored = spark.read.parquet(str(tmp_path / "daily/product_days"))
    assert stored.agg({"events": "sum"}).first()[0] == fact.count()


def test_report_scans_the_fact_three_times(built):
    fact = built.table("fact_user_events")
    frames = reporting.datasets(fact, LIMITS)
    read = [f.inputFiles() for n, f in frames.items() if n.startswith("vw_")]
    # Besides the two stored aggregates: the product list.
    assert sum(any("/fact_user_events/" in file for file in files) for files in read) == 1


def test_scratch_folder_needs_a_shared_setting(spark):
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

    class Conf:
        value = None

        def get(self, key, default):
            return self.value

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(Session())
    Session.conf.value = "hdfs://shared/dir/"
    assert scratch.scratch_folder(Session()) == "hdfs://shared/dir/roomlens/app-1"


def test_shared_tables_are_dropped(spark):
    scratch.shared_table(spark.range(3), "t")
    scratch.drop_shared_tables(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch.scratch_folder(spark))
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_csv_round_trip_keeps_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c\\', 1)], "t STRING, n INT")
    writers.write_csv(df, str(tmp_path / "x"), single_file=True)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "x"))
    assert back.first()["t"] == 'a "b", c\\'


def test_profile_job(built, spark, rows, tmp_path):
    (tmp_path / "events.csv").write_text(EVENTS)
    (tmp_path / "products.csv").write_text(PRODUCTS, encoding="latin-1")
    raw = scratch.shared_table(readers.read_events_csv(spark, str(tmp_path / "events.csv")), "raw")
    frames = profile.raw_events(raw)
    assert rows(frames["furniture_share"])[0]["kept_pct"] == 75.0
    nulls = {r["column_name"]: r["null_count"] for r in rows(frames["furniture_key_nulls"])}
    assert nulls == dict(user_id=0, product_id=0, category_code=0, price=0, brand=4)
    assert rows(frames["furniture_prices"])[0]["count"] == 5
    catalogue = profile.raw_products(readers.read_products_csv(spark, str(tmp_path / "products.csv")))
    assert rows(catalogue["main_categories"])[0] == {"value": "Furniture", "row_count": 2}
    checks = profile.staging_checks(built.table("stg_user_events"), built.table("stg_products"))
    assert rows(checks["zero_prices"], "zero_price_events") == [2]
    clean = profile.clean_tables(
        built.table("clean_user_events"), built.table("stg_products"), built.table("clean_products")
    )
    assert rows(clean["summary"])[0]["null_event_time_rows"] == 1
    for frame in (*frames.values(), *catalogue.values(), *checks.values(), *clean.values()):
        assert frame.count() >= 1


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "events.csv").write_text(EVENTS)
    (tmp_path / "products.csv").write_text(PRODUCTS, encoding="latin-1")
    raw = ["--events", str(tmp_path / "events.csv"), "--products", str(tmp_path / "products.csv")]
    root = ["--root", str(tmp_path / "tables")]
    command_line.main(["warehouse", *raw, *root, "--run-ts", "2019-12-01 08:00:00"])
    assert "fact_user_events |6" in capsys.readouterr().out
    out = ["--out", str(tmp_path / "out"), "--run-date", "2019-12-01"]
    command_line.main(["detect", *root, *out, "--run-ts", "2019-12-01 08:00:00"])
    assert "revenue_at_risk" in capsys.readouterr().out
    (tmp_path / "late.csv").write_text("\n".join(EVENTS.splitlines()[:2]))
    capsys.readouterr()
    command_line.main(["load", "--events", str(tmp_path / "late.csv"), *root, "--run-ts", "2019-12-02 08:00:00"])
    touched = capsys.readouterr().out.strip().splitlines()[-1]
    assert touched == "2019-11-01"
    command_line.main(["detect", *root, *out, "--run-ts", "2019-12-02 08:00:00", "--dates", touched])
    command_line.main(["report", *root, *out])
    command_line.main(["report", *root, *out, "--dates", touched])
    assert command_line.dates("none,2019-11-02")[0] is None
    read = spark.read.option("header", True)
    sheet = {r.metric: r.value for r in read.csv(str(tmp_path / "out/kpi_summary/run_date=2019-12-01")).collect()}
    assert sheet["Total Views"] == "5" and sheet["Unique Users"] == "3"
    checks = read.csv(str(tmp_path / "tables/checks/staging/zero_prices/run_date=2019-12-01"))
    assert checks.first()["zero_price_events"] == "2"
    assert read.csv(str(tmp_path / "tables/checks/clean/rooms/run_date=2019-12-01")).count() == 2

    many = "\n".join(f"2019-11-01 00:00:03+00:00,view,{i},20,furniture.r{i}.x,,1,1,aa" for i in range(80))
    (tmp_path / "many.csv").write_text(EVENTS + many)
    raw[1] = str(tmp_path / "many.csv")
    command_line.main(["profile", *raw, *out])
    for name in ("events/shape", "events/furniture_dates", "products/prices", "products/materials"):
        assert read.csv(str(tmp_path / "out" / name)).count() >= 1
    whole = read.csv(str(tmp_path / "out/events/furniture_categories/run_date=2019-12-01"))
    assert whole.count() > 80
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch.scratch_folder(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not files.exists(folder) or not any("scope-" in str(f.getPath()) for f in files.listStatus(folder))
    assert command_line.parser().parse_args(["report", *root, *out]).job == "report"
