"""ETL job: raw CSV files to the stored star schema."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roomlens import schemas
from roomlens.operators import changes, clean_events, clean_products, keys, model, profiling, staging
from roomlens.plans import profile
from roomlens.session import configure
from roomlens.sources import readers, versions, writers
from roomlens.sources.scratch import shared_table

REJECTS = "file STRING, line STRING, reason STRING"


@dataclass(frozen=True)
class Warehouse:
    """Where the tables lie; each is read back with its declared schema.

    Without a version given, that of the last finished build is looked up once, so all tables read
    through one object belong together, whatever is built meanwhile.
    """

    spark: SparkSession
    root: str
    version: int | None = None

    def __post_init__(self) -> None:
        if self.version is None:
            object.__setattr__(self, "version", versions.current(self.spark, self.root))

    def path(self, table: str) -> str:
        if self.version is None:
            raise FileNotFoundError(f"{self.root}: no build has finished")
        return f"{versions.folder(self.root, self.version)}/{table}"

    def table(self, name: str) -> DataFrame:
        return readers.read_table(self.spark, self.path(name), TABLES[name])

    def key_registry(self) -> DataFrame:
        """Keys given to products so far; none before the first build."""
        if self.version is None:
            return self.spark.createDataFrame([], keys.REGISTRY)
        return self.spark.read.schema(keys.REGISTRY).parquet(self.path("product_keys"))

    def checks(self, stage: str) -> str:
        """Folder of dated check results, which are kept over all versions."""
        return f"{self.root.rstrip('/')}/checks/{stage}"


TABLES = {
    "stg_user_events": schemas.STG_EVENTS,
    "stg_products": schemas.STG_PRODUCTS,
    "clean_user_events": schemas.CLEAN_EVENTS,
    "clean_products": schemas.CLEAN_PRODUCTS,
    "dim_products": schemas.DIM_PRODUCTS,
    "dim_date": schemas.DIM_DATE,
    "fact_user_events": schemas.FACT_EVENTS,
}


def build(
    spark: SparkSession, events_csv: str, products_csv: str, root: str, run_ts: str
) -> Warehouse:
    """Extract, stage, clean and model; every table is built anew, so a rerun is idempotent.

    Each step reads the stored table of the step before, which keeps lineage short. All tables are
    written into a new version of the root, which becomes the current one in a single step at the end:
    a build that dies anywhere leaves the tables of the last one. Products keep their keys.
    """
    configure(spark)
    before = Warehouse(spark, root)
    house = Warehouse(spark, root, versions.begin(spark, root))
    raw_products = readers.read_products_csv(spark, products_csv)
    extract = house.path("furniture_events_csv")
    events, rejects = readers.read_events(spark, events_csv)
    writers.write_csv(staging.furniture_only(events), extract)
    writers.replace_table(rejects, house.path("rejected_events"))
    writers.write_csv(
        clean_products.product_preview(raw_products), house.path("products_clean_preview_csv")
    )

    # The extract holds a small share of the export, so it is read instead of the export again.
    staged = staging.stage_events(readers.read_events_csv(spark, extract), run_ts)
    writers.replace_table(staged, house.path("stg_user_events"))
    writers.replace_table(staging.stage_products(raw_products, run_ts), house.path("stg_products"))

    writers.replace_table(
        clean_events.clean_events(house.table("stg_user_events")), house.path("clean_user_events")
    )
    writers.replace_table(
        clean_products.clean_products(house.table("stg_products")), house.path("clean_products")
    )

    clean = house.table("clean_user_events")
    products, registry = model.keyed_products(house.table("clean_products"), before.key_registry(), run_ts[:10])
    writers.replace_table(products, house.path("dim_products"))
    writers.replace_table(registry, house.path("product_keys"))
    writers.replace_table(model.dim_date(clean), house.path("dim_date"))
    writers.replace_partitioned(
        model.fact_events(clean), house.path("fact_user_events"), "event_date"
    )
    versions.publish(spark, root, house.version)
    return house


def load(
    house: Warehouse, events_csv: str | None, run_ts: str, deleted: DataFrame | None = None
) -> list[date | None]:
    """Add a batch of events to the fact, and take ``deleted`` rows of the fact away; return the dates touched.

    Only the partitions of these dates are read and written anew, whatever dates the batch holds; dates
    left without an event go. The batch's lines that are no events replace the rejects. A batch is known by
    its ``run_ts``: one that was loaded to the end is not loaded again, and tells its dates.
    """
    configure(house.spark)
    batch = house.path("load_batches/" + "".join(filter(str.isdigit, run_ts)))
    if writers.exists(house.spark, f"{batch}/_SUCCESS"):
        stored = house.spark.read.schema("event_date DATE").parquet(batch)
        return changes.touched_dates(stored)
    inserted = None
    if events_csv is not None:
        events, rejects = readers.read_events(house.spark, events_csv)
        writers.replace_table(rejects, house.path("rejected_events"))
        staged = staging.stage_events(staging.furniture_only(events), run_ts)
        inserted = shared_table(model.fact_events(clean_events.clean_events(staged)), "load-batch")
    dates = changes.touched_dates(inserted, deleted)
    fact = house.table("fact_user_events")
    # Stored before its own partitions are exchanged.
    rows = shared_table(changes.changed(changes.on_dates(fact, dates), inserted, deleted), "load-dates")
    if dates:
        writers.replace_partitions(rows, house.path("fact_user_events"), "event_date", values=dates, stored=True)
    house.spark.catalog.refreshByPath(house.path("fact_user_events"))
    writers.replace_table(house.spark.createDataFrame([(day,) for day in dates], "event_date DATE").coalesce(1), batch)
    return dates


def write_checks(house: Warehouse, run_date: str) -> None:
    """Data-quality checks of the staging tables and profiles of the clean ones, below ``checks``."""
    products = house.table("stg_products")
    profile.write(
        profile.staging_checks(house.table("stg_user_events"), products), house.checks("staging"), run_date
    )
    rejects = house.spark.read.schema(REJECTS).parquet(house.path("rejected_events"))
    profile.write({"rejected_lines": profiling.rejected_lines(rejects)}, house.checks("staging"), run_date)
    clean = profile.clean_tables(
        house.table("clean_user_events"), products, house.table("clean_products")
    )
    profile.write(clean, house.checks("clean"), run_date)


def table_counts(house: Warehouse) -> DataFrame:
    return profiling.table_counts({name: house.table(name) for name in TABLES})
