from __future__ import annotations

import pytest

from roomlens.session import local_session

SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "roomlens-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Collect a frame as dicts, or as one value list when a column is named."""

    def collect(df, column=None):
        found = [row.asDict(recursive=True) for row in df.collect()]
        return found if column is None else [row[column] for row in found]

    return collect




@pytest.fixture(scope="session")
def make_events(spark):
    """Raw typed events from (type, product, price, time) tuples, with optional fields."""

    def build(records):
        data = []
        for record in records:
            base = dict(
                event_time="2019-11-04 10:00:00", event_type="view", product_id=1, category_id=7,
                category_code="furniture.kitchen.chair", brand="acme", price="10.0", user_id=1,
                user_session="s1",
            )
            base.update(record)
            data.append(tuple(base.values()))
        return spark.createDataFrame(
            data,
            "event_time STRING, event_type STRING, product_id BIGINT, category_id BIGINT, "
            "category_code STRING, brand STRING, price STRING, user_id BIGINT, user_session STRING",
        )

    return build


@pytest.fixture(scope="session")
def make_fact(make_events):
    from roomlens.operators.clean_events import clean_events
    from roomlens.operators.model import fact_events

    return lambda records: fact_events(clean_events(make_events(records)))


def events(event_type, count, **fields):
    return [{"event_type": event_type, **fields} for _ in range(count)]
