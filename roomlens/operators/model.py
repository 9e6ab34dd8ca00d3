"""Star schema: product and date dimensions, event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.operators.clean_events import calendar
from roomlens.schemas import DIM_DATE, DIM_PRODUCTS, FACT_EVENTS, conform
from roomlens.sources.scratch import shared_table


def dense_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Number all rows 1..n in the order of ``order``, without gathering them in one task.

    The rows are range-sorted and written with their file part and position; keys are position
    plus the rows of earlier parts. The written table fixes the partitioning both steps rely on.
    Copies of one row may be cut across parts, so a hot value does not make a hot part; pass a
    stored table, whose scan order is stable, so that a repeated task cuts them alike.
    """
    columns = df.columns
    ranged = df.selectExpr(
        "*", f"xxhash64({', '.join(columns)}) AS _tie", "monotonically_increasing_id() AS _spread"
    ).orderBy(order, "_tie", "_spread")
    # The id holds the part number above bit 33 and the position in the part below it.
    placed = shared_table(
        ranged.selectExpr(*columns, "monotonically_increasing_id() AS _id").selectExpr(
            *columns, "shiftright(_id, 33) AS _part", f"_id & {(1 << 33) - 1} AS _row"
        ),
        "dense-key",
    )
    offsets = (
        placed.groupBy("_part")
        .agg(F.expr("count(*) AS size"))
        .selectExpr(
            "_part",
            """coalesce(sum(size) OVER (ORDER BY _part
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _offset""",
        )
    )
    # One row per sort partition: bounded by spark.sql.shuffle.partitions.
    return placed.join(F.broadcast(offsets), "_part").selectExpr(
        f"_offset + _row + 1 AS {key}", *columns
    )


def product_attributes(clean: DataFrame) -> DataFrame:
    """The clean catalogue with stock flag and known material, not numbered."""
    return clean.selectExpr(
        "* EXCEPT (material)",
        "if(material IS NULL OR material = 'None', 'Unknown', material) AS material",
        "if(availability = 'In Stock', 1, 0) AS in_stock_flag",
    )


def dim_products(clean: DataFrame) -> DataFrame:
    """Product dimension of the stored clean catalogue: key, stock flag, known material."""
    return conform(dense_key(product_attributes(clean), "product_key", "asin"), DIM_PRODUCTS)


def keyed_products(clean: DataFrame, registry: DataFrame, run_date: str) -> tuple[DataFrame, DataFrame]:
    """Product dimension under the keys of ``registry``, and the registry after this load."""
    from roomlens.operators import keys  # numbers rows by this module

    found = keys.assign_keys(shared_table(product_attributes(clean), "products"), registry, run_date)
    return conform(found.rows, DIM_PRODUCTS), found.registry


def dim_date(clean: DataFrame) -> DataFrame:
    """One row per event date with calendar attributes.

    The attributes follow from the date, so only the date is read and made distinct.
    """
    attributed = clean.select("event_date").distinct().selectExpr(
        "*",
        *calendar("event_date"),
        "quarter(event_date) AS quarter",
        "concat('Q', quarter(event_date)) AS quarter_name",
        "INT(day(event_date) = 1) AS is_month_start",
        "INT(event_date = last_day(event_date)) AS is_month_end",
    )
    return conform(attributed, DIM_DATE).orderBy("event_date")


def fact_events(clean: DataFrame) -> DataFrame:
    """Event fact: revenue of priced purchases and one flag per funnel stage."""
    flagged = clean.selectExpr(
        "*",
        "if(event_type = 'purchase' AND is_zero_price = 0, price, 0D) AS revenue",
        "INT(coalesce(event_type = 'view', false)) AS is_view",
        "INT(coalesce(event_type = 'cart', false)) AS is_cart",
        "INT(coalesce(event_type = 'purchase', false)) AS is_purchase",
    )
    return conform(flagged, FACT_EVENTS)
