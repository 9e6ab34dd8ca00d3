"""CSV and Parquet inputs."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from roomlens.functions.text import literal
from roomlens.schemas import RAW_EVENTS, RAW_PRODUCTS

# Field texts that mean "missing" in the CSV dialect of the raw files.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _blank_missing(df: DataFrame) -> DataFrame:
    return df.select(
        [F.when(~F.col(name).isin(*MISSING_TEXT), F.col(name)).alias(name) for name in df.columns]
    )


def file_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a path by the column names of their header line.

    A line that names all columns of the events is a header, in whatever order and among other names.
    One distributed pass over the lines, without parsing them; one row a file reaches the driver, as
    in a file listing. A file without such a line fails.
    """
    names = " AND ".join(f"contains(value, {literal(name)})" for name in RAW_EVENTS.fieldNames())
    # A set of texts is aggregated by hash; the least text would need all lines sorted.
    found = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.expr(f"collect_set(if({names}, value, NULL)) AS headers")
    )
    files: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(found.collect(), key=lambda r: r.file):
        named = [tuple(n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]))) for header in row.headers]
        named = [n for n in named if set(RAW_EVENTS.fieldNames()) <= set(n)]
        if len(named) != 1:
            raise ValueError(f"{row.file}: {len(named)} headers with the columns of events")
        files.setdefault(named[0], []).append(unquote(row.file))
    return files


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Clickstream export as (events, rejects): a header row a file, every field as text.

    Columns are taken by name from each file's own header, so files of one path may order them
    differently and hold others besides. A line with fewer or more fields than its header is no event;
    rejects holds it with its file and the reason. Files stay splittable: one line is one record.
    """
    events, rejects = [], []
    for names, files in file_headers(spark, path).items():
        schema = ", ".join(f"`c{i}` string" for i in range(len(names))) + ", `_line` string"
        raw = (
            spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(files)
        )
        place = {name: i for i, name in reversed(list(enumerate(names)))}
        # Written so that it reads a column besides the line, and is not pushed into the parser: there
        # the line is not set yet.
        line = "coalesce(_line, substr(c0, 1, 0), '')"
        events.append(raw.where(f"{line} = ''").select([F.col(f"c{place[n]}").alias(n) for n in RAW_EVENTS.fieldNames()]))
        count = r"""size(split(regexp_replace(_line, r'"([^"]|"")*"', ''), ','))"""
        fields = f"if({count} < {len(names)}, 'too few fields', 'too many fields') AS reason"
        rejects.append(raw.where(f"{line} <> ''").selectExpr("_metadata.file_path AS file", "_line AS line", fields))
    return _blank_missing(reduce(DataFrame.unionAll, events)), reduce(DataFrame.unionAll, rejects)


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """The events of ``read_events``."""
    return read_events(spark, path)[0]


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue export: Latin-1, quoted free text that may hold commas, quotes and newlines.

    Columns are taken by name from the header, so files with extra columns are accepted.
    """
    raw = (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return _blank_missing(raw.select([F.col(name) for name in RAW_PRODUCTS.fieldNames()]))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table; with ``schema`` no file footer is read and the column order is kept."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
