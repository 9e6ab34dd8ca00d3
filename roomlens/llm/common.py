"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_BROADCAST_BYTES = 64 << 20
HASHED_ROW_BYTES = 96  # of a broadcast row of a few numbers: itself, its key, its length and its share of the hash table
BATCH_ROWS = 1000
OUTPUT_BYTES = 8 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Settings for rows that hold whole texts; call once on a session.

    A batch of Spark's usual 10,000 documents is tens of megabytes, held several times over on its
    way to a Python worker and back. Results do not depend on the size of a batch.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def broadcast_if_small(stored: DataFrame, row_bytes: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``stored`` with a broadcast hint if its measured size allows; else left to a shuffled join.

    ``row_bytes`` is an SQL expression for the bytes of one row. ``stored`` should be a written
    table, as measuring reads it once.
    """
    total = stored.select(F.sum(F.expr(row_bytes))).first()[0] or 0
    return F.broadcast(stored) if total <= max_bytes else stored


def emit_batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``OUTPUT_BYTES`` from rows, so that long rows don't pile up."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= OUTPUT_BYTES:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_slices(batches: Iterable[pa.RecordBatch], column: str, size: int = OUTPUT_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece has about ``size`` bytes of ``column``, or a single row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(lengths) // size
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if end > start:
                yield batch.slice(start, end - start)
