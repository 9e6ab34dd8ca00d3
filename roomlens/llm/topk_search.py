"""Exact top-k inner-product search with vector-approximation files.

Three passes: the cells alone give each query a floor, the kth greatest lower bound over all blocks;
the cells again tell which vectors reach the floor of any query; only these vectors are read and
scored, in the order of their upper bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from roomlens.llm.common import MAX_BROADCAST_BYTES, broadcast_if_small
from roomlens.sources.scratch import shared_table

SCALE = 256
BLOCK_ROWS = 4096
QUERY_ROWS = 512
CELLS = 256  # cells a component; a cell number is one byte
SLOTS = 64
_EXACT = 2.0**28  # components up to here have inner products that fit a long for 64 components
_LONG = 2**63 - 1
_HELD_BLOCKS = 64
_SCORE_END = 2.0**62  # bounds beyond tell nothing, as scores stop at the ends of a long

_BLOCK_SCHEMA = pa.schema([
    ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("grid", pa.binary()), ("cells", pa.binary()),
    ("vectors", pa.binary()),
])


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): rows with an id and a vector whose components are all present and finite."""
    return embeddings.selectExpr("BIGINT(vec_id) AS vec_id", "CAST(embedding AS array<double>) AS x").where(
        "vec_id IS NOT NULL AND x IS NOT NULL"
        " AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    )


def approximate(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid (least value and cell width of each component) and cell numbers of whole-number vectors."""
    least, most = vectors.min(axis=0), vectors.max(axis=0)
    width = np.floor((most - least) / CELLS) + 1
    cells = np.minimum(np.floor((vectors - least) / width), CELLS - 1)
    return np.stack([least, width]), cells.astype(np.uint8)


def pack(vectors: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of up to ``rows`` vectors of one length: ids, cell grid, cell numbers, exact vectors.

    Components become floor(256 * x), kept as doubles. Blocks are cut from the rows of a partition,
    so nothing is shuffled and no key can make a block large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                lists = part["x"]
                sizes = np.diff(lists.offsets.to_numpy())
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE)
                ids = part["vec_id"].to_numpy(zero_copy_only=False).astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                out = []
                for dim in np.unique(sizes):
                    chosen = np.nonzero(sizes == dim)[0]
                    values = flat[starts[chosen][:, None] + np.arange(dim)]
                    grid, cells = approximate(values)
                    out.append((int(dim), len(chosen), ids[chosen].tobytes(), grid.tobytes(), cells.tobytes(), values.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA
                )

    return vectors.mapInArrow(run, "dim int, n int, ids binary, grid binary, cells binary, vectors binary")


def bounds(queries: np.ndarray, grid: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner product of each query with each vector, by its cells alone."""
    low = grid[0] + cells * grid[1]
    high = low + (grid[1] - 1)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    lower, upper = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    slack = (1e-12 * cells.shape[1] * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).max(axis=0)))[:, None]
    slack[slack < 0.25] = 0  # whole numbers below 2 ** 52 are summed exactly
    lower = np.minimum(lower - slack, _SCORE_END)
    lower[lower < -_SCORE_END] = -np.inf
    return lower, upper + slack


def _inner(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; what does not fit a long stops at its ends."""
    if max(np.abs(query).max(initial=0), np.abs(vectors).max(initial=0)) < _EXACT and len(query) <= 64:
        return vectors.astype(np.int64) @ query.astype(np.int64)
    whole = [int(c) for c in query]
    sums = (sum(a * int(b) for a, b in zip(whole, v)) for v in vectors)
    return np.array([max(-_LONG, min(_LONG, s)) for s in sums], dtype=np.int64)


def best_in_block(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, grid: np.ndarray,
                  cells: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, and vec_ids and scores of its ``k`` best of the block that reach its floor.

    Vectors are scored in the order of their upper bounds until no bound reaches the kth best score.
    """
    lower, upper = bounds(queries, grid, cells)
    for i, query in enumerate(queries):
        other = ids != query_ids[i]
        open_ = np.nonzero(other & (upper[i] >= floors[i]))[0]
        if len(open_) > k:
            open_ = open_[upper[i][open_] >= np.partition(lower[i][open_], -k)[-k]]
        open_ = open_[np.argsort(-upper[i][open_], kind="stable")]
        found, scores, at, step = open_[:0], np.zeros(0, dtype=np.int64), 0, 4 * k
        while at < len(open_):
            if len(scores) >= k and upper[i][open_[at]] < np.partition(scores, -k)[-k]:
                break
            read = open_[at : at + step]
            found, scores = np.r_[found, read], np.r_[scores, _inner(query, vectors[read])]
            at, step = at + step, 2 * step
        order = np.lexsort((ids[found], -scores))[:k]
        yield i, ids[found][order], scores[order]


def _meet(blocks: DataFrame, asked: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """Each block of vectors with each block of queries of as many components.

    Query blocks are broadcast if their measured size allows, and otherwise dealt to a fixed number
    of slots of vector blocks.
    """
    size = " + ".join(f"octet_length({f.name})" for f in asked.schema if f.dataType.simpleString() == "binary")
    small = broadcast_if_small(asked, size, max_broadcast_bytes)
    if small is asked:  # not broadcast
        slots = F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("slot")
        return blocks.join(asked.select("*", slots), ["dim", "slot"])
    return blocks.join(small, "dim")


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    """Ids and vectors of the queries, and ids, grid and cells of the vectors, of a pair of blocks."""
    query_ids, ids, dim = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["ids"], np.int64), row["dim"]
    return (query_ids, np.frombuffer(row["queries"]).reshape(len(query_ids), dim), ids,
            np.frombuffer(row["grid"]).reshape(2, dim), np.frombuffer(row["cells"], np.uint8).reshape(len(ids), dim))


def with_floors(cells: DataFrame, asked: DataFrame, k: int, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``asked`` with ``floors``: each query's kth greatest lower bound over all cells, as doubles.

    A task gives out at most k bounds a query for the blocks it holds. A query with fewer than k
    candidates has no floor (minus infinity).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            rows = [(asked, number, low) for asked, best in held.items() for number, lows in enumerate(best) for low in lows if low > -np.inf]
            held.clear()
            columns = list(zip(*rows)) or [()] * 3
            types = (pa.int64(), pa.int32(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["asked", "number", "low"])

        for batch in batches:
            for row in batch.to_pylist():
                query_ids, queries, ids, grid, cells = _arrays(row)
                lower = np.where(query_ids[:, None] != ids, bounds(queries, grid, cells)[0], -np.inf)
                best = held.get(row["asked"])
                best = lower if best is None else np.hstack([best, lower])
                held[row["asked"]] = -np.partition(-best, k - 1, axis=1)[:, :k] if best.shape[1] > k else best
                if len(held) >= _HELD_BLOCKS:
                    yield flush()
        yield flush()

    met = _meet(cells, asked, max_broadcast_bytes).select("dim", "asked", "query_ids", "queries", "ids", "grid", "cells")
    low = Window.partitionBy("asked", "number").orderBy(F.col("low").desc())
    kth = (
        met.mapInArrow(run, "asked long, number int, low double")
        .withColumn("nth", F.row_number().over(low)).where(F.col("nth") == k)
        .groupBy("asked").agg(F.map_from_entries(F.collect_list(F.struct("number", "low"))).alias("known"))
    )
    numbers = "sequence(0, INT(octet_length(query_ids) / 8) - 1)"
    return asked.join(kth, "asked", "left").selectExpr(
        "dim", "asked", "query_ids", "queries", f"transform({numbers}, i -> coalesce(known[i], double('-infinity'))) AS floors"
    )


def wanted_vectors(cells: DataFrame, asked: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(block, bits): per block of ``cells`` a bitmap of the vectors whose upper bound reaches a query's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            some = {block: np.packbits(bits, bitorder="little").tobytes() for block, bits in held.items() if bits.any()}
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(some.keys(), pa.int64()), pa.array(some.values(), pa.binary())], names=["block", "bits"])

        for batch in batches:
            for row in batch.to_pylist():
                query_ids, queries, ids, grid, cells = _arrays(row)
                near = bounds(queries, grid, cells)[1] >= np.array(row["floors"])[:, None]
                near = (near & (query_ids[:, None] != ids)).any(axis=0)
                held[row["block"]] = near | held[row["block"]] if row["block"] in held else near
                if len(held) >= _HELD_BLOCKS:
                    yield flush()
        yield flush()

    met = _meet(cells, asked, max_broadcast_bytes).select("dim", "block", "query_ids", "queries", "floors", "ids", "grid", "cells")
    return met.mapInArrow(run, "block long, bits binary").groupBy("block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


def read_wanted(blocks: DataFrame, wanted: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``blocks`` cut to the vectors of ``wanted``; blocks without any go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")[: row["n"]].astype(bool)
                cut = [np.frombuffer(row["ids"], np.int64)[bits].tobytes(), row["grid"]]
                cut += [np.frombuffer(row[c], t).reshape(row["n"], row["dim"])[bits].tobytes() for c, t in (("cells", np.uint8), ("vectors", float))]
                out.append((row["dim"], int(bits.sum()), *cut, row["slot"]))
            columns = list(zip(*out)) or [()] * 7
            schema = _BLOCK_SCHEMA.append(pa.field("slot", pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    small = broadcast_if_small(wanted, "octet_length(bits)", max_broadcast_bytes)
    return blocks.join(small, "block").select(*_BLOCK_SCHEMA.names, "slot", "bits").mapInArrow(
        run, "dim int, n int, ids binary, grid binary, cells binary, vectors binary, slot int"
    )


def search_tables(embeddings: DataFrame, every: int, k: int, max_broadcast_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All blocks, the query blocks with their floors, and the blocks cut to the vectors to read."""
    vectors = valid_vectors(embeddings)
    blocks = shared_table(
        pack(vectors).withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(SLOTS)).cast("int")).withColumn("block", F.monotonically_increasing_id()),
        "va-blocks",
    )
    cells = blocks.drop("vectors", "n")
    asked = shared_table(
        pack(vectors.where(f"vec_id % {every} = 0").distinct(), QUERY_ROWS)
        .select("dim", F.monotonically_increasing_id().alias("asked"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")),
        "va-queries",
    )
    asked = shared_table(with_floors(cells, asked, k, max_broadcast_bytes), "va-floors")
    wanted = shared_table(wanted_vectors(cells, asked, max_broadcast_bytes), "va-wanted")
    return blocks, asked, shared_table(read_wanted(blocks, wanted, max_broadcast_bytes), "va-read")


def top_k(embeddings: DataFrame, every: int = 50, k: int = 5, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query vector.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another
    vec_id and as many components; components count as floor(256 * x). Equal scores go to the
    smaller vec_id. Blocks of queries meet blocks of cells twice, then the exact vectors that some
    query needs. A task keeps k rows per query. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part; rows equal in id and vector are one query but
    several candidates; a score outside the range of a long stops at its end; other columns, texts
    of any length among them, are ignored; no vectors or no queries give no rows.
    """
    _, asked, read = search_tables(embeddings, every, k, max_broadcast_bytes)
    met = _meet(read, asked, max_broadcast_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes, bytes], list] = {}

        def flush() -> pa.RecordBatch:
            columns: list[list] = [[], [], [], []]
            for (_, query_ids, data), best in held.items():
                for number, (query_id, (vec_ids, scores)) in enumerate(zip(np.frombuffer(query_ids, np.int64).tolist(), best)):
                    row = _query_key(data, number, len(best))
                    columns[0] += [query_id] * len(vec_ids)
                    columns[1] += [row] * len(vec_ids)
                    columns[2] += vec_ids.tolist()
                    columns[3] += scores.tolist()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_key", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                query_ids, queries, ids, grid, cells = _arrays(row)
                key = (row["dim"], row["query_ids"], row["queries"])
                best = held.setdefault(key, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids))
                parts = best_in_block(
                    query_ids, queries, np.array(row["floors"]), ids, grid, cells,
                    np.frombuffer(row["vectors"]).reshape(len(ids), row["dim"]), k,
                )
                for i, vec_ids, scores in parts:
                    vec_ids, scores = np.r_[best[i][0], vec_ids], np.r_[best[i][1], scores]
                    order = np.lexsort((vec_ids, -scores))[:k]
                    best[i] = (vec_ids[order], scores[order])
                if len(held) >= _HELD_BLOCKS:
                    yield flush()
        yield flush()

    local = met.mapInArrow(run, "query_id long, query_key long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _query_key(data: bytes, number: int, count: int) -> int:
    """Tells query vectors of equal ids apart."""
    size = len(data) // max(1, count)
    return xxhash.xxh3_64_intdigest(data[number * size : (number + 1) * size]) >> 1
