"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.sources.scratch import shared_table

MAX_ROUNDS = 60


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u").join(F.broadcast(least) if small else least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(F.broadcast(least) if small else least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, label: str = "components", max_broadcast_bytes: int = 0) -> DataFrame:
    """Return (node, root) for every node of ``edges`` (two columns of one orderable type).

    Alternates large-star and small-star contractions until the edges are stars around the smallest
    node of each component. A round is two aggregations with partial minima and two joins, which
    adaptive execution splits when a node has very many links; no group is gathered in a task, and
    every round is a written table. Minima that take up to ``max_broadcast_bytes`` are sent to the edges
    instead, which saves most of a small graph's shuffles. Nulls and self-links are ignored; no edges give no rows.
    """
    a, b = edges.columns[:2]
    state = shared_table(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v").distinct(),
        label,
    )
    before = _state(state)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        small = 32 * before[0] <= max_broadcast_bytes  # up to two nodes an edge, 16 bytes each
        state = shared_table(_small_star(_large_star(state, small), small).distinct(), label)
        after = _state(state)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"{label}: no fixed point after {MAX_ROUNDS} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
