from __future__ import annotations

import math
import random

import numpy as np
import pytest

from roomlens.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, every, k):
    whole = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        whole.append((vec_id, tuple(int(math.floor(256 * float(np.float32(c)))) for c in vector)))
    out = []
    for query_id, query in sorted({v for v in whole if v[0] % every == 0}):
        scored = sorted(
            (-sum(a * b for a, b in zip(query, v)), i) for i, v in whole if i != query_id and len(v) == len(query)
        )
        out += [(query_id, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def outcome(df, **options):
    return sorted(tuple(r) for r in topk_search.top_k(df, every=10, **options).select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for i in range(500):
        kind = rng.random()
        vector = (
            [0.5, -0.25, 1.0] if kind < 0.3 else None if kind < 0.35 else [1.0, None, 2.0] if kind < 0.4
            else [math.nan, 1.0, 2.0] if kind < 0.45 else [math.inf, 1.0, 2.0] if kind < 0.5
            else [rng.gauss(0, 1)] * 2 if kind < 0.55 else [] if kind < 0.6
            else [rng.gauss(0, 1e6) for _ in range(3)] if kind < 0.65 else [rng.gauss(0, 1) for _ in range(3)]
        )
        out.append((None if i % 97 == 5 else i, vector))
    return out + out[:40]  # repeated rows


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_equals_brute_force(spark, rows, broadcast):
    found = outcome(spark.createDataFrame(rows, SCHEMA), max_broadcast_bytes=broadcast)
    assert found == expected(rows, 10, 5)


def test_fewer_candidates_than_k_and_empty(spark):
    few = [(10, [1.0, 2.0]), (20, [0.5, 0.5]), (3, [1.0, 1.0])]
    assert outcome(spark.createDataFrame(few, SCHEMA)) == expected(few, 10, 5)
    assert outcome(spark.createDataFrame([], SCHEMA + ", n int, dim string")) == []


def test_huge_components_stop_at_the_ends_of_a_long(spark):
    big = [(10, [3e38, 1.0]), (11, [3e38, 1.0]), (12, [-3e38, 0.0])]
    assert [(r[2], r[3]) for r in outcome(spark.createDataFrame(big, SCHEMA))] == [(11, 2**63 - 1), (12, -(2**63) + 1)]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(0, 60, (500, 16)))
    queries = np.floor(rng.normal(0, 60, (20, 16)))
    grid, cells = topk_search.approximate(vectors)
    lower, upper = topk_search.bounds(queries, grid, cells)
    exact = queries @ vectors.T
    assert (lower <= exact).all() and (exact <= upper).all()
    kth = np.partition(lower, -5, axis=1)[:, -5]
    assert (upper >= kth[:, None]).mean() < 0.1  # most exact vectors are never read


def test_few_exact_vectors_are_read(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    blocks, asked, read = topk_search.search_tables(embeddings, 50, 5, 1 << 20)
    whole, some = (t.selectExpr("sum(n)").first()[0] for t in (blocks, read))
    assert 0 < some < whole / 10
    floors = [f for r in asked.collect() for f in r.floors]
    found = topk_search.top_k(embeddings)
    kth = [r.score for r in found.where("rank = 5").collect()]
    assert len(floors) == len(kth) and sum(floors) <= sum(kth) and min(floors) > -math.inf


def test_first_passes_read_no_exact_vectors(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    blocks, asked, _ = topk_search.search_tables(df, 10, 5, 1 << 20)
    for plan in (topk_search.with_floors(blocks.drop("vectors"), asked.drop("floors"), 5), topk_search.wanted_vectors(blocks.drop("vectors"), asked)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "cells" in text and not any("vectors" in line for line in text.splitlines() if "FileScan" in line)


def test_many_copies_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search.pack, "__defaults__", (7,))
    same = [(i, [1.0, 2.0, -1.0]) for i in range(60)] + [(i, [float(i % 7), 1.0, 0.5]) for i in range(60, 120)]
    assert outcome(spark.createDataFrame(same, SCHEMA)) == expected(same, 10, 5)
