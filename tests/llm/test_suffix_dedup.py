from __future__ import annotations

import random

import numpy as np
import pytest

from roomlens.llm import suffix_dedup
from roomlens.llm.induced_sort import InducedSort
from tests.conftest import SMALL_DIR
from tests.llm import brute


def outcome(df):
    return {
        r.doc_id: (r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), bytes(r.kept))
        for r in suffix_dedup.remove_repeats(df).collect()
    }


def shared(a: bytes, b: bytes, depth: int) -> int:
    return next((i for i in range(depth) if i >= min(len(a), len(b)) or a[i] != b[i]), depth)


@pytest.mark.parametrize("seed", range(60))
def test_induced_sort_orders_and_measures(seed):
    rng = random.Random(seed)
    letters = rng.choice([1, 2, 3, 26, 254])
    text = bytes(rng.randrange(1, letters + 1) for _ in range(rng.randint(1, 200)))
    if rng.random() < 0.4:
        text = (text[: rng.randint(1, len(text))] * 9)[:250]
    depth = rng.choice([5, 8, 13, 100])
    memory = rng.choice([1, 300, 1 << 20])  # the small ones go to disk all the time
    buckets = list(InducedSort(np.frombuffer(text, np.uint8), depth, memory).buckets())[::-1]
    order = [p for positions, _ in buckets for p in positions.tolist()]
    common = [c for _, values in buckets for c in values.tolist()]
    assert sorted(order) == list(range(len(text)))
    prefixes = [text[p : p + depth] for p in order]
    assert prefixes == sorted(prefixes)
    assert common == [0] + [shared(text[a:], text[b:], depth) for a, b in zip(order, order[1:])]


def test_given_documents(spark):
    df = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "text")
    assert outcome(df) == brute.repeats([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("piece, shard", [(None, None), (333, None), (None, 1)])
def test_planted_repeats(spark, monkeypatch, piece, shard):
    if piece:
        monkeypatch.setattr(suffix_dedup, "_PIECE", piece)
    if shard:
        monkeypatch.setattr(suffix_dedup.shard_repeats, "__defaults__", (shard, 64))
    rng = random.Random(5)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(50, 400))) for _ in range(12)]
    rows = []
    for i in range(160):
        kind, one = rng.random(), rng.choice(base)
        cut = rng.randint(0, len(one))
        rows.append((i, (
            "".join(rng.choice(base) for _ in range(3)) if kind < 0.3 else f"x{i}{one[cut:]}{one[:cut]}" if kind < 0.5
            else "a" * rng.randint(0, 600) if kind < 0.6 else "ab" * rng.randint(0, 300) if kind < 0.65
            else None if kind < 0.7 else "".join(rng.choice("abc") for _ in range(rng.randint(0, 300)))
        )))
    assert outcome(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows)


def test_large_span_tables_are_not_broadcast(spark):
    rows = [(i, "".join(chr(97 + (i % 3 + 1) * j * j % 23) + str(j) for j in range(90))) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df, max_broadcast_bytes=0).collect()}
    assert found == {d: kept for d, (*_, kept) in brute.repeats(rows).items()}


def test_edges(spark):
    one = "".join(chr(97 + i * i % 23) + str(i) for i in range(80))
    schema = "doc_id long, text string, doc string, place int"
    assert outcome(spark.createDataFrame([], schema)) == {}
    rows = [(2, one, "d", 1), (1, "x" + one, "d", 2), (3, None, None, None), (4, "", "d", 3), (5, one[:99], "d", 4)]
    found = outcome(spark.createDataFrame(rows, schema))
    assert found[1][1] == 0 and found[2][3] == b"" and found[2][2] == 1
    assert found[3] == found[4] == (0, 0, 0, b"") and found[5][1] == 0


def test_rows_that_share_an_id(spark):
    one = "".join(chr(97 + i * i % 23) + str(i) for i in range(80))
    rows = [(1, one), (1, one), (1, "other " + one), (None, "null " + one), (2, one)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 5
    by_id = {}
    for row in found:
        by_id.setdefault(row.doc_id, []).append(bytes(row.kept).decode())
    assert by_id[None] == ["null " + one]  # a null id is the smallest
    assert sorted(by_id[1]) == ["", "", "other"] and by_id[2] == [""]


def test_crowded_grams_are_split(spark, monkeypatch):
    """One phrase in many surroundings: its gram never meets in one shard, and the result is the same."""
    rng = random.Random(8)
    phrase = "a phrase of more than twenty bytes that many texts have"
    filler = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared_parts = [filler(60) + phrase + filler(60) for _ in range(8)]
    rows = [(i, filler(90) + rng.choice([phrase, rng.choice(shared_parts)]) + filler(90)) for i in range(300)]
    rows.append((300, "é".join(shared_parts) * 2))
    limit = 8000
    monkeypatch.setattr(suffix_dedup.crowded_grams, "__defaults__", (limit,))
    taken = []
    whole = suffix_dedup.shard_repeats
    monkeypatch.setattr(suffix_dedup, "shard_repeats", lambda cut: taken.append(cut) or whole(cut))
    assert outcome(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows)
    sizes = taken[0].selectExpr("gram", "length(bytes) + 28 AS n").groupBy("gram").sum("n").collect()
    assert max((n for _, n in sizes), default=0) <= limit // 2
