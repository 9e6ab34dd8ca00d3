from __future__ import annotations

import random
from itertools import combinations

import pytest

from roomlens.llm import simhash
from roomlens.llm.components import connected_components
from tests.conftest import SMALL_DIR
from tests.llm import brute


def expected(rows):
    prints = [(doc_id, brute.fingerprint(text)) for doc_id, text in rows]
    root = brute.components({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return sorted(((d, f"{p:016x}", least.get(root[p])) for d, p in prints), key=repr)


def outcome(df):
    return sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=repr)


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(2, 12)
    for count in (1, 2):
        for bits in combinations(range(12), count):
            flipped = sum(1 << b for b in bits)
            assert any(mask & flipped == 0 for mask in masks)
    rng = random.Random(0)
    masks = [m & (2**64 - 1) for m in simhash.covering_masks()]
    assert len(masks) == 31
    for _ in range(3000):
        flipped = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(mask & flipped == 0 for mask in masks)


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(30):
        center = rng.getrandbits(64)
        prints.add(center)
        for _ in range(25):
            center ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))  # chains, some broken
            prints.add(center)
    hub = rng.getrandbits(64)
    prints |= {hub ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a + 1, 64, 5)}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    root = brute.components(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    found = {r.fp: r.root for r in simhash.link_fingerprints(nodes).collect()}
    groups, others = {}, {}
    for p in signed:
        groups.setdefault(root[p], set()).add(p)
        others.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, others.values()))


def test_given_documents(spark):
    df = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    assert outcome(df) == expected([(r.doc_id, r.text) for r in df.collect()])


ROWS = [
    (5, None), (3, ""), (9, " \t\n"), (1, "One two THREE"), (2, "one two three"), (2, "one two three"), (None, "one two three"),
    (None, "lonely text without id"), (7, "w " * 70_000), (8, "É a b c d"), (10, "é a b c d"), (11, "a\x1cb c d e"),
]


def test_edges(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, fp int, root string")
    assert outcome(df) == expected(ROWS)
    assert outcome(df.limit(0)) == []
    kept = simhash.keep_representatives(df.where("doc_id <> 2"))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {1, 3, 7} and kept.where("doc_id = 9").count() == 0


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(i, i * 7 % 50) for i in range(50)],
    [(3, 2), (2, 3), (None, 1), (5, 4), (4, 3)],
])
def test_connected_components(spark, edges):
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {frozenset(e) for e in edges if None not in e and e[0] != e[1]}
    nodes = {n for p in pairs for n in p}
    assert found == brute.components(nodes, lambda a, b: frozenset((a, b)) in pairs)


def test_rows_of_all_tables_are_not_broadcast(spark, monkeypatch):
    """Spark takes them for as few as the fingerprints; only the shared buckets, which are measured, may be sent."""
    rng = random.Random(5)
    prints = [rng.getrandbits(63) for _ in range(200)]
    nodes = spark.createDataFrame([(p,) for p in prints + [p ^ 3 for p in prints[:20]]], "fp long")
    plans, write = {}, simhash.shared_table

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return write(df, label)

    monkeypatch.setattr(simhash, "shared_table", watched)
    for least, joined in ((simhash.HASHED_ROW_BYTES, "BroadcastHashJoin"), (1 << 40, "SortMergeJoin")):
        monkeypatch.setattr(simhash, "HASHED_ROW_BYTES", least)
        found = {r.fp: r.root for r in simhash.link_fingerprints(nodes).collect()}
        assert found == {p: min(q, q ^ 3) for q in prints[:20] for p in (q, q ^ 3)}
        assert joined in plans["simhash-buckets"] and "BuildLeft" not in plans["simhash-buckets"]
