from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roomlens.llm import prefix_trie
from tests.conftest import SMALL_DIR

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string"


def said(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, found in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = ",".join(str(c) for c in found if len(convs[c]) == len(node))
        out.append((
            found[0], len(node), members[node[:-1]][0] if node else None, len(found), len(children[node]),
            sum(not children[x] for x in below), sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def head(c):
    return c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6


@pytest.mark.parametrize("shard_turns", [1, 7, 60, 10**6])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, shard_turns, seed):
    """Few different turns, so that prefixes branch, end inside others and cross shards everywhere."""
    rng = random.Random(seed)
    rows = [
        (c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bb", "cccc"]))
        for c in rng.sample(range(500), 60) for t in range(rng.choice([1, 2, 3, 3, 9]))
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.trie(df, head, shard_turns)) == brute(rebuilt(said(rows)))
    assert got(prefix_trie.trie(df, None, shard_turns)) == brute(said(rows))


@pytest.mark.parametrize("shard_turns", [40, 10**6])
def test_given_conversations(spark, shard_turns):
    df = spark.read.parquet(f"{SMALL_DIR}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(prefix_trie.trie(df, head, shard_turns)) == brute(rebuilt(said(rows)))


def test_edges(spark):
    long = "y" * 300_000
    rows = [
        (5, None, None, None), (5, 0, "user", "a"), (5, 0, "user", "a"), (7, 1, "", ""), (None, 1, "user", "lost"),
        (100, 1, "user", long), (101, 1, "user", long), (102, 2, "x", "é😀"), (102, 2, "x", "b"), (205, 1, "u", "tail"),
    ] + [(300 + i, 1, "user", "copy") for i in range(40)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", depth int, shard string")
    for shard_turns in (1, 10**6):
        assert got(prefix_trie.trie(df, head, shard_turns)) == brute(rebuilt(said(rows)))
    assert prefix_trie.trie(df.limit(0), head).count() == 0


def test_very_long_conversation(spark):
    """Depth is walked without recursion."""
    rows = [(c, t, "u", str(t)) for c in (1, 2) for t in range(5000)] + [(2, 5000, "u", "end")]
    found = {(r.depth, r.conv_id): r for r in prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == 5002 and found[5000, 1].n_children == 1 and found[0, 1].n_leaves == 1
    assert found[0, 1].saved_tokens == sum(len(str(t)) for t in range(5000))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100])
def test_medians_first(n):
    order = list(prefix_trie.medians_first(n))
    assert sorted(order) == list(range(n)) and (not n or order[0] == n // 2)


def test_tree_is_balanced():
    tree = prefix_trie.TernaryTree()
    for at in prefix_trie.medians_first(1000):
        tree.insert([at], [1])
    depth = {tree.down[0]: 1}
    for node in list(depth):
        left = [node]
        while left:
            at = left.pop()
            for side in (tree.low[at], tree.high[at]):
                if side:
                    depth[side] = depth[at] + 1
                    left.append(side)
    assert max(depth.values()) <= 10 and [tree.turn[c] for c in tree.children(0)] == list(range(1000))
