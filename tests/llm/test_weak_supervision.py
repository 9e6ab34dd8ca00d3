from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from roomlens.llm import registry, weak_supervision
from tests.conftest import SMALL_DIR

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the plain way."""
    words = WORD.findall(text or "")
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


TEXTS = [
    None, "", " \t\r\n\x0b\x0c", "one", "a b c d e a b c d e", "a b c d e f\na b c d e f\n\n a b c d e f", "x y z w",
    "é" * 500, "#*$%&|<> " * 30, "a a a a a a", "w " * 200_000, "\n".join(f"line {i % 7}" for i in range(50)), "日本 語😀\n日本 語😀",
]


def test_counts_of_odd_texts():
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    found = weak_supervision.counts(pa.array(texts, pa.string()))
    assert list(zip(*(c.astype(int).tolist() for c in found[:5]))) == [base(t) for t in texts]


def test_given_documents_against_brute_force(spark):
    """Base counts, the base rules and, by plain expectation maximisation, the verdicts."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL_DIR}/documents.parquet").collect()]
    found = {r.doc_id: r for r in registry.op11_weak_supervision(spark, SMALL_DIR).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs:
        row, wanted = found[doc_id], base(text)
        assert tuple(row[c] for c in weak_supervision.BASE) == wanted
        assert row.base_failed == (wanted[0] < 10 or 100 * wanted[4] > 20 * wanted[0])
        assert not (row.base_failed and row.kept)
    passed = [r for r in found.values() if not r.base_failed]
    votes = [[r.votes // 3**j % 3 for j in range(len(weak_supervision.RULES))] for r in passed]
    quality = plain_mixture(votes)
    assert all(abs(r.quality - q) < 1e-3 and r.kept == (q >= 0.5) for r, q in zip(passed, quality))
    assert 0 < sum(r.kept for r in passed) < len(passed)


def plain_mixture(votes, steps=500):
    start = {0: (0.8, 0.4), 1: (0.02, 0.4), 2: (0.18, 0.2)}
    chance = [[[start[v][k] for v in range(3)] for _ in votes[0]] for k in range(2)]
    prior = 0.7
    for _ in range(steps):
        shares = []
        for row in votes:
            weight = [math.prod(chance[k][j][v] for j, v in enumerate(row)) * (prior, 1 - prior)[k] for k in range(2)]
            shares.append(weight[0] / sum(weight))
        for k in range(2):
            for j in range(len(votes[0])):
                held = [0.5] * 3
                for row, share in zip(votes, shares):
                    held[row[j]] += share if k == 0 else 1 - share
                chance[k][j] = [h / sum(held) for h in held]
        prior = (sum(shares) + 1) / (len(votes) + 2)
    return shares


def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [r for r in registry.op11_weak_supervision(spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    right = np.array([r.kept == (labels[r.doc_id] == 1) for r in judged])
    assert len(right) > 200 and right.mean() > 0.98
    assert all(r.kept for r in judged if labels[r.doc_id] == 1)


def test_estimate_finds_accuracies():
    """Votes drawn from known chances: the posterior tells the kinds apart as well as these chances would."""
    rng, rules = np.random.default_rng(2), len(weak_supervision.RULES)
    kind = rng.random(20_000) < 0.25  # no quality
    bad = rng.random((20_000, rules)) < np.where(kind[:, None], 0.6, 0.1)
    votes = np.where(rng.random((20_000, rules)) < 0.2, weak_supervision.ABSTAIN, bad)
    patterns, place, numbers = np.unique(votes.astype(int) @ 3 ** np.arange(rules), return_inverse=True, return_counts=True)
    quality = weak_supervision.estimate(patterns, numbers.astype(float))[place]
    for_bad, for_good = np.log(0.6 / 0.1), np.log(0.4 / 0.9)
    evidence = np.log(0.25 / 0.75) + np.where(votes == 1, for_bad, np.where(votes == 0, for_good, 0)).sum(axis=1)
    best = ((evidence > 0) == kind).mean()
    assert best > 0.95 and ((quality < 0.5) == kind).mean() > best - 0.003
    assert abs((quality < 0.5).mean() - 0.25) < 0.02
    assert not len(weak_supervision.estimate(patterns[:0], numbers[:0]))


@pytest.mark.parametrize("repeat", [1, 3])
def test_edges(spark, repeat):
    rows = [(i, t, "x", 1.5, True) for i, t in enumerate(TEXTS)] * repeat + [(None, "some text here", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, votes string, quality double, kept boolean")
    found = weak_supervision.judge(df).collect()
    assert len(found) == len(rows)
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 10)
    assert weak_supervision.judge(df.limit(0)).count() == 0
