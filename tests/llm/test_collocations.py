from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from roomlens.llm import collocations
from tests.conftest import SMALL_DIR

SCHEMA = "text string, lang string"


def brute(rows, least=30, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    around[p[i : i + size]] = max(around[p[i : i + size]], a)
        scored = []
        for p, a in often.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least, top, budget", [(30, 2000, 1 << 20), (3, 50, 200), (2, 7, 1)])
def test_given_documents(spark, least, top, budget):
    """With small budgets prefixes are split down to whole suffixes."""
    df = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    rows = [(r.text, r.lang) for r in df.collect()]
    found = got(collocations.phrases(df, least, top, budget))
    assert found == brute(rows, least, top) and found


@pytest.mark.parametrize("budget", [1 << 20, 300, 1])
def test_random_texts(spark, budget):
    rng = random.Random(budget)
    rows = [
        (" ".join(rng.choice(["a", "B", "c", "é", "É", "日本", "a.", "b,\n", "x\ty", "\r", " "]) for _ in range(rng.randint(0, 80))),
         rng.choice(["en", "de", None, "und", ""])) for _ in range(150)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(collocations.phrases(df, 5, 40, budget)) == brute(rows, 5, 40)


def test_edges(spark):
    rows = [(None, "en"), ("", None), (" \t\n", "en"), ("Word", "fr"), ("x y " * 100_000, "en"), ("p q. r s", None)] + [("p q r s t", "de")] * 31
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], SCHEMA + ", h1 int, word string, n int")
    assert got(collocations.phrases(df)) == brute(rows)
    assert collocations.phrases(df.limit(0)).count() == 0
    assert collocations.phrases(df.where("lang = 'fr'")).count() == 0


def test_large_counts_are_exact(spark):
    a, l, r = 9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 9_200_000_000_000_000_001
    wide = "CAST({}L AS decimal(20,0))"
    found = spark.sql(f"SELECT (CAST({collocations.SCALE} AS decimal(10,0)) * {wide.format(a)}) DIV ({wide.format(l)} + {wide.format(r)}) AS s")
    assert found.first().s == collocations.SCALE * a // (l + r)


def test_partition_covers_all_buckets():
    import numpy as np

    rng = np.random.default_rng(0)
    found = collocations.Partition([], [])
    for level in range(1, 5):
        counts = rng.integers(0, 100, 1 << 16)
        counts[rng.integers(0, 1 << 16, 50)] = 10_000
        found = found.extended(level, counts, 5000)
        if found.complete():
            break
        groups = found.groups[-1]
        kept = groups >= 0
        packed = np.bincount(groups[kept], weights=counts[kept])
        assert packed.max() <= 5000 and (counts[~kept] > 5000).all()
    assert found.complete() and level == 4
