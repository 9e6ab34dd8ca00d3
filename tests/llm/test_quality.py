from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomlens.llm import quality

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{DIR}/{name}.parquet") for name in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return quality.train(*tables)


def test_held_out_fold(spark):
    ids = [0, 1, 2, 77, 123456789, -5]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", quality.held_out(F.col("doc_id")).alias("out"))
    assert {r.doc_id: r.out for r in rows.collect()} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    scored = quality.classify(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(quality.held_out(F.col("doc_id")))
    rows = scored.collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_held_out_and_zero_labels_are_not_learnt_from(spark, tables, model):
    docs, labels = tables
    changed = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    ).where(quality.held_out(F.col("doc_id")) | (F.col("quality") == 1))
    again = quality.train(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")), changed)
    assert np.array_equal(again.weights, model.weights) and again.prior == model.prior


def test_risk_does_not_follow_the_negative_part_below_zero():
    rng = np.random.default_rng(0)
    positive = np.c_[rng.normal(4, 1, (400, 1)), rng.normal(0, 1, (400, 3))]
    negative = np.c_[rng.normal(-4, 1, (120, 1)), rng.normal(0, 1, (120, 3))]
    unlabelled = np.vstack([positive[:280] + 0.01, negative])
    prior = quality.estimate_prior(np.c_[positive, np.ones(400)], np.c_[unlabelled, np.ones(400)])
    assert 0.55 < prior < 0.85
    model = quality.fit(positive, unlabelled)
    assert np.mean(model.score(negative) < 0.7) > 0.9 and np.mean(model.score(positive) > 0.7) > 0.9


def test_edges(spark, tables, model):
    rows = [(1, None), (2, ""), (3, "A fine text, it is."), (3, "A fine text, it is."), (None, "q" * 300_000)]
    docs = spark.createDataFrame([(*r, 0.5, "p", 9) for r in rows], "doc_id long, text string, score double, predicted string, x int")
    found = quality.classify(docs, model)
    assert found.columns == ["doc_id", "text", "x", "score", "predicted"]
    scored = found.collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
    assert quality.classify(docs.limit(0), model).count() == 0
    unknown = quality.train(tables[0], tables[1].limit(0))
    assert {r.score for r in quality.classify(docs, unknown).collect()} == {0.5}
    assert quality.classify(docs, quality.train(docs.limit(0), tables[1]), names=("_a", "_b")).columns[-2:] == ["_a", "_b"]


def test_long_texts_are_counted_in_pieces(monkeypatch):
    texts = ["", "a", "ab", "one two\nthree  two\n\n one two\n", "é" * 40 + "\t\x0b x\r\ny", "word " * 30, "x" * 100, "\n" * 9, "no end of line " * 7 + "\n" + "z" * 33]
    whole = [quality.features(t) for t in texts]
    for size in (1, 2, 7, 16):
        monkeypatch.setattr(quality, "_PIECE", size)
        assert all((quality.features(t) == w).all() for t, w in zip(texts, whole))
