"""The registered queries, their SQL, and the pipeline."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from roomlens.llm import bpe, line_dedup, quality, registry
from tests.conftest import SMALL_DIR
from tests.llm import brute

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def by_name(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([row[i] for i in order] for row in found), key=repr)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL_DIR)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert by_name(df.columns, [tuple(r) for r in df.collect()]) == by_name(names, cursor.fetchall())


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL_DIR}/documents.parquet").collect()]


def test_repeats_query(spark, documents):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op2_suffix_dedup"](spark, SMALL_DIR).collect()}
    assert found == {d: (*rest, brute.sha(kept)) for d, (*rest, kept) in brute.repeats(documents).items()}


def test_bpe_query(spark, documents):
    ranks = bpe.read_ranks(registry.RANK_FILE)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for doc_id, text in documents:
        ids = library.encode_ordinary(text or "")
        expected[doc_id] = (len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(text or ""))
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_bpe"](spark, SMALL_DIR).collect()}
    assert found == expected


def test_pipeline_against_brute_force(spark, documents):
    """Each stage on what its predecessor kept; the scores are the trained model's own."""
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SMALL_DIR}/labels.parquet"))
    good = {r.doc_id for r in quality.classify(docs, model, keep=["doc_id"]).where("predicted = 1").collect()}
    lines = brute.dedup_lines([d for d in documents if d[0] in good], size=line_dedup.SHORT_SHINGLE_CHARS)
    prints = {d: brute.fingerprint(t) for d, t in lines.items()}
    root = brute.components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for d, p in prints.items():
        least[root[p]] = min(d, least.get(root[p], d))
    alone = [(d, t) for d, t in lines.items() if least[root[prints[d]]] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL_DIR}/benchmark.parquet").collect()]
    clean = {d for d, _, hit, _ in brute.contamination(alone, items) if not hit}
    expected = {d: brute.sha(t or "") for d, t in alone if d in clean}
    found = corpus_pipeline.run(spark, SMALL_DIR).collect()
    assert {r.doc_id: r.decoded_sha256 for r in found} == expected and len(found) == len(expected)
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)
    assert 0 < len(expected) < len(good) < len(documents)


@pytest.mark.parametrize("stage", range(5))
def test_stages_keep_columns(spark, stage):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").limit(40)
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars").limit(3).withColumn("text", F.lit(None).cast("string"))
    wide = docs.union(odd).select("*", F.lit(1).alias("score"), F.lit("x").alias("n_lines"), F.lit("y").alias("fp"))
    run = corpus_pipeline.STAGES[stage][1]
    found = run(spark, wide, SMALL_DIR)
    names = wide.columns if stage < 4 else ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert found.columns == names and found.count() <= wide.count()
    assert stage < 4 or found.count() == 43
    assert run(spark, wide.limit(0), SMALL_DIR).count() == 0
