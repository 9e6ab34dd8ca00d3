from __future__ import annotations

import random
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from roomlens.llm import bpe
from roomlens.llm.registry import RANK_FILE
from tests.conftest import SMALL_DIR

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(RANK_FILE), PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANK_FILE), special_tokens={})


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_perfect_hash_is_minimal_and_exact(encoder):
    index = encoder.index
    assert index.find(encoder.tokens) == list(range(len(encoder.tokens)))
    assert len(index.keys) == index.n == len(set(index.keys))
    assert index.find([b"\0not a token\0", b""]) == [-1, -1]
    assert bpe.PerfectHash([]).find([b"a"]) == [-1] and bpe.PerfectHash([b"a"]).find([b"a", b"b"]) == [0, -1]


def test_every_character(encoder, library):
    chars = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    for start in range(0, len(chars), 2000):
        for form in ("a%sa", " %s ", "\n%sx"):
            text = "".join(form % c for c in chars[start : start + 2000])
            assert ids(encoder, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("seed", range(5))
def test_random_texts(encoder, library, seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = "".join(rng.choice("abcde é'st \n\t!你好1😀\r\xa0") for _ in range(rng.randint(0, 400))) * rng.randint(1, 4)
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_long_runs_and_a_full_memo(encoder, library, monkeypatch):
    text = "ab" * 40_000 + " " * 30_000 + "x" + "é" * 10_000
    assert ids(encoder, text) == library.encode_ordinary(text)
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 50)
    text = " ".join(f"w{i}x{i * i}" for i in range(500))
    assert ids(bpe.Encoder(encoder.ranks, PATTERN, encoder.index), text * 2) == library.encode_ordinary(text * 2)


def test_round_trip_in_spark(spark, library):
    given = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "z" * 100_000), (-4, "é"), (-4, "é"), (None, "x")], given.schema)
    docs = given.union(odd).withColumn("ids", F.lit("other")).withColumn("n_tokens", F.lit(None).cast("string"))
    encoded = bpe.encode(docs, RANK_FILE, PATTERN)
    rows = bpe.decode(encoded, RANK_FILE, keep_ids=True).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in rows:
        assert bytes(row.decoded).decode() == texts[row.doc_id]
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(row.ids) // 4
    assert bpe.encode_digests(docs.limit(0), RANK_FILE, PATTERN).count() == 0
