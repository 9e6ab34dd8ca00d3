from __future__ import annotations

import pytest

from roomlens.llm import decontaminate
from tests.conftest import SMALL_DIR
from tests.llm import brute

LONG = "one two three four five six seven eight nine ten eleven twelve"


def outcome(docs, items, **options):
    found = decontaminate.contamination(docs, items, **options).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found)


@pytest.mark.parametrize("broadcast", [1 << 26, 0])
def test_given_documents(spark, broadcast):
    docs, items = (spark.read.parquet(f"{SMALL_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = brute.contamination(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    assert outcome(docs, items, max_broadcast_bytes=broadcast) == sorted(expected)
    assert any(hit for _, _, hit, _ in expected)


DOCS = [
    (1, f"Say: {LONG.upper()}!"), (2, "short item here, SHORT ITEM."), (3, None), (4, ""), (5, "x" * 5000),
    (6, "one two three four five six seven eight nine"), (7, "É é école"), (7, "É é école"), (None, f"{LONG} {LONG}"),
]
ITEMS = [(1, LONG), (2, "Short item"), (3, None), (4, "..."), (None, "école"), (10, LONG), (12, "é")]


def test_edges(spark):
    docs = spark.createDataFrame([(*d, "w", 1) for d in DOCS], "doc_id long, text string, words string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = sorted((-1 if d is None else d, *rest) for d, *rest in brute.contamination(DOCS, ITEMS))
    assert outcome(docs, items) == outcome(docs, items, max_broadcast_bytes=0) == expected
    empty = items.limit(0)
    assert all(not hit for _, _, hit, _ in outcome(docs, empty)) and len(outcome(docs, empty)) == len(DOCS)
    assert outcome(docs.limit(0), items) == []


def test_documents_and_spans_go(spark):
    docs = spark.createDataFrame([(*d, "w", 1) for d in DOCS], "doc_id long, text string, words string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    cut = decontaminate.cut_spans(docs, items)
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == "Say: " and texts[2] == "here, " and texts[3] is None and texts[6] == DOCS[5][1]
    assert not any(hit for _, _, hit, _ in outcome(cut, items))


def test_no_python_in_the_plan(spark):
    docs, items = (spark.read.parquet(f"{SMALL_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
