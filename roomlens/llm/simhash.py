"""SimHash near-duplicates found by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from roomlens.llm.common import HASHED_ROW_BYTES, broadcast_if_small
from roomlens.llm.components import connected_components
from roomlens.sources.scratch import shared_table

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BITS = 64
_BLOCK = 1 << 16  # shingles hashed at a time, so that a very long text needs no more memory


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 hashes of all word shingles; 0 without words.

    A-Z are lower-cased, words are runs between ASCII white space, repeated shingles count each time.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    total = max(1, len(tokens) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, _BLOCK):
        end = min(start + _BLOCK, total)
        part = tokens[start : end + words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words)))) if len(tokens) >= words else [b" ".join(part)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, end - start)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > total, bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), words) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(values.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int = MAX_BITS, bits: int = BITS) -> list[int]:
    """Masks of which at least one leaves out any given ``radius`` bit positions.

    Position i gets a non-zero vector m(i) of radius + 1 bits. Mask v keeps the positions whose
    vector has an odd product with v. The vectors of ``radius`` positions span at most ``radius``
    dimensions, so some non-zero v is orthogonal to all of them and its mask keeps none.
    """
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    masks = []
    for v in range(1, size):
        mask = sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def link_fingerprints(nodes: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """(fp, root) of all distinct fingerprints in ``nodes`` that link to another one.

    Two fingerprints link at ``radius`` or fewer differing bits; every such pair meets in a table.
    Pairs inside a group are never written out: first each bucket links its members to its smallest
    fingerprint where near enough. Only buckets that still hold several components are then joined,
    and only across components, so a large group of near copies costs one link a member. The few files
    of ``nodes`` are dealt out first, as each row becomes one a table. Spark takes all these rows for as
    small as ``nodes``, so they are kept from being broadcast; the buckets that are shared are measured.
    """
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables = F.array(*[F.struct(F.lit(i).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(covering_masks(radius))])
    placed = nodes.select("fp").repartition(tasks, "fp").select("fp", F.explode(tables).alias("t")).select("fp", "t.tab", "t.key")
    heads = placed.groupBy("tab", "key").agg(F.min("fp").alias("head"), F.max("fp").alias("last")).where("head <> last")
    heads = shared_table(heads.select("tab", "key", "head"), "simhash-heads")
    small = broadcast_if_small(heads, str(HASHED_ROW_BYTES))
    shared = shared_table(placed.hint("merge").join(small, ["tab", "key"]), "simhash-buckets")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("head"))) <= radius
    first = shared_table(
        connected_components(shared.where("fp <> head").where(near).select("fp", "head"), "simhash-star"),
        "simhash-first",
    )
    member = shared.join(first.withColumnRenamed("node", "fp"), "fp", "left").select(
        "tab", "key", "fp", F.coalesce("root", "fp").alias("root")
    )
    mixed = (
        member.groupBy("tab", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        .where("lo <> hi").select("tab", "key")
    )
    open_ = shared_table(member.join(mixed, ["tab", "key"]), "simhash-open")
    other = open_.select("tab", "key", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    across = open_.join(
        other,
        (open_["tab"] == other["tab"]) & (open_["key"] == other["key"]) & (open_["root"] < other["root2"])
        & (F.bit_count(open_["fp"].bitwiseXOR(other["fp2"])) <= radius),
    ).select(open_["root"], "root2")
    second = shared_table(connected_components(across, "simhash-across"), "simhash-second")
    final = second.select(F.col("node").alias("root"), F.col("root").alias("top"))
    inner = first.select(F.col("node").alias("fp"), "root")
    outer = second.select(F.col("node").alias("fp"), F.col("node").alias("root"))
    return (
        inner.union(outer).groupBy("fp").agg(F.min("root").alias("root"))
        .join(final, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (columns doc_id, text).

    Documents link when their fingerprints differ in ``radius`` or fewer bits; component_id is the
    smallest doc_id that links reach, the row's own included. Null and word-free texts have
    fingerprint zero and link like any other; a null doc_id is kept but never the smallest unless
    all are null; repeated rows come back as often; other columns are ignored; no rows give no rows.
    """
    prints = shared_table(fingerprints(docs, words), "simhash-prints")
    nodes = shared_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    linked = link_fingerprints(nodes.select("fp"), radius)
    rooted = shared_table(
        nodes.join(linked, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")),
        "simhash-roots",
    )
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the smallest of their component; rows without an id stay.

    Repeated rows of a kept id all stay; null and empty texts are alike, so one of them stays; a text
    of any length is read whole; all columns are kept; no rows give no rows.
    """
    found = near_duplicates(docs.select("doc_id", "text"), words, radius)
    dropped = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
