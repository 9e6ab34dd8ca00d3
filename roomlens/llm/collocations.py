"""Phrases that occur more often together than their parts, from vertically partitioned suffix trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from roomlens.llm.common import read_slices
from roomlens.sources.scratch import shared_table

MIN_COUNT = 30
MOST_WORDS = 4
TOP = 2000
COVERED_PCT = 80
SCALE = 2_000_000
BUDGET = 1 << 20  # occurrences of the prefixes of a group: bounds the records a task sorts at once

_KEYS = ["h1", "h2", "h3", "h4"]
_BUCKETS = 1 << 16
_SLOTS = 1 << 24  # of the bitmap of frequent words: 2 MB, however many there are
_SEED = 42
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RECORD = np.dtype([("h", "<u8", MOST_WORDS), ("n", "<u4")])
_BREAKS = r"[.,;:!?\x0A-\x0D]+"
_SMALL = 1 << 24  # numbers up to which a table is quicker than sorting


@dataclass(frozen=True)
class Words:
    """The words of some texts in order: their number among the distinct ones, and their piece."""

    number: np.ndarray
    piece: np.ndarray
    distinct: list[tuple[str, str]]  # (lang, word)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each distinct (lang, word); never 0, which stands for no word."""
        seeds = {lang: xxhash.xxh64_intdigest(lang.encode(), _SEED) for lang, _ in self.distinct}
        return np.array(
            [xxhash.xxh64_intdigest(word.encode(), seeds[lang]) or 1 for lang, word in self.distinct], dtype=np.uint64
        )


def read_words(batch: pa.RecordBatch) -> Words:
    """Words of the columns text and lang; pieces end at punctuation, line breaks and texts."""
    texts = pc.ascii_lower(pc.fill_null(batch["text"], "").cast(pa.large_string()))
    tokens = pc.split_pattern(pc.replace_substring_regex(pc.replace_substring(texts, "\t", " "), _BREAKS, " \n "), " ")
    of = pc.list_parent_indices(tokens).to_numpy()
    tokens = pc.list_flatten(tokens)
    given = pc.not_equal(tokens, "")
    tokens, of = tokens.filter(given), of[given.to_numpy(zero_copy_only=False)]
    ends = pc.equal(tokens, "\n").to_numpy(zero_copy_only=False)
    piece = np.cumsum(ends) + of  # both only grow, so a new text or a break is a new number
    words = tokens.filter(pa.array(~ends)).dictionary_encode()
    langs = pc.fill_null(batch["lang"], "und").dictionary_encode()
    lang = langs.indices.to_numpy()[of[~ends]].astype(np.int64)
    pairs, number = _numbered(words.indices.to_numpy() * len(langs.dictionary) + lang, len(words.dictionary) * len(langs.dictionary))
    names, texts_of = langs.dictionary.to_pylist(), words.dictionary.to_pylist()
    return Words(number, piece[~ends], [(names[p % len(names)], texts_of[p // len(names)]) for p in pairs.tolist()])


def _numbered(values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``end`` in order, and the place of each value among them."""
    if end > _SMALL:
        return np.unique(values, return_inverse=True)
    present = np.zeros(end, dtype=bool)
    present[values] = True
    return np.flatnonzero(present), (np.cumsum(present) - 1)[values]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, h, n) of every word, and a row without a word for the total of each lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in read_slices(batches, "text"):
            found = read_words(batch)
            n = np.bincount(found.number, minlength=len(found.distinct))
            langs, words = ([p[i] for p in found.distinct] for i in (0, 1))
            totals: dict[str, int] = {}
            for lang, count in zip(langs, n.tolist()):
                totals[lang] = totals.get(lang, 0) + count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*langs, *totals], pa.string()), pa.array([*words, *[None] * len(totals)], pa.string()),
                    pa.array([*found.hashes().view(np.int64).tolist(), *[None] * len(totals)], pa.int64()),
                    pa.array([*n.tolist(), *totals.values()], pa.int64()),
                ],
                names=["lang", "word", "h", "n"],
            )

    rows = _rows(docs).mapInArrow(run, "lang string, word string, h long, n long")
    return rows.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def _bitmap(frequent: DataFrame) -> bytes:
    """A bit for each slot of the hash that a frequent word has; its size does not depend on the words."""
    slot = f"(h & {_SLOTS - 1}L) + 1"
    parts = frequent.groupBy(F.expr(f"bitmap_bucket_number({slot})").alias("part")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({slot}))").alias("bits")
    )
    whole = bytearray(_SLOTS // 8)
    for row in parts.collect():
        start = (row.part - 1) * 4096
        whole[start : start + len(row.bits)] = row.bits
    return bytes(whole)


class Suffixes:
    """Cuts texts into word suffixes of ``MOST_WORDS`` words, and those at the first word that is not frequent."""

    def __init__(self, bitmap: bytes):
        self.bitmap = bitmap
        self.frequent: np.ndarray | None = None

    def __call__(self, batch: pa.RecordBatch) -> np.ndarray:
        """Distinct suffixes of two and more words with their number of occurrences."""
        if self.frequent is None:
            self.frequent = np.unpackbits(np.frombuffer(self.bitmap, np.uint8), bitorder="little").view(bool)
        found = read_words(batch)
        hashes = found.hashes()
        hashes[~self.frequent[hashes & np.uint64(_SLOTS - 1)]] = 0
        columns = [hashes[found.number] if len(hashes) else np.zeros(0, np.uint64)]
        for step in range(1, MOST_WORDS):
            after = np.zeros_like(columns[0])
            if len(after) > step:
                joined = (found.piece[step:] == found.piece[:-step]) & (columns[-1][:-step] != 0)
                after[:-step] = np.where(joined, columns[0][step:], 0)
            columns.append(after)
        several = columns[1] != 0
        columns = [c[several & (columns[0] != 0)] for c in columns]
        order = np.argsort(mixed(columns))
        columns = [c[order] for c in columns]
        new = np.flatnonzero(np.logical_or.reduce([np.r_[True, c[1:] != c[:-1]] for c in columns]) if len(order) else [])
        out = np.empty(len(new), _RECORD)
        out["h"] = np.stack([c[new] for c in columns], axis=1) if len(new) else 0
        out["n"] = np.diff(np.r_[new, len(order)])
        return out


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """One number of the given columns; of a single one, the number itself."""
    out = columns[0]
    for column in columns[1:]:
        out = (out * _MIX) ^ column
    return out


def _bucket(suffixes: np.ndarray, level: int) -> np.ndarray:
    return (mixed([suffixes["h"][:, i] for i in range(level)]) >> np.uint64(48)).astype(np.int64)


@dataclass(frozen=True)
class Partition:
    """Vertical partitioning: prefixes, by the bucket of their hash, and the group of each bucket.

    ``groups[level - 1][bucket]`` is the group of the prefixes of ``level`` words in that bucket; -1 means
    that they are too frequent for a group and go on to prefixes of one word more.
    """

    groups: list[np.ndarray]
    levels: list[int]  # of each group

    def of(self, suffixes: np.ndarray) -> np.ndarray:
        out = np.full(len(suffixes), -1)
        for level, groups in enumerate(self.groups, 1):
            left = np.flatnonzero(out < 0)
            out[left] = groups[_bucket(suffixes[left], level)]
        return out

    def extended(self, level: int, counts: np.ndarray, budget: int) -> Partition:
        """With the buckets of one more level packed into groups of about ``budget`` occurrences."""
        fits = (counts <= budget) | (level == MOST_WORDS)
        groups = np.full(_BUCKETS, -1)
        levels = list(self.levels)
        held = budget + 1
        for bucket in np.flatnonzero(fits & (counts > 0)).tolist():
            if held + counts[bucket] > budget:
                levels.append(level)
                held = 0
            held += int(counts[bucket])
            groups[bucket] = len(levels) - 1
        if levels[len(self.levels) :] == []:
            levels.append(level)
        groups[fits & (counts == 0)] = len(levels) - 1
        return Partition([*self.groups, groups], levels)

    def complete(self) -> bool:
        return bool(self.groups) and bool((self.groups[-1] >= 0).all())


def partition_prefixes(docs: DataFrame, frequent: DataFrame, suffixes: Suffixes, budget: int = BUDGET) -> Partition:
    """Groups of prefixes that fit the budget; prefixes above it are counted a word longer, by a scan each.

    What reaches the driver is one number for each of the ``_BUCKETS`` buckets of a level.
    """
    found = Partition([], [])
    for level in range(1, MOST_WORDS + 1):
        if level == 1:
            rows = frequent.groupBy(F.shiftrightunsigned("h", 48).alias("bucket")).agg(F.sum("n").alias("n"))
        else:
            rows = _bucket_counts(docs, suffixes, found, level)
        counts = np.zeros(_BUCKETS, dtype=np.int64)
        for row in rows.collect():
            counts[row.bucket] = row.n
        found = found.extended(level, counts, budget)
        if found.complete():
            break
    return found


def _bucket_counts(docs: DataFrame, suffixes: Suffixes, found: Partition, level: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BUCKETS, dtype=np.int64)
        for batch in read_slices(batches, "text"):
            seen = suffixes(batch)
            seen = seen[found.of(seen) < 0]
            np.add.at(counts, _bucket(seen, level), seen["n"])
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    return _rows(docs).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def dealt_suffixes(docs: DataFrame, suffixes: Suffixes, partition: Partition) -> DataFrame:
    """(group, records): the distinct suffixes of a piece of the input, packed by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in read_slices(batches, "text"):
            found = suffixes(batch)
            group = partition.of(found)
            order = np.lexsort((found["h"][:, 1], found["h"][:, 0], group))
            found, group = found[order], group[order]
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
            ends = (np.r_[starts, len(group)] * _RECORD.itemsize).astype(np.int32)
            records = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(found.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(group[starts].astype(np.int64)), records], names=["group", "records"])

    return _rows(docs).mapInArrow(run, "group long, records binary")


def subtree_counts(records: np.ndarray, level: int, min_count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, occurrences) of the nodes below a group's prefixes, down to ``MOST_WORDS`` words.

    Sorted records are the leaves of the suffix subtrees, in order; a node's count is the total of its
    leaves. Nodes shorter than the prefixes belong to other groups too, so these all come out, in part.
    """
    order = np.lexsort([records["h"][:, i] for i in range(MOST_WORDS - 1, -1, -1)])
    keys, n = records["h"][order], records["n"][order].astype(np.int64)
    out = []
    new = np.r_[True, np.zeros(max(0, len(n) - 1), bool)] if len(n) else np.zeros(0, bool)
    for depth in range(1, MOST_WORDS + 1):
        column = keys[:, depth - 1]
        new = new | np.r_[new[:1], column[1:] != column[:-1]]
        if depth == 1:
            continue
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(n, starts) if len(starts) else n
        wanted = (column[starts] != 0) & ((totals >= min_count) | (depth < level))
        words = keys[starts[wanted]].copy()
        words[:, depth:] = 0
        out.append((words, totals[wanted]))
    return out


def phrase_counts(dealt: DataFrame, partition: Partition, min_count: int = MIN_COUNT) -> DataFrame:
    """(h1, h2, h3, h4, a) of the phrases of 2 to ``MOST_WORDS`` words with ``min_count`` occurrences.

    A phrase is the hashes of its words, filled up with zeros. A task holds one group at a time.
    """
    levels = partition.levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        at = None

        def done() -> Iterator[pa.RecordBatch]:
            for words, totals in subtree_counts(np.concatenate(held), levels[at], min_count):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(words[:, i].view(np.int64) if len(words) else [], pa.int64()) for i in range(MOST_WORDS)), pa.array(totals)],
                    names=[*_KEYS, "a"],
                )

        for batch in batches:
            for group, records in zip(batch["group"].to_pylist(), batch["records"]):
                if held and group != at:
                    yield from done()
                    held = []
                at = group
                held.append(np.frombuffer(records.as_buffer(), _RECORD))
        if held:
            yield from done()

    grouped = dealt.repartition("group").sortWithinPartitions("group")
    found = grouped.mapInArrow(run, ", ".join(f"{k} long" for k in [*_KEYS, "a"]))
    if max(levels, default=1) > 2:
        found = found.groupBy(*_KEYS).agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    return found


def _part(first: int, last: int) -> str:
    """Words ``first`` to ``last`` of a phrase, from 1, as a phrase."""
    words = [f"h{i}" for i in range(first, last + 1)]
    return f"named_struct({', '.join(f'{k!r}, {w}' for k, w in zip(_KEYS, words + ['0L'] * (4 - len(words))))})"


_SIZE = "IF(h3 = 0L, 2, IF(h4 = 0L, 3, 4))"


def _by_size(parts: dict[int, list[str]]) -> str:
    listed = [f"WHEN {size} THEN array({', '.join(found)})" for size, found in parts.items()]
    return f"CASE {_SIZE} {' '.join(listed)} END"


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each lang of ``docs`` (text, lang).

    Words are lower-cased in A-Z and parted by spaces and tabs, pieces by ``. , ; : ! ?`` and line
    breaks. Phrases of 2 to 4 words with ``min_count`` occurrences a are scored by their weakest cut:
    2,000,000 a over the occurrences l of the words before it and r of those behind, rounded down, the
    first cut on ties. Phrases are dropped if a longer one around them has 80 % of their occurrences. n
    counts all words of the lang. The ``top`` of each lang come out, by score, a and phrase.

    Prefixes are packed into groups by their occurrences, each group's suffixes meet in a task that
    sorts them into truncated suffix trees and reads counts from the leaves' totals. Prefixes too
    frequent for a group are split by the next word, up to whole suffixes, and equal suffixes are added
    up before they are dealt, so no word, however frequent, makes a task long. Words are told apart by
    64-bit hashes. Null texts are empty, a null lang is ``und``; repeated rows count as often as they
    stand; a text of any length is read whole; no words give no rows; other columns are ignored.
    """
    words = shared_table(word_counts(docs).where((F.col("n") >= min_count) | F.col("word").isNull()), "phrase-words")
    frequent = words.where("word IS NOT NULL")
    suffixes = Suffixes(_bitmap(frequent))
    partition = partition_prefixes(docs, frequent, suffixes, budget)
    counted = shared_table(phrase_counts(dealt_suffixes(docs, suffixes, partition), partition, min_count), "phrase-counts")

    inner = {size: [_part(i, j) for i in range(1, size) for j in range(i + 1, size + 1) if j - i + 1 < size] for size in (3, 4)}
    longer = (
        counted.where("h3 <> 0L").select(F.explode(F.expr(_by_size(inner))).alias("k"), "a").select("k.*", "a")
        .groupBy(*_KEYS).agg(F.max("a").alias("around"))
    )
    wide = "CAST({} AS decimal(20,0))"
    kept = counted.join(longer, _KEYS, "left").where(
        f"around IS NULL OR {wide.format('around')} * 100 < {wide.format('a')} * {COVERED_PCT}"
    ).drop("around")

    every = counted.union(frequent.selectExpr("h", "0L", "0L", "0L", "n"))
    cuts = {
        size: [f"named_struct('k', {k}, 'first', {_part(1, k)}, 'rest', {_part(k + 1, size)})" for k in range(1, size)]
        for size in (2, 3, 4)
    }
    cut = kept.select(*_KEYS, "a", F.explode(F.expr(_by_size(cuts))).alias("c")).select(*_KEYS, "a", "c.k", "c.first", "c.rest")
    score = F.expr(f"(CAST({SCALE} AS decimal(10,0)) * {wide.format('a')}) DIV ({wide.format('l')} + {wide.format('r')})")
    side = every.select(F.struct(*_KEYS).alias("side"), "a")
    scored = (
        cut.join(side.select(F.col("side").alias("first"), F.col("a").alias("l")), "first")
        .join(side.select(F.col("side").alias("rest"), F.col("a").alias("r")), "rest")
        .groupBy(*_KEYS, "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("weakest"))
        .select(*_KEYS, "a", "weakest.score", "weakest.l", "weakest.r")
    )
    by_lang = scored.join(frequent.selectExpr("h AS h1", "lang", "word AS w1"), "h1")
    best = shared_table(
        by_lang.withColumn("place", F.expr("rank() OVER (PARTITION BY lang ORDER BY score DESC, a DESC)")).where(F.col("place") <= top),
        "phrase-best",
    )
    named = best
    for i in range(2, MOST_WORDS + 1):
        named = named.join(frequent.selectExpr(f"h AS h{i}", f"word AS w{i}"), f"h{i}", "left")
    totals = words.where("word IS NULL").select("lang", "n")
    order = "PARTITION BY lang ORDER BY score DESC, a DESC, phrase"
    return (
        named.withColumn("phrase", F.concat_ws(" ", *(f"w{i}" for i in range(1, MOST_WORDS + 1))))
        .withColumn("rank", F.expr(f"BIGINT(row_number() OVER ({order}))")).where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
