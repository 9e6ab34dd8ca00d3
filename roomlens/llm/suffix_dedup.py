"""Removal of byte strings that occur earlier in the corpus, by suffix sorting of shards.

Every window of ``LENGTH`` bytes is filed under one of its grams, the one with the least hash, so equal
windows are filed alike. Runs of neighbouring windows under one gram are a context. Contexts that
repeat as a whole need no sorting; the others whose gram occurs in several contexts are dealt to
shards by gram. A shard sorts the suffixes of its contexts by external induced sorting, and windows
that share ``LENGTH`` bytes with an earlier one are found where the common-prefix values say so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roomlens.llm.common import MAX_BROADCAST_BYTES, broadcast_if_small
from roomlens.llm.induced_sort import InducedSort
from roomlens.operators.model import dense_key
from roomlens.sources.scratch import shared_table

LENGTH = 100
GRAM = 20
_WINDOW = LENGTH - GRAM + 1  # grams in a window
_PIECE = 1 << 18  # bytes scanned at a time
SHARD_BYTES = 16 << 20  # contexts sorted at a time; a gram of more than half of it is split by window
_ROW_BYTES = 28  # of a context's row beside its bytes
_SIZE_BITS = 8  # a context has LENGTH + _WINDOW - 1 = 180 bytes at most
_SEPARATOR = 0xFF  # no byte of UTF-8
_P, _Q = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_BYTE_HASH = np.random.default_rng(11).integers(1, 2**63, size=256, dtype=np.uint64)
_BYTE_CHECK = np.random.default_rng(12).integers(1, 2**63, size=256, dtype=np.uint64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_P, n, 2**64))


def _hash_of(size: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Polynomial hashes of all strings of ``size`` bytes, from those of about half the size."""
    if size not in known:
        half = 1 << ((size - 1).bit_length() - 1)
        first, second = _hash_of(half, known), _hash_of(size - half, known)
        n = len(known[1]) - size + 1
        known[size] = first[:n] * _power(size - half) + second[half : half + n]
    return known[size]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _Q
    return h ^ (h >> np.uint64(29))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.uint64(2**64 - 1))
    full[:n] = values
    full = full.reshape(blocks, width)
    forth = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def contexts_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of texts joined in ``data``, the text i from starts[i] to starts[i + 1].

    Returns gram hash, context hash, text number, offset in the text and bytes of each context.
    Every window of every text lies in exactly one context, at the same place as its equals.
    """
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    known = {1: _BYTE_HASH[data]}
    grams, windows = _mix(_hash_of(GRAM, known)), _hash_of(LENGTH, known)
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    marked = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = (_sliding_least(marked, _WINDOW) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ends = np.repeat(starts[1:], np.diff(starts))
    at = np.nonzero(np.arange(len(windows)) + LENGTH <= ends[: len(windows)])[0]
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    gram_at = least[at]
    first = np.r_[True, (np.diff(gram_at) != 0) | (np.diff(at) != 1)]
    begin = at[first]
    end = at[np.r_[first[1:], True]]
    context = _mix(_mix(windows[begin]) * np.uint64(3) + _mix(windows[end]) * np.uint64(5) + (end - begin).astype(np.uint64))
    text = np.searchsorted(starts, begin, side="right") - 1
    return grams[gram_at[first]].view(np.int64), context.view(np.int64), text, begin - starts[text], end - begin + LENGTH


def contexts(docs: DataFrame) -> DataFrame:
    """(gram, context, doc, place) of all contexts; place is offset * 256 + bytes.

    Where an equal context stands earlier in the same lot of texts, place is its complement, a
    negative number: this one needs no further look. Such rows have any gram and are dealt out
    evenly, which thins out copies before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(ids: list[int], shift: list[int], texts: list[bytes]) -> pa.RecordBatch:
            starts = np.cumsum([0, *map(len, texts)])
            gram, context, text, offset, size = contexts_of(np.frombuffer(b"".join(texts), np.uint8), starts)
            place = ((offset + np.array(shift, np.int64)[text]) << _SIZE_BITS) | size
            doc = np.array(ids, np.int64)[text]
            order = np.lexsort((place, doc, context, gram))
            again = (gram[order][1:] == gram[order][:-1]) & (context[order][1:] == context[order][:-1])
            repeated = np.zeros(len(order), bool)
            repeated[order[1:][again]] = True
            gram = np.where(repeated, _mix((doc * 31 + place).view(np.uint64)).view(np.int64), gram)
            place = np.where(repeated, ~place, place)
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (gram, context, doc, place)], names=["gram", "context", "doc", "place"]
            )

        ids, shift, texts, held = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"]):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for start in range(0, max(1, len(data) - LENGTH + 1), _PIECE):
                    piece = data[start : start + _PIECE + LENGTH - 1]
                    ids.append(doc)
                    shift.append(start)
                    texts.append(piece)
                    held += len(piece)
                    if held >= _PIECE:
                        yield packed(ids, shift, texts)
                        ids, shift, texts, held = [], [], [], 0
        if ids:
            yield packed(ids, shift, texts)

    return docs.select("doc", F.col("text").cast("string")).mapInArrow(run, "gram long, context long, doc long, place long")


def sift(found: DataFrame) -> DataFrame:
    """Contexts that need a look: (gram, doc, place, repeated).

    ``repeated`` contexts equal an earlier one as a whole, so all of their bytes go. Of the others,
    those stay whose gram also occurs in a different context. Grams are dealt to tasks and sorted
    there by Spark; a task keeps two rows of a gram in mind, however many there are.
    """
    dealt = found.repartition("gram").sortWithinPartitions("gram", "context", "doc", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # gram, context of the row before
        pending = None  # first context of the last gram, (doc, place), while it is its only one
        for batch in batches:
            place = batch["place"].to_numpy()
            known = place < 0
            if known.any():
                yield pa.RecordBatch.from_arrays(
                    [batch["gram"].filter(pa.array(known)), batch["doc"].filter(pa.array(known)), pa.array(~place[known]),
                     pa.array(known[known])],
                    names=["gram", "doc", "place", "repeated"],
                )
                batch = batch.filter(pa.array(~known))
            if not batch.num_rows:
                continue
            gram, context, doc, place = (batch[c].to_numpy() for c in ("gram", "context", "doc", "place"))
            new_gram = np.r_[last is None or gram[0] != last[0], gram[1:] != gram[:-1]]
            new_context = new_gram | np.r_[last is None or context[0] != last[1], context[1:] != context[:-1]]
            chosen = np.nonzero(new_context)[0]
            group = np.cumsum(new_gram)  # 0: goes on with the last gram of the batch before
            several = np.bincount(group[chosen], minlength=group[-1] + 1) > 1
            carried = pending if group[0] == 0 else None
            if group[0] == 0:
                # the last gram has a first context already: any new one here makes it several
                several[0] = bool((group[chosen] == 0).any()) or pending is None
            keep = chosen[several[group[chosen]]]
            again = np.nonzero(~new_context)[0]
            rows = [
                (gram[keep], doc[keep], place[keep], np.zeros(len(keep), bool)),
                (gram[again], doc[again], place[again], np.ones(len(again), bool)),
            ]
            if carried is not None and several[0]:
                rows.append((np.array([last[0]]), np.array([carried[0]]), np.array([carried[1]]), np.zeros(1, bool)))
            end = group[-1]
            if several[end]:
                pending = None
            elif end > 0 or group[0] == 1:
                lone = chosen[group[chosen] == end]
                if len(lone):
                    pending = (doc[lone[0]], place[lone[0]])
            last = (gram[-1], context[-1])
            columns = [np.concatenate(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "doc", "place", "repeated"])

    return dealt.mapInArrow(run, "gram long, doc long, place long, repeated boolean")


def cut_contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, doc, offset, bytes) of the wanted contexts, read from the texts."""
    places = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "place")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = (batch["text"][i].as_py() or "").encode("utf-8", "surrogatepass")
                places = batch["places"][i].values
                place = places.field("place").to_numpy()
                offset, size = place >> _SIZE_BITS, place & ((1 << _SIZE_BITS) - 1)
                parts = [data[a : a + n] for a, n in zip(offset.tolist(), size.tolist())]
                doc = pa.array(np.full(len(parts), batch["doc"][i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [places.field("gram"), doc, pa.array(offset), pa.array(parts, pa.binary())],
                    names=["gram", "doc", "offset", "bytes"],
                )

    joined = docs.select("doc", F.col("text").cast("string")).join(places, "doc")
    return joined.mapInArrow(run, "gram long, doc long, offset long, bytes binary")


def repeats_in_shard(parts: list[bytes], memory_bytes: int = 32 << 20) -> np.ndarray:
    """For contexts in corpus order: per byte of their concatenation with one separator after each,
    whether a window starts there that equals an earlier one."""
    text = np.frombuffer(bytes([_SEPARATOR]).join(parts) + bytes([_SEPARATOR]), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts_window = np.zeros(len(text) + 1, np.int8)
    np.add.at(starts_window, ends - sizes, 1)
    np.add.at(starts_window, ends - LENGTH + 1, -1)
    starts_window = np.cumsum(starts_window[:-1], dtype=np.int8).astype(bool)
    repeated = np.zeros(len(text), bool)
    for positions, common in InducedSort(text, LENGTH, memory_bytes).buckets():
        group = np.cumsum(common < LENGTH)
        chosen = starts_window[positions]
        positions, group = positions[chosen], group[chosen]
        if not len(positions):
            continue
        first = np.r_[True, group[1:] != group[:-1]]
        earliest = np.minimum.reduceat(positions, np.nonzero(first)[0])
        repeated[positions[positions != earliest[np.cumsum(first) - 1]]] = True
    return repeated


def shard_repeats(cut: DataFrame, shard_bytes: int = SHARD_BYTES, memory_bytes: int = 32 << 20) -> DataFrame:
    """(doc, begin, end): byte ranges covered by windows that repeat an earlier one.

    Spark deals the contexts by gram and sorts them; a task takes whole grams, about ``shard_bytes``
    of them at a time, as one shard, so its memory does not grow with its partition. The caller keeps
    grams away that are large themselves (``crowded_grams``).
    """
    dealt = cut.repartition("gram").sortWithinPartitions("gram")

    def ranges(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        order = np.lexsort((table["offset"].to_numpy(), table["doc"].to_numpy()))  # the order of the corpus
        table = table.take(pa.array(order))
        doc, offset, parts = table["doc"].to_numpy(), table["offset"].to_numpy(), table["bytes"].to_pylist()
        at = np.nonzero(repeats_in_shard(parts, memory_bytes))[0]
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        owner = np.searchsorted(starts, at, side="right") - 1
        first = np.r_[np.ones(min(1, len(at)), bool), (np.diff(at) != 1) | (np.diff(owner) != 0)]
        last = np.r_[first[1:], np.ones(min(1, len(at)), bool)]
        begin, end, owner = at[first], at[last], owner[first]
        begin, end = begin - starts[owner] + offset[owner], end - starts[owner] + offset[owner] + LENGTH
        return pa.RecordBatch.from_arrays([pa.array(doc[owner]), pa.array(begin), pa.array(end)], names=["doc", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch["gram"].to_numpy()
            if size >= shard_bytes:  # the held rows end with a gram that may go on here
                change = np.nonzero(gram != held[-1]["gram"][-1].as_py())[0]
                if len(change):
                    yield ranges([*held, batch.slice(0, change[0])])
                    held, size, batch = [], 0, batch.slice(change[0])
            held.append(batch)
            size += batch.nbytes
        if held:
            yield ranges(held)

    return dealt.mapInArrow(run, "doc long, begin long, end long")


def crowded_grams(wanted: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(gram) of the grams whose contexts are too many for a shard to take whole."""
    size = F.expr(f"sum((place & {(1 << _SIZE_BITS) - 1}) + {_ROW_BYTES})")
    return wanted.groupBy("gram").agg(size.alias("bytes")).where(F.col("bytes") > shard_bytes // 2).select("gram")


def window_repeats(cut: DataFrame) -> DataFrame:
    """(doc, begin, end): windows of the contexts that repeat an earlier one, however many a gram has.

    Each window is dealt by two 64-bit hashes of its own, which equal windows share, and Spark sorts
    them; a task keeps one row in mind.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                parts = part["bytes"].to_pylist()
                sizes = np.array([len(p) for p in parts], np.int64)
                data = np.frombuffer(b"".join(parts), np.uint8)
                counts = sizes - LENGTH + 1
                owner = np.repeat(np.arange(len(parts)), counts)
                within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = (np.cumsum(sizes) - sizes)[owner] + within
                first, second = (_mix(_hash_of(LENGTH, {1: table[data]}))[at] for table in (_BYTE_HASH, _BYTE_CHECK))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                     pa.array(part["doc"].to_numpy()[owner]), pa.array(part["offset"].to_numpy()[owner] + within)],
                    names=["window", "check", "doc", "begin"],
                )

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # hashes of the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            window, check = batch["window"].to_numpy(), batch["check"].to_numpy()
            again = np.r_[last == (window[0], check[0]), (window[1:] == window[:-1]) & (check[1:] == check[:-1])]
            last = (window[-1], check[-1])
            doc, begin = batch["doc"].to_numpy()[again], batch["begin"].to_numpy()[again]
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(begin), pa.array(begin + LENGTH)], names=["doc", "begin", "end"])

    dealt = (
        cut.select("doc", "offset", "bytes").mapInArrow(windows, "window long, check long, doc long, begin long")
        .repartition("window", "check").sortWithinPartitions("window", "check", "doc", "begin")
    )
    return dealt.mapInArrow(later, "doc long, begin long, end long")


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of touching or overlapping ranges."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def removed_spans(ranges: DataFrame) -> DataFrame:
    """(doc, spans): the maximal runs of a text's ranges, one row for each text that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"begin": b, "end": e} for b, e in _merged([(r["begin"], r["end"]) for r in ranges])]
                for ranges in batch["ranges"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(found, _SPANS)], names=["doc", "spans"])

    gathered = ranges.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    return gathered.mapInArrow(run, "doc long, spans array<struct<begin:long,end:long>>")


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text) with ``doc``, a number in the order of doc_id that tells texts apart;
    all rows, and one row a number.

    The number is doc_id itself if no row lacks one or repeats one; otherwise rows are numbered by doc_id
    and text, a null doc_id first.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    if ids.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        plain = docs.withColumn("doc", F.col("doc_id").cast("long"))
        return plain, plain
    keyed = shared_table(
        docs.select(F.col("doc_id").cast("long").alias("old_id"), F.xxhash64(_text()).alias("old_key")).distinct()
        .withColumn("old_order", F.struct("old_id", "old_key")), "suffix-ids",
    )
    numbers = shared_table(dense_key(keyed, "doc", "old_order").select("doc", "old_id", "old_key"), "suffix-numbers")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("old_id")) & (F.xxhash64(_text()) == F.col("old_key"))
    every = docs.join(numbers, same).drop("old_id", "old_key")
    return every, every.dropDuplicates(["doc"])


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """(doc, begin, end): byte ranges, overlaps included, covered by strings that start earlier too.

    Grams with contexts for more than half a shard are split by window, so a shard has a bounded size.
    """
    sifted = shared_table(sift(contexts(texts)), "suffix-sifted")
    whole = sifted.where("repeated").selectExpr(
        "doc", f"shiftright(place, {_SIZE_BITS}) AS begin",
        f"shiftright(place, {_SIZE_BITS}) + (place & {(1 << _SIZE_BITS) - 1}) AS end",
    )
    wanted = sifted.where("NOT repeated")
    crowded = shared_table(crowded_grams(wanted), "suffix-crowded")
    if crowded.isEmpty():
        return whole.union(shard_repeats(cut_contexts(texts, wanted)))
    small = broadcast_if_small(crowded, "16")
    few = cut_contexts(texts, wanted.join(small, "gram", "left_anti"))
    many = cut_contexts(texts, wanted.join(small, "gram", "left_semi"))
    return whole.union(shard_repeats(few)).union(window_repeats(many))


def remove_repeats(docs: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs`` (columns doc_id, text): doc_id, n_bytes, spans, kept.

    A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier: in a smaller
    doc_id, or before in the same text. Strings are those of the input, within one text's UTF-8
    bytes. spans are the maximal removed runs (begin, end); kept is what is left, as bytes. Null
    texts are empty. Rows that share a doc_id but not the text are ordered by a hash of the text, a
    null doc_id is the smallest; rows equal in both are one text and come back as often. Other
    columns are ignored; no rows give no rows.
    """
    numbered, texts = _numbered(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    spans = shared_table(removed_spans(repeated_ranges(texts)), "suffix-spans")
    small = broadcast_if_small(spans, "32 + 16 * size(spans)", max_broadcast_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sizes, found, kept = [], [], []
                for text, runs in zip(part["text"], part["spans"].to_pylist()):
                    data, runs = (text.as_py() or "").encode("utf-8", "surrogatepass"), runs or []
                    edges = [0, *(x for run in runs for x in (run["begin"], run["end"])), len(data)]
                    sizes.append(len(data))
                    found.append(runs)
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(found, _SPANS), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    joined = numbered.join(small, "doc", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
