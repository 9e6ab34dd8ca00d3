"""Benchmark decontamination by a broadcast hash set of normalised test n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WINDOW_WORDS = 10
MAX_BROADCAST_BYTES = 64 << 20
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOT_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def normalised_words(text: Column) -> Column:
    """Words of a text: runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z.

    ``lower`` does the same as the slower ``translate`` where all characters are ASCII.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _NOT_WORD), "")


def _hashes(length: int) -> str:
    """Hashes of all windows of ``length`` words, none if the text is shorter."""
    return (
        f"if(n_words >= {length}, transform(sequence(0, n_words - {length}),"
        f" i -> xxhash64(slice(words, i + 1, {length}))), array())"
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(h, entries): by hash, the distinct windows of all items and the items that hold each.

    An item of fewer than ``window`` words, but not none, is one window of its own length.
    """
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), normalised_words(_text("text")).alias("words")
    ).selectExpr("item", "words", f"least(size(words), {window}) AS len", "size(words) AS n_words")
    parts = words.where("len > 0").selectExpr(
        "item", "len", "explode(transform(sequence(0, n_words - len), i -> slice(words, i + 1, len))) AS part"
    )
    by_text = (
        parts.selectExpr("item", "len", "xxhash64(part) AS h", "array_join(part, ' ') AS text")
        .groupBy("h", "len", "text").agg(F.collect_set("item").alias("items"))
    )
    return by_text.groupBy("h").agg(F.collect_list(F.struct("len", "text", "items")).alias("entries"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
              max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, hits (pos, len), items, copies.

    Every window of every document is scanned against the hash set of the benchmark; a hash hit
    counts only if the words themselves are equal. The set is broadcast if its measured size is
    within ``max_broadcast_bytes``; beyond, windows and set meet in a shuffled join instead, with
    the same result. Documents are told apart by (doc_id, text); ``copies`` counts equal rows.
    """
    known = benchmark_windows(benchmark, window)
    sizes = known.selectExpr("explode(entries) AS e").selectExpr(
        "e.len AS len", "octet_length(e.text) + 16 * size(e.items) + 64 AS bytes"
    ).groupBy("len").agg(F.sum("bytes").alias("bytes")).collect()  # at most ``window`` rows
    lengths = sorted((row["len"] for row in sizes), reverse=True)
    small = sum(row["bytes"] for row in sizes) <= max_broadcast_bytes

    words = docs.select(
        F.col("doc_id"), F.xxhash64(_text("text")).alias("text_key"), normalised_words(_text("text")).alias("words")
    ).selectExpr("*", "size(words) AS n_words")
    if not lengths:
        return words.groupBy("doc_id", "text_key").agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies")).selectExpr(
            "doc_id", "text_key", "n_words", "CAST(array() AS array<struct<pos:int,len:int>>) AS hits",
            "CAST(array() AS array<string>) AS items", "copies",
        )
    all_hashes = _hashes(lengths[0]) if len(lengths) == 1 else f"concat({', '.join(map(_hashes, lengths))})"
    scanned = words.selectExpr("doc_id", "text_key", "n_words", "words", f"posexplode_outer({all_hashes}) AS (idx, h)")
    pos, length, before = "idx", str(lengths[0]), f"greatest(n_words - {lengths[0]} + 1, 0)"
    for size in lengths[1:]:
        pos = f"if(idx >= {before}, idx - ({before}), {pos})"
        length = f"if(idx >= {before}, {size}, {length})"
        before = f"{before} + greatest(n_words - {size} + 1, 0)"
    if small:
        found = scanned.join(F.broadcast(known), "h", "left")
        window_text = f"array_join(slice(words, {pos} + 1, {length}), ' ')"
    else:  # the words stay behind: each window carries its own text through the shuffle
        scanned = scanned.selectExpr(
            "doc_id", "text_key", "n_words", "idx", "h",
            f"if(idx IS NULL, NULL, array_join(slice(words, {pos} + 1, {length}), ' ')) AS window_text",
        )
        found, window_text = scanned.join(known, "h", "left"), "window_text"
    kept = found.where("entries IS NOT NULL OR idx IS NULL OR idx = 0").selectExpr(
        "doc_id", "text_key", "n_words", "idx", f"{pos} AS pos", f"{length} AS len",
        f"if(entries IS NULL, NULL, {window_text}) AS window_text", "entries",
    ).selectExpr(
        "doc_id", "text_key", "n_words", "idx", "pos", "len",
        "flatten(transform(filter(entries, e -> e.text = window_text), e -> e.items)) AS items",
        "exists(entries, e -> e.text = window_text) AS hit",
    )
    return (
        kept.groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.expr("collect_set(if(hit, struct(pos, len), NULL)) AS hits"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.expr("count_if(idx IS NULL OR idx = 0) AS copies"),
        )
    )


_COVERED = "array_distinct(flatten(transform(hits, x -> sequence(x.pos, x.pos + x.len - 1))))"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items, items, contaminated.

    A document word is hit if it lies in any occurrence of a window. Null and empty texts have no
    words and are clean, as is everything against an empty benchmark. Null item texts hold no
    window; an item without id marks words but is not listed. Equal rows come back as often as they
    occur, rows with a null doc_id too. Other columns are ignored. A text is cut into words as a whole,
    whatever its length; no documents give no rows.
    """
    found = find_hits(docs, benchmark, window, max_broadcast_bytes)
    return found.selectExpr(
        "doc_id", "text_key", "n_words", f"size({_COVERED}) AS n_hit", "array_sort(items) AS items", "copies",
    ).selectExpr(
        "doc_id", "text_key", "BIGINT(n_words) AS n_words", "BIGINT(n_hit) AS n_hit", "BIGINT(size(items)) AS n_items",
        "items", "n_hit > 0 AS contaminated", "explode(sequence(1L, copies)) AS copy",
    ).drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept."""
    bad = find_hits(docs, benchmark, window).where("size(hits) > 0").select(
        F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(_text("text")) == F.col("_bad_key"))
    return docs.join(bad, same, "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with the hit words, and what separates them from the next word, cut from the text.

    A null text without hits stays null; all other columns are kept as they are.
    """
    bad = find_hits(docs, benchmark, window).where("size(hits) > 0").selectExpr(
        "doc_id AS _bad_id", "text_key AS _bad_key", f"{_COVERED} AS _hit"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(_text("text")) == F.col("_bad_key"))
    joined = docs.join(bad, same, "left").withColumns({
        "_words": F.array_remove(F.split(_text("text"), _NOT_WORD_ANY_CASE), ""),
        "_gaps": F.regexp_extract_all(_text("text"), F.lit(_NOT_WORD_ANY_CASE), F.lit(0)),
        "_lead": F.regexp_extract(_text("text"), "^" + _NOT_WORD_ANY_CASE, 0),
    })
    kept = (
        "concat(_lead, array_join(transform(filter(sequence(0, size(_words) - 1), i -> NOT array_contains(_hit, i)),"
        " i -> concat(_words[i], coalesce(get(_gaps, i + if(_lead = '', 0, 1)), ''))), ''))"
    )
    return joined.withColumn("text", F.expr(f"if(_hit IS NULL, text, {kept})")).select(*docs.columns)
