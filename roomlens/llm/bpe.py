"""Byte-level BPE encoding and decoding with a two-tier lookup of pre-tokens."""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from roomlens.llm.common import emit_batches

MEMO_ENTRIES = 400_000
_CHUNK = 1 << 16  # pre-tokens looked up at a time
_BUCKET_KEYS = 4
# Unassigned characters some of which ``regex`` takes for letters; texts with them use a stricter class.
_PAST_LETTERS = "\U00033480-\U0010FFFF"
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a base64 token and its number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class PerfectHash:
    """Minimal perfect hash of a fixed key set by hashing to buckets and displacing them.

    ``n`` keys fill ``n`` slots. Buckets of several keys, largest first, take the first displacement
    that sends their keys to free slots; buckets of one key name a free slot directly.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // _BUCKET_KEYS)
        hashes = self._hash(keys)
        bucket = (hashes >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        slots = np.full(len(keys), -1, dtype=np.int64)  # slot -> key number
        sizes = np.diff(bounds)
        singles = []
        for b in np.argsort(-sizes, kind="stable"):
            members = order[bounds[b] : bounds[b + 1]]
            if len(members) < 2:
                singles += [(b, m) for m in members]
                continue
            tries = 0
            while True:
                shifts = np.arange(tries, tries + 64, dtype=np.int64)
                places = self._place(hashes[members][None, :], shifts[:, None])
                free = (slots[places] < 0).all(axis=1)
                ordered = np.sort(places, axis=1)
                free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if free.any():
                    first = int(np.argmax(free))
                    self.shift[b] = shifts[first]
                    slots[places[first]] = members
                    break
                tries += 64
        empty = np.nonzero(slots < 0)[0]
        for (b, member), slot in zip(singles, empty):
            self.shift[b] = -1 - slot
            slots[slot] = member
        self.keys = [keys[m] for m in slots]
        self.numbers = slots

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _place(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ (shift.astype(np.uint64) * _STEP)) * _MIX
        return ((mixed >> np.uint64(20)) % np.uint64(max(1, self.n))).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The number of each key, or -1 for what is not in the set."""
        if not self.n:
            return [-1] * len(keys)
        hashes = self._hash(keys)
        shift = self.shift[((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(shift < 0, -1 - shift, self._place(hashes, np.maximum(shift, 0)))
        found = self.numbers[slot].tolist()
        known = self.keys
        return [n if known[s] == k else -1 for k, s, n in zip(keys, slot.tolist(), found)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked pair merges first, the leftmost among equals.

    Bytes form a linked list; a heap holds the ranks of neighbouring pairs. An entry is stale if
    either of its parts has grown or gone since, which its recorded ends tell.
    """
    n = len(piece)
    ends = list(range(1, n + 1))  # part that starts at i ends at ends[i]; 0 once merged away
    before = list(range(-1, n - 1))
    heap = []
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, left, middle, right = heapq.heappop(heap)
        if ends[left] != middle or middle >= n or ends[middle] != right:
            continue
        ends[left], ends[middle] = right, 0
        if right < n:
            before[right] = left
            rank = get(piece[left : ends[right]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, right, ends[right]))
        if left:
            prior = before[left]
            rank = get(piece[prior:right])
            if rank is not None:
                heapq.heappush(heap, (rank, prior, left, right))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return ids


class Encoder:
    """Text to ids by a vocabulary; one per task, with a bounded memo of pre-tokens seen."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, index: PerfectHash | None = None):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        letters = rf"(?:(?![{_PAST_LETTERS}])\p{{L}})"
        others = rf"[^\s\p{{L}}\p{{N}}]"
        self.split_strictly = regex.compile(
            pattern.replace(others, rf"(?:{others}|[{_PAST_LETTERS}])").replace(r" ?\p{L}", f" ?{letters}")
        )
        self.past_letters = re.compile(f"[{_PAST_LETTERS}]")
        self.tokens = list(ranks)
        self.ids = list(ranks.values())
        self.index = index or PerfectHash(self.tokens)
        self.memo: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        if len(self.memo) + len(pieces) > MEMO_ENTRIES:
            self.memo.clear()
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        ids, ranks, memo = self.ids, self.ranks, self.memo
        for piece, data, number in zip(pieces, raw, self.index.find(raw)):
            if number >= 0:
                memo[piece] = ids[number].to_bytes(4, "little")
            else:
                memo[piece] = np.array(merge_bytes(data, ranks), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        split = self.split_strictly if self.past_letters.search(text) else self.split
        found = (m.group() for m in split.finditer(text)) if len(text) > 1 << 20 else iter(split.findall(text))
        out = []
        while pieces := list(islice(found, _CHUNK)):
            wanted = set(pieces)
            new = wanted.difference(self.memo)
            if new:
                if len(self.memo) + len(new) > MEMO_ENTRIES:
                    new = wanted  # the memo starts anew, so all of this chunk's pieces go in
                self._learn(list(new))
            out.append(b"".join(map(self.memo.__getitem__, pieces)))
        return b"".join(out)


_ENCODERS: dict[tuple, Encoder] = {}


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text; ids are little-endian unsigned 32-bit integers.

    The rank file (a vocabulary of bounded size) and its perfect hash go to the tasks by broadcast.
    Null is encoded like the empty text; repeated rows come back as often; a null doc_id is kept;
    other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    ranks = read_ranks(rank_file)
    shared = spark.sparkContext.broadcast((ranks, PerfectHash(list(ranks))))
    key = (rank_file, pattern)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:  # a Python worker serves many tasks
            vocabulary, index = shared.value
            _ENCODERS[key] = Encoder(vocabulary, pattern, index)
        encoder = _ENCODERS[key]

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                    ids = encoder.encode(text.as_py() or "")
                    yield doc_id, len(ids) // 4, ids

        yield from emit_batches(rows(), schema, lambda row: len(row[2]))

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, rank_file: str, keep_ids: bool = False) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ids stand for (null ids: null), for the column ids."""
    kept = [c for c in encoded.columns if keep_ids or c != "ids"]
    shared = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in read_ranks(rank_file).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [
                    b"".join(map(token, np.frombuffer(ids.as_buffer(), dtype="<u4").tolist())) if ids.is_valid else None
                    for ids in part["ids"]
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), pa.array(texts, pa.binary())], names=[*kept, "decoded"]
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in kept]
    return encoded.mapInArrow(run, ", ".join([*fields, "decoded binary"]))


def encode_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens and digests of its ids and of what they decode to."""
    hashed = encode(docs, rank_file, pattern).withColumn("ids_sha256", F.sha2("ids", 256))
    return decode(hashed, rank_file).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
