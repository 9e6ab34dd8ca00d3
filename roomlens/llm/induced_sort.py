"""Suffix array of one shard by external induced sorting, with common-prefix values.

Left-most S-suffixes are sorted first; scanning the sorted suffixes upwards then induces the order of
all L-suffixes, and scanning those downwards that of all S-suffixes. What a scan finds goes to a
priority queue by first byte and order of arrival, whose content moves to disk beyond a memory limit.
Every tuple carries the length it has in common with its predecessor, up to ``depth``: one more than
the least such value between the two suffixes that induced the pair. Order and values are exact for
the first ``depth`` bytes, which is all that finding repeats of that length needs, so the left-most
S-suffixes are sorted by words up to that depth instead of by recursion on their full length.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

_WORD = 8
_BYTES = 256
_POSITION = np.dtype(np.int64)
_COMMON = np.dtype(np.int16)


class DiskQueue:
    """Priority queue of (position, common) tuples by byte, first in first out for equal bytes.

    Tuples wait in memory up to ``memory_bytes`` over all bytes; then all of them are appended to a
    nameless temporary file, which ends with the task. ``pop`` gives back the batches of one byte.
    """

    def __init__(self, memory_bytes: int):
        self.limit, self.held = memory_bytes, 0
        self.memory: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(_BYTES)]
        self.spilled: list[list[tuple[int, int]]] = [[] for _ in range(_BYTES)]
        self.file = None

    def push(self, byte: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.memory[byte].append((positions, common))
        self.held += positions.nbytes + common.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for byte, batches in enumerate(self.memory):
            if batches:
                positions = np.concatenate([b[0] for b in batches])
                self.spilled[byte].append((self.file.tell(), len(positions)))
                self.file.write(positions.astype(_POSITION).tobytes())
                self.file.write(np.concatenate([b[1] for b in batches]).astype(_COMMON).tobytes())
                batches.clear()
        self.held = 0

    def pop(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of ``byte`` in order of arrival, those pushed meanwhile included."""
        while self.spilled[byte] or self.memory[byte]:
            if self.spilled[byte]:
                at, size = self.spilled[byte].pop(0)
                self.file.seek(at)
                positions = np.frombuffer(self.file.read(size * _POSITION.itemsize), _POSITION)
                common = np.frombuffer(self.file.read(size * _COMMON.itemsize), _COMMON)
            else:
                batches, self.memory[byte] = self.memory[byte], []
                positions = np.concatenate([b[0] for b in batches])
                common = np.concatenate([b[1] for b in batches])
                self.held -= positions.nbytes + common.nbytes
            yield positions, common

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class InducedSort:
    """Sorts the suffixes of ``text`` (bytes) by their first ``depth`` bytes."""

    def __init__(self, text: np.ndarray, depth: int, memory_bytes: int = 32 << 20):
        self.text, self.depth, self.memory_bytes = text, depth, memory_bytes
        self.padded = np.concatenate([text, np.zeros(depth + 2 * _WORD, np.uint8)])

    def _words(self, positions: np.ndarray, word: int) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(self.padded, _WORD)
        taken = windows[np.minimum(positions + word * _WORD, len(self.padded) - _WORD)]
        return np.ascontiguousarray(taken).view(">u8").ravel().astype(np.uint64)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that suffixes at ``a`` and ``b`` have in common, ``depth`` at most, pair by pair."""
        out = np.zeros(len(a), _COMMON)
        left = np.arange(len(a))
        for word in range(-(-self.depth // _WORD)):
            if not len(left):
                break
            differ = self._words(a[left], word) ^ self._words(b[left], word)
            same = differ == 0
            out[left[same]] = (word + 1) * _WORD
            rest = differ[~same]
            lead = (_WORD * 8 - np.ceil(np.log2(rest.astype(np.float64) + 1))).astype(np.int64) // 8
            # a float may round a value up to the next power of two: look at the byte in doubt
            lead += (rest >> ((7 - np.minimum(lead, 7)) * 8).astype(np.uint64)) & np.uint64(0xFF) == 0
            out[left[~same]] = word * _WORD + lead
            left = left[same]
        limit = np.minimum(self.depth, len(self.text) - np.maximum(a, b)).astype(_COMMON)
        return np.minimum(out, limit)

    def _is_s(self) -> np.ndarray:
        """Whether each suffix is smaller than the next one; the end of the text is smallest."""
        step = np.diff(self.text.astype(np.int16), append=np.int16(-1))
        changes = np.nonzero(step)[0]
        return step[changes[np.searchsorted(changes, np.arange(len(self.text)))]] > 0

    def _sorted_leftmost(self, is_s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left-most S-suffixes in order, each with what it has in common with the one before."""
        found = np.nonzero(is_s[1:] & ~is_s[:-1])[0] + 1
        key = self._words(found, 0)
        order = np.argsort(key, kind="stable")
        found, key = found[order], key[order]
        group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
        for word in range(1, -(-self.depth // _WORD)):
            tied = np.zeros(len(found), dtype=bool)
            equal = group[1:] == group[:-1]
            tied[1:] |= equal
            tied[:-1] |= equal
            slots = np.nonzero(tied)[0]
            if not len(slots):
                break
            key = self._words(found[slots], word)
            order = np.lexsort((key, group[slots]))
            found[slots], key = found[slots[order]], key[order]
            change = np.zeros(len(found), dtype=np.int64)
            change[1:] = group[1:] != group[:-1]
            change[slots[1:]] |= key[1:] != key[:-1]
            group = np.cumsum(change)
        common = np.zeros(len(found), _COMMON)
        common[1:] = self._common(found[:-1], found[1:])
        return found, common

    def _induce(self, queue: DiskQueue, least: np.ndarray, positions: np.ndarray, common: np.ndarray,
                wanted: np.ndarray) -> None:
        """Queue the suffixes before ``positions`` where ``wanted``, by first byte in stable order."""
        low = np.minimum.accumulate(common)
        picked = np.nonzero(wanted)[0]
        if len(picked):
            targets = self.text[positions[picked] - 1]
            order = np.argsort(targets, kind="stable")
            picked, targets = picked[order], targets[order]
            first = np.r_[True, targets[1:] != targets[:-1]]
            shared = np.empty(len(picked), _COMMON)
            again = np.nonzero(~first)[0]
            shared[again] = _range_least(common, picked[again - 1] + 1, picked[again])
            shared[first] = np.minimum(least[targets[first]], low[picked[first]])
            shared = np.minimum(shared + 1, self.depth).astype(_COMMON)
            bounds = np.r_[np.nonzero(first)[0], len(picked)]
            tail = np.r_[np.minimum.accumulate(common[::-1])[::-1], _COMMON.type(self.depth)]
            np.minimum(least, low[-1], out=least)
            for start, end in zip(bounds[:-1], bounds[1:]):
                queue.push(int(targets[start]), positions[picked[start:end]] - 1, shared[start:end])
            least[targets[bounds[1:] - 1]] = tail[picked[bounds[1:] - 1] + 1]
        else:
            np.minimum(least, low[-1], out=least)

    def buckets(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Suffixes in descending order of their first byte: positions in ascending order within a
        byte, and what each has in common with the one before it (0 for a byte's first)."""
        text, n = self.text, len(self.text)
        if not n:
            return
        is_s = self._is_s()
        leftmost, leftmost_common = self._sorted_leftmost(is_s)
        del is_s
        starts = np.searchsorted(text[leftmost], np.arange(_BYTES + 1))
        rising, sorted_l, falling = DiskQueue(self.memory_bytes), DiskQueue(self.memory_bytes), DiskQueue(self.memory_bytes)
        try:
            least = np.full(_BYTES, -1, _COMMON)
            rising.push(int(text[-1]), np.array([n - 1]), np.zeros(1, _COMMON))
            least[text[-1]] = 0
            for byte in range(_BYTES):
                last = None
                for positions, common in rising.pop(byte):
                    sorted_l.push(byte, positions, common)
                    before = text[positions - 1]
                    self._induce(rising, least, positions, common, (positions > 0) & (before >= byte))
                    last = positions[-1:]
                positions = leftmost[starts[byte] : starts[byte + 1]]
                if len(positions):
                    common = leftmost_common[starts[byte] : starts[byte + 1]].copy()
                    common[0] = 0 if last is None else self._common(last, positions[:1])[0]
                    self._induce(rising, least, positions, common, np.ones(len(positions), dtype=bool))
            del leftmost, leftmost_common
            least = np.full(_BYTES, -1, _COMMON)
            for byte in range(_BYTES - 1, -1, -1):
                small = []  # S-suffixes, descending
                for positions, common in falling.pop(byte):
                    small.append((positions, common))
                    before = text[positions - 1]
                    self._induce(falling, least, positions, common, (positions > 0) & (before <= byte))
                large = list(sorted_l.pop(byte))
                up, up_common = _joined(large)
                down, down_common = _joined(small)
                seam = self._common(up[-1:], down[-1:])[0] if len(up) and len(down) else _COMMON.type(0)
                if len(up):
                    falling_common = np.r_[up_common[1:], _COMMON.type(0)][::-1].copy()
                    falling_common[0] = seam
                    back = up[::-1]
                    self._induce(falling, least, back, falling_common, (back > 0) & (text[back - 1] < byte))
                if len(up) or len(down):
                    # down[i] shares down_common[i] with down[i - 1], its successor in ascending order
                    risen = np.r_[_COMMON.type(0), down_common[1:][::-1]] if len(down) else down_common
                    if len(up) and len(down):
                        risen[0] = seam
                    yield np.r_[up, down[::-1]], np.r_[up_common, risen]
        finally:
            for queue in (rising, sorted_l, falling):
                queue.close()


def _joined(batches: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not batches:
        return np.zeros(0, _POSITION), np.zeros(0, _COMMON)
    return np.concatenate([b[0] for b in batches]), np.concatenate([b[1] for b in batches])


def _range_least(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[start..end] (both included, start <= end) for each pair, by doubling."""
    out = np.empty(len(start), values.dtype)
    size = end - start + 1
    level = np.frexp(size.astype(np.float64))[1] - 1  # floor(log2(size))
    table, width = values, 1
    for step in range(int(level.max(initial=-1)) + 1):
        at = np.nonzero(level == step)[0]
        if len(at):
            out[at] = np.minimum(table[start[at]], table[end[at] - width + 1])
        if width < len(values):
            table = np.minimum(table[:-width], table[width:])
            width *= 2
    return out
