"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def components(nodes, linked) -> dict:
    """Smallest node of each node's component under the relation ``linked``."""
    nodes = sorted(nodes)
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def conversations(rows) -> dict:
    """conv_id -> (n_turns, turns, trained text) from (conv_id, turn, role, text) rows."""
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        groups[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, turns in groups.items():
        turns.sort()
        out[conv_id] = (
            len(turns), "".join(f"{r}\n{t}\n" for _, _, r, t in turns), "".join(t for _, _, r, t in turns if r == "assistant")
        )
    return out


def repeats(rows, length=100) -> dict:
    """doc_id -> (bytes, removed bytes, runs, rest) from (doc_id, text) rows."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                covered[at : at + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i in range(len(data)) if covered[i] and (i == 0 or not covered[i - 1]))
        out[doc_id] = (len(data), sum(covered), runs, bytes(b for b, c in zip(data, covered) if not c))
    return out


_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text) -> list[str]:
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contamination(docs, items, size=10) -> list:
    """(doc_id, n_words, n_hit, items) of (doc_id, text) rows against (item_id, text) rows."""
    windows = defaultdict(set)
    for item, text in items:
        found = words(text)
        length = min(size, len(found))
        for i in range(len(found) - length + 1 if length else 0):
            windows[tuple(found[i : i + length])].add(item)
    out = []
    for doc_id, text in docs:
        found, hit, which = words(text), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(found) - length + 1):
                if tuple(found[i : i + length]) in windows:
                    hit |= set(range(i, i + length))
                    which |= windows[tuple(found[i : i + length])] - {None}
        out.append((doc_id, len(found), len(hit), sorted(map(str, which))))
    return out


def fingerprint(text, size=4) -> int:
    import xxhash

    found = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def jaccard(a: str, b: str, size=8) -> float:
    x, y = ({line[i : i + size] for i in range(max(1, len(line) - size + 1))} for line in (a, b))
    return len(x & y) / len(x | y)


def dedup_lines(rows, threshold=0.8, size=8) -> dict:
    """doc_id -> text with one line kept of each component, from (doc_id, text) rows."""
    places = defaultdict(list)
    for doc_id, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r"):
                places[line.strip(" \t\r")].append((doc_id, at))
    sets = {x: {x[i : i + size] for i in range(max(1, len(x) - size + 1))} for x in places}

    def linked(a, b):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) < threshold * max(len(x), len(y)):
            return False
        common = len(x & y)
        return common >= threshold * (len(x) + len(y) - common)

    root = components(places, linked)
    groups = defaultdict(list)
    for line, found in places.items():
        groups[root[line]] += found
    gone = {place for found in groups.values() for place in found if place != min(found)}
    return {
        doc_id: None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc_id, i) not in gone)
        for doc_id, text in rows
    }
