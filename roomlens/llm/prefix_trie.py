"""The trie of conversations that begin alike, built as ternary search trees over range shards."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from roomlens.llm.common import broadcast_if_small, emit_batches
from roomlens.sources.scratch import shared_table

SHARD_TURNS = 400_000  # turns a shard holds, about

Head = Callable[[Column], tuple[Column, Column]]

_NODE = "shard int, at long, parent long, parent_conv_id long, inner boolean, turn long, chars long, depth int, conv_id long, " \
    "n_convs long, ends_sha256 string, n_children long, n_leaves long, saved long"
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """Keys are sequences of numbers. Every trie node holds a binary search tree of its children.

    All nodes lie in lists: ``turn`` is the number that leads to a node, ``low`` and ``high`` are its
    smaller and greater siblings, ``down`` is the root of the search tree of its children; 0 is none, as
    node 0 is the trie's root and nobody's child.
    """

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.down = [-1], [0], [0], [0]
        self.parent, self.chars = [-1], [0]

    def insert(self, key: list[int], chars: list[int]) -> int:
        """The node of ``key``, made with all above it where missing."""
        turn, low, high, down = self.turn, self.low, self.high, self.down
        node = 0
        for number, size in zip(key, chars):
            at = down[node]
            if not at:
                at = down[node] = self._new(number, size, node)
            while turn[at] != number:
                side = low if number < turn[at] else high
                if not side[at]:
                    side[at] = self._new(number, size, node)
                at = side[at]
            node = at
        return node

    def _new(self, number: int, size: int, parent: int) -> int:
        for column, value in (
            (self.turn, number), (self.low, 0), (self.high, 0), (self.down, 0), (self.parent, parent), (self.chars, size)
        ):
            column.append(value)
        return len(self.turn) - 1

    def children(self, node: int) -> Iterator[int]:
        """Children in order, walked without recursion."""
        path, at = [], self.down[node]
        while path or at:
            while at:
                path.append(at)
                at = self.low[at]
            at = path.pop()
            yield at
            at = self.high[at]

    def preorder(self) -> list[int]:
        """All trie nodes, each before those below it, without recursion."""
        order, left = [], [0]
        while left:
            node = left.pop()
            order.append(node)
            left += list(self.children(node))[::-1]
        return order

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]


def medians_first(n: int) -> Iterator[int]:
    """0..n-1: the middle one, then the middles of both halves, and so on."""
    level = [(0, n)]
    while level:
        halves = []
        for start, end in level:
            if start < end:
                middle = (start + end) // 2
                yield middle
                halves += [(start, middle), (middle + 1, end)]
        level = halves


def shard_nodes(shard: int, rows: list[tuple]) -> Iterator[tuple]:
    """Nodes of the trie of a shard's sorted (turns, chars, n, conv_id, ends) rows, each before its children.

    Sums of nodes on the paths to the first and the last row are partial: neighbouring shards may hold
    the same nodes. These come out with ``inner`` false, without their own part in leaves and savings.
    """
    tree = TernaryTree()
    ends: dict[int, tuple] = {}
    for place in medians_first(len(rows)):
        turns, chars, *told = rows[place]
        ends[tree.insert(turns, chars)] = told
    first, last = (tree.path(tree.insert(row[0], row[1])) for row in (rows[0], rows[-1]))
    shared = {*first, *last}
    n = len(tree.turn)
    members, least, children, leaves, saved, depth = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n, [0] * n
    order = tree.preorder()
    for node in order[1:]:
        depth[node] = depth[tree.parent[node]] + 1
    for node in reversed(order):
        if node in ends:
            members[node] += ends[node][0]
            least[node] = ends[node][1] if least[node] is None else min(least[node], ends[node][1])
        if node not in shared:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.chars[node]
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            if node not in shared:
                children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    for node in sorted(shared, key=depth.__getitem__):  # partial sums of their own, without those below
        for up in (tree.parent[node],) if node else ():
            members[up], leaves[up], saved[up] = members[up] - members[node], leaves[up] - leaves[node], saved[up] - saved[node]
    place = {node: at for at, node in enumerate(order)}
    for at, node in enumerate(order):
        up = tree.parent[node]
        yield (
            shard, at, place.get(up), None if up < 0 or up in shared else least[up], node not in shared, tree.turn[node], tree.chars[node],
            depth[node], least[node], members[node], ends[node][2] if node in ends else _EMPTY_SHA, children[node], leaves[node], saved[node],
        )


def merge_boundary(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Whole nodes from the partial nodes of all shards, in shard order, each shard's in order of its tree.

    That is the order of one walk through their common trie: a stack of the nodes above is all that is
    held. Nodes are numbered; a second kind of row tells the number of each partial node.
    """
    stack: list[list] = []  # number, parent, turn, chars, depth, conv_id, n_convs, ends, n_children, n_leaves, saved
    number = -1

    def close() -> tuple:
        node = stack.pop()
        if not node[8]:
            node[9] += 1
        node[10] += (node[6] - 1) * node[3]
        if stack:
            up = stack[-1]
            up[5] = min(up[5], node[5])
            up[6] += node[6]
            up[8] += 1
            up[9] += node[9]
            up[10] += node[10]
        return (None, None, *node)

    for shard, at, _, _, _, turn, chars, depth, conv_id, n_convs, ends, children, leaves, saved in rows:
        if len(stack) > depth and stack[depth][2] != turn:
            while len(stack) > depth:
                yield close()
        if len(stack) > depth:
            node = stack[depth]
            node[5] = min(node[5], conv_id)
            if ends != _EMPTY_SHA:
                node[7] = ends
            node[6] += n_convs
            for i, more in zip((8, 9, 10), (children, leaves, saved)):
                node[i] += more
        else:
            number += 1
            stack.append([number, stack[-1][0] if stack else None, turn, chars, depth, conv_id, n_convs, ends, children, leaves, saved])
        yield (shard, at, stack[depth][0], *[None] * 10)
    while stack:
        yield close()


_MERGED = "shard int, at long, number long, above long, turn long, chars long, depth int, conv_id long, n_convs long, " \
    "ends_sha256 string, n_children long, n_leaves long, saved long"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def encoded_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, chars) of the turns of all conversations, positions from 1.

    Turns of equal role and text share an id: the row number of a stored table of distinct turns,
    which are told apart by SHA-256.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = (
        turns.where("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("long"), F.col("turn"), role.alias("role"), text.alias("text"))
        .withColumn("pos", F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)"))
        .select(
            "conv_id", "pos", F.length("text").cast("long").alias("chars"),
            F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("said"),
        )
    )
    placed = shared_table(said, "trie-turns")
    numbered = shared_table(
        placed.select("said").distinct().select("said", F.monotonically_increasing_id().alias("turn_id")), "trie-dictionary"
    )
    return placed.join(broadcast_if_small(numbered, "48"), "said").select("conv_id", "pos", "turn_id", "chars")


def sequences(turns: DataFrame, head: Head | None = None) -> DataFrame:
    """(conv_id, turns, chars): each conversation as arrays of turn ids and text lengths.

    ``head`` tells, from conv_id, another conversation and how many of its first turns stand in the
    place of as many of the conversation's own (all if it has fewer, none if it is missing).
    """
    own = shared_table(
        encoded_turns(turns).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "turn_id", "chars"))).alias("s"))
        .select("conv_id", F.col("s.turn_id").alias("turns"), F.col("s.chars").alias("chars")),
        "trie-conversations",
    )
    if head is None:
        return own
    other, count = head(F.col("conv_id"))
    wanted = own.withColumns({"other": other, "h": count.cast("int")})
    begins = own.select(F.col("conv_id").alias("other"), F.col("turns").alias("t"), F.col("chars").alias("c"))
    most = wanted.agg(F.max("h")).first()[0] or 0
    begins = begins.select("other", *(F.slice(c, 1, max(1, most)).alias(c) for c in ("t", "c")))

    def joined(mine: str, theirs: str) -> Column:
        return F.expr(
            f"concat(CASE WHEN h > 0 THEN coalesce(slice({theirs}, 1, h), slice({mine}, 1, 0)) ELSE slice({mine}, 1, 0) END, "
            f"slice({mine}, h + 1, greatest(size({mine}) - h, 0)))"
        )

    return wanted.join(begins, "other", "left").select("conv_id", joined("turns", "t").alias("turns"), joined("chars", "c").alias("chars"))


def distinct_sequences(given: DataFrame) -> DataFrame:
    """(turns, chars, n, conv_id, ends_sha256) of each distinct sequence: its conversations' number, least id
    and the digest of their ids, in order and comma-joined.

    The ids of one sequence are read in order, so however many share it, a task holds none of them.
    """
    dealt = given.repartition("turns").sortWithinPartitions("turns", "conv_id")
    schema = pa.schema([
        ("turns", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64())), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())
    ])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for batch in batches:
            for turns, chars, conv_id in zip(*(batch[c].to_pylist() for c in ("turns", "chars", "conv_id"))):
                if now is None or turns != now[0]:
                    if now is not None:
                        yield (*now, digest.hexdigest())
                    now = [turns, chars, 1, conv_id]
                    digest = hashlib.sha256(str(conv_id).encode())
                else:
                    now[2] += 1
                    digest.update(f",{conv_id}".encode())
        if now is not None:
            yield (*now, digest.hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit_batches(rows(batches), schema, lambda r: 16 * len(r[0]) + 100)

    return dealt.select("turns", "chars", "conv_id").mapInArrow(
        run, "turns array<bigint>, chars array<bigint>, n long, conv_id long, ends_sha256 string"
    )


def trie(turns: DataFrame, head: Head | None = None, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``turns`` has rows (conv_id, turn, role, text); ``head`` rebuilds conversations, see ``sequences``. A
    node is a distinct sequence of first turns, the root the empty one. conv_id is its smallest member;
    parent_conv_id that of its parent, null for the root; n_convs counts members, n_children children,
    n_leaves the childless nodes of its subtree; saved_tokens adds up, over its subtree, characters of a
    node's last text times members but one; ends_sha256 is over the ids of members with no further turn.

    Turns become dictionary ids, equal conversations one sequence, and sequences are cut into shards by
    range. A task builds a ternary search tree of its shard, medians first, and walks it without
    recursion. Only nodes above a shard's first and last sequence can lie in two shards; these, two paths
    a shard, are merged by one task that reads them in order and holds one path. Turns are ordered by
    turn (null first), role and text; null role or text is empty; rows without a conv_id belong to no
    conversation; repeated rows are turns of their own; texts of any length and extra columns are fine.
    Without any conversation there is no node.
    """
    distinct = shared_table(distinct_sequences(sequences(turns, head)), "trie-sequences")
    size = distinct.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    shards = max(1, -(-size // shard_turns))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            found = shard_nodes(TaskContext.get().partitionId(), rows)
            yield from emit_batches(found, _arrow(_NODE), lambda _: 150)

    ranged = distinct.repartitionByRange(shards, "turns").sortWithinPartitions("turns")
    nodes = shared_table(ranged.mapInArrow(build, _NODE), "trie-nodes")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from emit_batches(merge_boundary(partial), _arrow(_MERGED), lambda _: 150)

    boundary = nodes.where("NOT inner").repartition(1).sortWithinPartitions("shard", "at")
    merged = shared_table(boundary.mapInArrow(merge, _MERGED), "trie-boundary")
    whole = merged.where("shard IS NULL")
    above = whole.select(F.col("number").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    numbers = merged.where("shard IS NOT NULL").select("shard", F.col("at").alias("parent"), F.col("number").alias("above"))
    parents = shared_table(
        numbers.join(above, "above").select("shard", "parent", F.col("parent_conv_id").alias("merged")), "trie-parents"
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    inner = nodes.where("inner").join(broadcast_if_small(parents, "32"), ["shard", "parent"], "left")
    found = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "merged")).select(columns).union(
        whole.join(above, "above", "left").select(columns)
    )
    return found.withColumnRenamed("saved", "saved_tokens").withColumn("depth", F.col("depth").cast("long"))
