"""The trie of conversation prefixes, built from sorted neighbours.

Every conversation is a path of turn digests. Paths are range-partitioned and sorted, so those that share a prefix stand
together, and what two neighbours share (their LCP, in turns) is the depth of an edge between them. In each partition
the edges are united by union-find in descending depth: before an edge of depth d is taken, each component is the
subtree of a node deeper than d; two components that meet at d hang below one branching node at d. What lies between
one merge of a component and the next is a chain of nodes with equal members, so a partition holds one entry for each
merge, and its nodes are written out chain by chain.

Only prefixes of a partition's first and last path can go on in its neighbours. These nodes are left open: they leave
as partial sums under their prefix digest, without the subtrees that are complete. Partial sums of all partitions are
merged by digest, and the contracted forest that they form (at most two paths for a partition) is summed up from its
deepest level to the root, holding one level at a time.

Equal paths may be any share of all rows: the sort goes on by conversation id, so they spread over partitions.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import cut, small

#: Bytes of a turn's digest; ids in one piece of a node's list of ends.
MARK, PIECE = 16, 1 << 14
_CLOSED, _OPEN, _ENDS = 0, 1, 2
_PARTS = pa.schema(
    [
        ("kind", pa.int32()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("size", pa.int64()),
        ("ends", pa.string()),
    ]
)
SCHEMA = (
    "kind int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, size long, ends string"
)
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, each with a digest of role and text and the bytes of
    its text. A null role or text is empty, a null turn number comes first, ties go by digest. Rows without conv_id
    belong to no conversation and are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct(F.col("turn"), mark.alias("mark"), F.octet_length(text).cast("long").alias("size"))
    known = conversations.where(F.col("conv_id").isNotNull())
    known = known.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return known.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // MARK
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // MARK


def _keys(path: bytes) -> list[bytes]:
    """The digests of all prefixes of a path, by depth."""
    state, out = hashlib.md5(), [hashlib.md5().digest()]
    for at in range(0, len(path), MARK):
        state.update(path[at : at + MARK])
        out.append(state.copy().digest())
    return out


class Forest:
    """The distinct paths of one partition in order, then its nodes as rows of ``_PARTS``."""

    def __init__(self) -> None:
        self.depth, self.shared, self.copies, self.least = array("q"), array("q"), array("q"), array("q")
        #: Bytes of the turns by which a path goes beyond its left neighbour, and where they start.
        self.sizes, self.at = array("q"), array("q")
        #: By path, the hash of the ids that end there; None if they leave in pieces, under the path's digest.
        self.ends: list[str | None] = []
        self.pieced: dict[int, bytes] = {}
        self.first = self.last = b""
        self.ids: list[int] = []

    def _piece(self) -> tuple:
        """Ids of the current path as a row of their own."""
        self.ends[-1] = None
        key = self.pieced.setdefault(len(self.ends) - 1, hashlib.md5(self.last).digest())
        ids, self.ids = self.ids, []
        return (_ENDS, key, None, None, ids[0], None, None, None, None, None, None, ",".join(map(str, ids)))

    def add(self, conv_id: int, path: bytes, sizes: list[int]) -> Iterator[tuple]:
        """Takes the next path, in order; gives the pieces of ids that must leave."""
        if self.ends and path == self.last:
            self.copies[-1] += 1
        else:
            if self.ends and (len(self.ends) == 1 or self.pieced.get(len(self.ends) - 1)):
                if self.ids:  # the first path may have begun in the partition before
                    yield self._piece()
            elif self.ends:
                self.ends[-1] = hashlib.sha256(",".join(map(str, self.ids)).encode()).hexdigest()
            else:
                self.first = path
            shared = common_turns(self.last, path) if self.ends else 0
            self.shared.append(shared)
            self.depth.append(len(path) // MARK)
            self.copies.append(1)
            self.least.append(conv_id)
            self.at.append(len(self.sizes))
            self.sizes.extend(sizes[shared:])
            self.ends.append(None)
            self.last, self.ids = path, []
        self.ids.append(conv_id)
        if len(self.ids) >= PIECE:
            yield self._piece()

    def nodes(self) -> Iterator[list]:
        """All nodes, by union-find over the edges between neighbours in descending depth."""
        if self.ids:
            yield self._piece()
        n, end = len(self.depth), len(self.depth) - 1
        left_keys, right_keys = _keys(self.first), _keys(self.last)
        up = list(range(n))
        top = [d + 1 for d in self.depth]  # nodes from here on are written out
        members, least, right = list(self.copies), list(self.least), list(range(n))
        children, leaves, saved = [0] * n, [0] * n, [0] * n  # complete subtrees below the node at top - 1
        hanging: list[list[list]] = [[] for _ in range(n)]  # their topmost rows, which wait for that node's least id

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        def chain(r: int, low: int) -> tuple[list[list], tuple[int, int, int, list[list]]]:
            """Rows of component ``r`` from its top down to depth ``low``, and what its parent gets: children, leaves,
            saved, and the row that waits."""
            high, rows = top[r] - 1, []
            begin, skip = self.at[r], self.shared[r] + 1
            if r == 0 or right[r] == end:
                keys = left_keys if r == 0 else right_keys
                for row in hanging[r]:
                    row[2] = keys[high]
                below = (children[r], leaves[r], saved[r])
                for d in range(high, low - 1, -1):
                    size = self.sizes[begin + d - skip] if d else 0
                    ends = self.ends[r] if d == self.depth[r] else None
                    rows.append([_OPEN, keys[d], keys[d - 1] if d else None, d, least[r], None, members[r], *below, size, ends])
                    below = (0, 0, 0)
                return rows + hanging[r], (0, 0, 0, [])
            for row in hanging[r]:
                row[5] = least[r]
            kids, below, total = children[r], leaves[r] or 1, saved[r]
            for d in range(high, low - 1, -1):
                total += (members[r] - 1) * self.sizes[begin + d - skip]
                ends = self.ends[r] if d == self.depth[r] else _NO_ENDS
                key = self.pieced[r] if ends is None else None
                rows.append([_CLOSED, key, None, d, least[r], least[r], members[r], kids, below, total, None, ends])
                kids = 1
            rows[-1][5] = None  # its parent may have more members yet
            return rows[:-1] + hanging[r], (1, below, total, rows[-1:])

        edges = np.frombuffer(self.shared, np.int64)[1:]
        for edge in np.argsort(-edges, kind="stable").tolist():
            a, b, depth = find(edge), find(edge + 1), int(edges[edge])
            for r in (a, b):
                if top[r] - 1 > depth:
                    rows, (kids, below, total, waits) = chain(r, depth + 1)
                    yield from rows
                    children[r], leaves[r], saved[r], hanging[r] = 0, 0, 0, []
                    children[a] += kids
                    leaves[a] += below
                    saved[a] += total
                    hanging[a] += waits
            up[b], top[a], right[a] = a, depth + 1, right[b]
            members[a] += members[b]
            least[a] = min(least[a], least[b])
        yield from chain(0, 0)[0]


def _packed(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS)], schema=_PARTS)


def _partial_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, rows = Forest(), []
    for batch in batches:
        for conv_id, path, sizes in zip(*(c.to_pylist() for c in batch.columns)):
            rows += forest.add(conv_id, path, sizes)
            if len(rows) >= 100:
                yield _packed(rows)
                rows = []
    if forest.ends:
        for row in forest.nodes():
            rows.append(row)
            if len(rows) >= 10_000:
                yield _packed(rows)
                rows = []
    if rows:
        yield _packed(rows)


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes, deepest first: each adds its sums to its parent. Held is what one level gives to the next."""
    waiting: dict[bytes, tuple[int, int, int]] = {}
    for batch in batches:
        rows = []
        for key, parent, depth, least, n, kids, leaves, saved, size, ends in zip(*(c.to_pylist() for c in batch.columns)):
            more = waiting.pop(key, (0, 0, 0))
            kids, leaves = kids + more[0], leaves + more[1]
            leaves = leaves if kids else 1
            saved += more[2] + (n - 1) * size
            if parent is not None:
                held = waiting.get(parent, (0, 0, 0))
                waiting[parent] = (held[0] + 1, held[1] + leaves, held[2] + saved)
            rows.append((_OPEN, key, parent, depth, least, None, n, kids, leaves, saved, size, ends))
        if rows:
            yield _packed(rows)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's pieces, which follow each other; one piece is held."""
    last, state = None, None
    for batch in batches:
        keys, out = [], []
        for key, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if key == last:
                state.update(b"," + ends.encode())
                continue
            if last is not None:
                keys.append(last)
                out.append(state.hexdigest())
            last, state = key, hashlib.sha256(ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["_key", "_sha"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["_key", "_sha"])


def trie(paths: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``paths`` (conv_id, turns as :func:`sequences` gives them).

    A node is a distinct sequence of first turns; the root is the empty one. ``conv_id`` is the least id of its members,
    the conversations that begin with it, ``parent_conv_id`` that of its parent's members (null for the root);
    ``n_convs`` counts members, ``n_children`` children, ``n_leaves`` the childless nodes of its subtree, itself
    included; ``saved_tokens`` sums, over its subtree, the bytes of a node's last text for each member but one;
    ``ends_sha256`` hashes the ids, ascending and joined by commas, of the members that end at the node. A conversation
    without turns ends at the root; without any conversation there is no node. ``conv_id`` must be unique and not null.

    A task holds a few dozen bytes for each turn that no neighbouring path shares, and one conversation's digests.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["mark"]), ""))
    rows = paths.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    rows = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = cut(rows.mapInArrow(_partial_nodes, SCHEMA))

    opened = parts.where(F.col("kind") == _OPEN).groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("size").alias("size"), F.max("ends").alias("ends"),
    )
    opened = opened.repartition(1).sortWithinPartitions(F.desc("depth"))
    shared = cut(opened.mapInArrow(_summed_up, SCHEMA))
    pieces = parts.where(F.col("kind") == _ENDS).select("key", "conv_id", "ends").repartition("key")
    hashes = cut(pieces.sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(_hashed, "_key binary, _sha string"))

    def node(parent: Column, ends: Column) -> list[Column]:
        own = {"parent_conv_id": parent, "ends_sha256": ends}
        return [own.get(c, F.col(c)).alias(c) for c in _NODE]

    closed = parts.where(F.col("kind") == _CLOSED)
    alone = F.col("key").isNull() & F.col("parent_key").isNull()
    parents = shared.select(F.col("key").alias("_parent"), F.col("conv_id").alias("_least"))
    parents, hashes = small(parents, parents.count(), 64), small(hashes, hashes.count(), 160)
    tied = closed.where(~alone).unionByName(shared)
    tied = tied.join(parents, tied["parent_key"] == parents["_parent"], "left")
    tied = tied.join(hashes, tied["key"] == hashes["_key"], "left")
    return closed.where(alone).select(node(F.col("parent_conv_id"), F.col("ends"))).unionByName(
        tied.select(node(F.coalesce("parent_conv_id", "_least"), F.coalesce("ends", "_sha", F.lit(_NO_ENDS))))
    )
