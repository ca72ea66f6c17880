"""Token ids, packed into rows of fixed length.

Texts are encoded, cut losslessly into pieces of at most ``length`` ids, and the pieces are packed by best-fit
decreasing: longest first, each into the open row with the least room that still takes it. That row is found by a
segment tree over the room left (0 to ``length``), in log(length) steps.

Packing needs no shuffle: every task packs what it reads, in windows of at most ``window`` ids, so that its memory
is bounded; pieces of full length need no search and leave at once. A task run again packs the same rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from seriesship.llm.common import slices

SCHEMA = (
    "pack_id long, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, doc_offsets array<long>"
)
_ARROW = pa.schema(
    [
        ("pack_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("position_ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_offsets", pa.list_(pa.int64())),
    ]
)
#: White space as the encoder's pattern has it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs that the encoder's own pattern never joins: it can take them one by one.
_RUN = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Characters of a text that the encoder is given at once; of a longer one it is given run by run.
AT_ONCE = 1 << 20


class Room:
    """Open rows by the room they have left; :meth:`take` finds the least room that is enough."""

    def __init__(self, length: int) -> None:
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``need``, removed; None if there is none."""
        at = need + self.size
        if not self.count[at]:
            # Up until a right-hand neighbour holds something, then down its left-most way.
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at <<= 1
                at += not self.count[at]
        room = at - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of indexes into ``lengths``: best-fit decreasing, ties by index. All lengths lie in 1 to ``length``."""
    room, rows = Room(length), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        found = room.take(n)
        if found is None:
            rows.append([i])
            left = length - n
            at = len(rows) - 1
        else:
            left, at = found[0] - n, found[1]
            rows[at].append(i)
        if left:
            room.put(left, at)
    return rows


class RanksEncoder:
    """Makes the encoder of a file of byte-level ranks. The file is read on the driver; its size is the vocabulary's."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = pattern

    def __call__(self) -> Callable[[str], list[int]]:
        import tiktoken

        own = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return own.encode_ordinary


def pack(
    df: DataFrame,
    make: Callable[[], Callable[[str], list[int]]],
    *,
    length: int = 2048,
    end_id: int,
    pad_id: int,
    window: int = 4 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows of ``length`` ids, padded, from all texts; every text's ids are followed by ``end_id``.

    Columns: ``pack_id`` (unique), ``n_tokens`` without padding, ``ids`` and ``position_ids`` (little-endian 16-bit
    numbers, 32-bit if ``end_id`` or ``pad_id`` or ``length`` needs it; positions restart at 0 in every segment and
    are 0 in the padding), ``cu_seqlens`` (0 and the end of each segment), ``doc_ids`` and ``doc_offsets`` (each
    segment's document and where in its ids the segment starts, so that texts can be put together again).

    A null text has no segment; an empty one is its ``end_id`` alone. Repeated rows are packed each. No rows give no
    rows. Other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(make)
    kind = np.dtype("<u2" if max(end_id, pad_id, length) < 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value()
        task = TaskContext.get().partitionId() << 40
        steps = np.arange(length).astype(kind)
        made, held, size = 0, [], 0

        def rows(segments: list, picks: list[list[int]]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for start in range(0, len(picks), 512):
                part = picks[start : start + 512]
                out: dict[str, list] = {name: [] for name in _ARROW.names}
                for pick in part:
                    ends = np.cumsum([0, *(len(segments[i][2]) for i in pick)])
                    ids = np.full(length, pad_id, kind)
                    places = np.zeros(length, kind)
                    for k, i in enumerate(pick):
                        ids[ends[k] : ends[k + 1]] = segments[i][2]
                        places[ends[k] : ends[k + 1]] = steps[: ends[k + 1] - ends[k]]
                    values = (
                        task + made, ends[-1], ids.tobytes(), places.tobytes(), ends,
                        [segments[i][0] for i in pick], [segments[i][1] for i in pick],
                    )
                    made += 1
                    for name, value in zip(_ARROW.names, values):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=_ARROW)

        for batch in slices(batches, text_column):
            full = []
            for doc, text in zip(batch.column(id_column).to_pylist(), batch.column(text_column).to_pylist()):
                if text is None:
                    continue
                ids = np.append(_ids(encode, text, kind), kind.type(end_id))
                whole = len(ids) // length * length
                full += [(doc, at, ids[at : at + length]) for at in range(0, whole, length)]
                if whole < len(ids):
                    held.append((doc, whole, ids[whole:]))
                    size += len(ids) - whole
            yield from rows(full, [[i] for i in range(len(full))])
            if size >= window:
                yield from rows(held, best_fit([len(x[2]) for x in held], length))
                held, size = [], 0
        yield from rows(held, best_fit([len(x[2]) for x in held], length))

    return df.select(df[id_column].cast("long").alias(id_column), text_column).mapInArrow(run, SCHEMA)


def _ids(encode: Callable[[str], list[int]], text: str, kind: np.dtype, at_once: int = AT_ONCE) -> np.ndarray:
    """Ids of a text; those of a long one are never held as a list."""
    if len(text) <= at_once:
        return np.array(encode(text), kind)
    return np.fromiter(chain.from_iterable(encode(run[0]) for run in _RUN.finditer(text)), kind)
