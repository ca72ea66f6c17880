"""Byte rate limits as a schedule over a table of requests.

A limiter serves requests in order of (arrival, id). Its bucket starts empty but may be filled at once; a
fill sets the bucket to the full limit and the next fill is possible one second later. A request larger
than the limit is taken in pieces of that size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.operators.ordered import (
    NEVER,
    UNLIMITED,
    Greedy,
    Split,
    greedy_cuts,
    read_partition,
    run_starts,
    split_ordered,
)

REFILL_MS = 1000


def bypasses(size: Column, bytes_per_sec: int) -> Column:
    """Requests that are not limited: no limit, or an empty or unknown size."""
    if bytes_per_sec <= 0:
        return F.lit(True)
    return size.isNull() | (size <= 0)


def rate_schedule(
    df: DataFrame,
    key: str,
    bytes_per_sec: int,
    arrival: str = "arrival_ms",
    size: str = "size_bytes",
    id_column: str = "request_id",
    partitions: int | None = None,
    fan: int = 64,
) -> DataFrame:
    """Admit time of every request: (key, id, arrival, size, admit_ms, wait_ms).

    Which requests share a fill depends on sizes only, and the fill times are a running maximum over
    arrivals, so both run as greedy cuts over a split key.
    """
    base = df.select(key, arrival, id_column, size)
    free = bypasses(F.col(size), bytes_per_sec)
    passed = base.where(free).withColumn("admit_ms", F.col(arrival))
    if bytes_per_sec <= 0:
        out = passed
    else:
        fills = F.ceil(F.col(size) / F.lit(bytes_per_sec)).cast("bigint")
        rows = base.where(~free).select(
            "*",
            F.lit(0).cast("bigint").alias("n"),
            F.col(size).cast("bigint").alias("b"),
            ((F.col(size) - 1) % bytes_per_sec + 1).cast("bigint").alias("r"),
            (fills * REFILL_MS).alias("c"),
            (F.col(arrival) + (fills - 1) * REFILL_MS).alias("m"),
        )
        split = split_ordered(rows, key, [arrival, id_column], partitions=partitions)
        # A cut is a fill: the row whose size no longer fits what is left of the bucket.
        g = Greedy(UNLIMITED, bytes_per_sec + 1, init_b=bytes_per_sec, init_t=NEVER)
        timed = greedy_cuts(split, g, [arrival, id_column, size], fan)
        limited = timed.select(
            key, arrival, id_column, size, F.greatest(F.col(arrival), F.col("t")).alias("admit_ms")
        )
        out = limited.unionByName(passed)
    return out.withColumn("wait_ms", F.col("admit_ms") - F.col(arrival))


FRESH = (0, NEVER, NEVER)  # bytes left, next possible fill, time the line is free


def _serve(arrivals, sizes, deadlines, limit: int, state: tuple[int, int, int]):
    """Serve requests of one limiter in order; admit times (None when given up) and the new state."""
    left, fill_at, free_at = state
    admitted = []
    for at, size, until in zip(arrivals, sizes, deadlines):
        now = max(at, free_at)
        if until is not None and now > until:
            admitted.append(None)
            continue
        if left < size:
            fills = -(-size // limit)
            first = max(now, fill_at)
            can = fills if until is None else min(fills, max((until - first) // REFILL_MS + 1, 0))
            if can:
                now = first + (can - 1) * REFILL_MS
                fill_at = now + REFILL_MS
                left = fills * limit - size if can == fills else 0
            if can < fills:
                # Given up at the deadline; pieces already taken stay taken.
                free_at = until
                admitted.append(None)
                continue
        else:
            left -= size
        free_at = now
        admitted.append(now)
    return admitted, (left, fill_at, free_at)


def _serve_partition(table: pa.Table, key: str, cols: Sequence[str], limit: int, entry):
    """Serve all limiters of one partition; the first one may continue from ``entry``."""
    starts = run_starts(table.column(key))
    ends = np.append(starts[1:], table.num_rows)
    lists = [table.column(c).to_pylist() for c in cols]
    out, state = [], FRESH
    for i, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
        state = entry if i == 0 and entry is not None else FRESH
        admitted, state = _serve(*[x[lo:hi] for x in lists], limit, state)
        out.extend(admitted)
    return out, state


def _deadline_entries(split: Split, cols: Sequence[str], limit: int) -> dict[int, tuple]:
    """Entry states where deadlines feed back into the schedule.

    Partitions run side by side from a guess and those whose guess proves wrong run again. Each round
    settles at least one more of them. A guess is right as soon as the limiter has once been idle, so a
    round or two do unless a limiter is overloaded throughout.
    """
    carried, feeding, key = split.carried(), split.feeding(), split.key
    used: dict[int, tuple | None] = {p: FRESH if p in carried else None for p in feeding}
    exits: dict[int, tuple] = {}
    todo = set(feeding)
    while todo:
        entries = {p: used[p] for p in todo}

        def run(batches, entries=entries):
            table = read_partition(batches)
            if table is not None:
                part = table.column("part")[0].as_py()
                _, state = _serve_partition(table, key, cols, limit, entries[part])
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part], pa.int32())}
                    | {c: pa.array([v], pa.int64()) for c, v in zip("bcd", state)}
                )

        done = split.only(todo, key, *cols).mapInArrow(run, "part int, b bigint, c bigint, d bigint")
        for r in done.collect():
            exits[r["part"]] = (r["b"], r["c"], r["d"])
        todo = set()
        for before, part in zip(split.parts, split.parts[1:]):
            if part.id in carried & feeding and part.single:
                if used[part.id] != exits[before.id]:
                    used[part.id] = exits[before.id]
                    todo.add(part.id)
    return {
        part.id: exits[before.id]
        for before, part in zip(split.parts, split.parts[1:])
        if part.continues
    }


def with_deadline(
    df: DataFrame,
    key: str,
    bytes_per_sec: int,
    arrival: str = "arrival_ms",
    size: str = "size_bytes",
    id_column: str = "request_id",
    deadline: str = "deadline_ms",
    partitions: int | None = None,
) -> DataFrame:
    """The schedule when callers give up: ``admit_ms`` is null for requests past their deadline."""
    base = df.select(key, arrival, id_column, size, deadline)
    free = bypasses(F.col(size), bytes_per_sec)
    passed = base.where(free).withColumn("admit_ms", F.col(arrival))
    if bytes_per_sec <= 0:
        return passed
    cols = [arrival, size, deadline]
    split = split_ordered(base.where(~free), key, [arrival, id_column], partitions=partitions)
    entries = _deadline_entries(split, cols, bytes_per_sec)
    kept = [key, arrival, id_column, size, deadline]

    def run(batches):
        table = read_partition(batches)
        if table is not None:
            entry = entries.get(table.column("part")[0].as_py())
            admitted, _ = _serve_partition(table, key, cols, bytes_per_sec, entry)
            out = table.select(kept).append_column("admit_ms", pa.array(admitted, pa.int64()))
            yield from out.to_batches(max_chunksize=1 << 16)

    types = {f.name: f.dataType.simpleString() for f in split.df.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", admit_ms bigint"
    return split.all(*kept).mapInArrow(run, schema).unionByName(passed)
