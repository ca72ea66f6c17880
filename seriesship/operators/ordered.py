"""Work in which every row depends on the one before it, without one task per key.

``split_ordered`` range-partitions rows by (key, order). A key may then span many partitions, so a key
that holds a third of the data is spread like any other rows. Only the first key of a partition can
continue from the partition before it, hence there is one carried state per partition.

``greedy_cuts`` covers running totals that restart when a limit is reached. Three passes, whatever the
skew:

1. each partition sums up how its exit state follows from any entry state. That takes one line per row
   at which the first cut may fall, so at most one batch's worth of rows;
2. these summaries are chained, in groups side by side first and then over the groups;
3. each partition runs for real from its now known entry state.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one partition are held by a task as arrays, of about 500 bytes a row in all at the peak. Splits aim at half
# of this number; larger partitions are split again.
ROWS_PER_PART = 1_000_000
NEVER = -(1 << 60)
UNLIMITED = 1 << 60


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; only in local mode, and where none is set, one beside the warehouse."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
    sc.setCheckpointDir(path)


@dataclass(frozen=True)
class Part:
    """What the driver knows of one non-empty partition."""

    id: int
    first: object
    last: object
    rows: int
    stats: dict = field(default_factory=dict)
    continues: bool = False

    @property
    def single(self) -> bool:
        return self.first == self.last


@dataclass(frozen=True)
class Split:
    df: DataFrame
    key: str
    parts: list[Part]

    def carried(self) -> set[int]:
        """Partitions whose first key continues from the partition before."""
        return {p.id for p in self.parts if p.continues}

    def feeding(self) -> set[int]:
        """Partitions whose last key continues in the next one."""
        return {a.id for a, b in zip(self.parts, self.parts[1:]) if b.continues}

    def only(self, ids: Iterable[int], *columns: str) -> DataFrame:
        """Rows of some partitions, with the partition number in ``part``."""
        part = F.spark_partition_id()
        return self.df.select(part.alias("part"), *columns).where(F.col("part").isin(*sorted(ids)))

    def all(self, *columns: str) -> DataFrame:
        return self.df.select(F.spark_partition_id().alias("part"), *columns)


def split_ordered(
    df: DataFrame,
    key: str,
    order: list[str],
    stats: dict[str, Column] | None = None,
    partitions: int | None = None,
) -> Split:
    """Sort rows by (key, order) over the cluster. The order must be unique in each key; a null key is one of its own.

    The checkpoint fixes which partition a row is in, so that later passes, and tasks run again after an
    executor is lost, see the same split. What comes back to the driver is one row per partition. Without
    ``partitions``, rows are counted first: many of them get the session's number of shuffle partitions or, should
    that be too small for them, a larger one, which is not reduced to what is a good size of a file.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    by = [key, *order]
    # Range partitioning reads its input twice, first for a sample; what made the rows runs once.
    df = df.persist()
    if partitions is None and (count := df.count()) > ROWS_PER_PART:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * count // ROWS_PER_PART + 1)
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    fixed = ranged.sortWithinPartitions(*by).checkpoint(eager=False)
    stats = stats or {}
    rows = (
        fixed.groupBy(F.spark_partition_id().alias("part"))
        .agg(
            F.min(key).alias("first"),
            F.max(key).alias("last"),
            F.count(key).alias("known"),
            F.count("*").alias("rows"),
            *[c.alias(name) for name, c in stats.items()],
        )
        .collect()
    )
    df.unpersist()
    total = sum(r["rows"] for r in rows)
    wanted = 2 * total // ROWS_PER_PART + 1
    if max((r["rows"] for r in rows), default=0) > ROWS_PER_PART and wanted > (partitions or 0):
        return split_ordered(df, key, order, stats, wanted)
    parts: list[Part] = []
    for r in sorted(rows, key=lambda r: r["part"]):
        # Nulls come first in the order and are left out by min and max.
        first = r["first"] if r["known"] == r["rows"] else None
        continues = bool(parts) and parts[-1].last == first
        own = {name: r[name] for name in stats}
        parts.append(Part(r["part"], first, r["last"], r["rows"], own, continues))
    return Split(fixed, key, parts)


def read_partition(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """One partition's (narrow) rows as a table."""
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def run_starts(keys: pa.ChunkedArray) -> np.ndarray:
    """Row numbers at which a new key begins."""
    a = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    if len(a) < 2:
        return np.zeros(1, dtype=np.int64)
    now, before = a.slice(1), a.slice(0, len(a) - 1)
    change = pc.fill_null(pc.not_equal(now, before), False)
    change = pc.or_(change, pc.xor(pc.is_null(now), pc.is_null(before))).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(change) + 1]).astype(np.int64)


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64, copy=False)


@dataclass(frozen=True)
class Greedy:
    """Limits of a running (count, size) total that restarts at each cut.

    A cut falls on the first row at which the total reaches ``max_n`` or ``max_b``. After it the total is
    (0, r) with r a column. ``init_b`` is the size a fresh key starts from. Along the cuts a carried number
    goes t -> max(m, t + c), with m and c columns (``init_t`` at first).
    """

    max_n: int
    max_b: int
    init_b: int = 0
    init_t: int = 0


class _Rows:
    """One partition prepared for finding cuts."""

    def __init__(self, table: pa.Table, key: str, g: Greedy):
        self.g = g
        self.len = table.num_rows
        self.n1 = np.cumsum(_ints(table, "n"))
        self.b1 = np.cumsum(_ints(table, "b"))
        self.r, self.c, self.m = (_ints(table, x) for x in ("r", "c", "m"))
        self.starts = run_starts(table.column(key))
        self.ends = np.append(self.starts[1:], self.len)
        self.run = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)
        self.next = np.minimum(
            np.searchsorted(self.n1, self.n1 + g.max_n),
            np.searchsorted(self.b1, self.b1 - self.r + g.max_b),
        )
        self.next = np.minimum(self.next, self.ends[self.run])

    def before(self, a: np.ndarray, i: np.ndarray) -> np.ndarray:
        return np.where(i > 0, a[np.maximum(i - 1, 0)], 0)

    def first_cuts(self, entry: tuple[int, int, int] | None) -> np.ndarray:
        """First cut of every run, or the run's end."""
        n0 = np.zeros(len(self.starts), dtype=np.int64)
        b0 = np.full(len(self.starts), self.g.init_b, dtype=np.int64)
        if entry is not None:
            n0[0], b0[0] = entry[0], entry[1]
        by_n = np.searchsorted(self.n1, self.before(self.n1, self.starts) + self.g.max_n - n0)
        by_b = np.searchsorted(self.b1, self.before(self.b1, self.starts) + self.g.max_b - b0)
        return np.minimum(np.minimum(by_n, by_b), self.ends)

    def walk(self, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """All cuts from the given first ones on, as a mask."""
        cut = np.zeros(self.len, dtype=bool)
        live = first < ends
        at, ends = first[live], ends[live]
        while len(at) > 8:
            cut[at] = True
            at = self.next[at]
            live = at < ends
            at, ends = at[live], ends[live]
        for i, end in zip(at.tolist(), ends.tolist()):
            while i < end:
                cut[i] = True
                i = int(self.next[i])
        return cut

    def exit_state(self, start: int, first: int) -> tuple[int, int, int]:
        """State after the run that begins at ``start``, fresh, with its first cut given."""
        g, end = self.g, self.len
        t, last, i = g.init_t, -1, first
        while i < end:
            t = max(int(self.m[i]), t + int(self.c[i]))
            last, i = i, int(self.next[i])
        if last < 0:
            base_n = int(self.n1[start - 1]) if start else 0
            base_b = int(self.b1[start - 1]) if start else 0
            return int(self.n1[-1]) - base_n, int(self.b1[-1]) - base_b + g.init_b, t
        n = int(self.n1[-1] - self.n1[last])
        return n, int(self.b1[-1] - self.b1[last] + self.r[last]), t


SUMMARY = (
    "part int, kind int, idx bigint, tn bigint, tb bigint, n bigint, b bigint, c bigint, m bigint"
)
SUMMARY_COLUMNS = ["part", "kind", "idx", "tn", "tb", "n", "b", "c", "m"]
ROW, TOTAL, CONST = 0, 1, 2
ENTRY = "part int, n bigint, b bigint, t bigint"


class Transfer:
    """Exit state as a function of the entry state.

    Line i holds for entries whose first cut is the one with totals (tn, tb) up to it. Without any cut the
    totals are added.
    """

    def __init__(self, tn, tb, n, b, c, m, tot_n, tot_b):
        self.tn, self.tb, self.n, self.b, self.c, self.m = tn, tb, n, b, c, m
        self.tot_n, self.tot_b = tot_n, tot_b

    def apply(self, g: Greedy, n, b, c, m):
        """States (n, b) and carried numbers (c, m) after this partition; all arrays."""
        i = np.minimum(
            np.searchsorted(self.tn, g.max_n - n), np.searchsorted(self.tb, g.max_b - b)
        )
        hit = i < len(self.tn)
        k = i[hit]
        n, b, c, m = n + self.tot_n, b + self.tot_b, c.copy(), m.copy()
        n[hit], b[hit] = self.n[k], self.b[k]
        m[hit] = np.maximum(m[hit] + self.c[k], self.m[k])
        c[hit] += self.c[k]
        return n, b, c, m

    def then(self, g: Greedy, other: Transfer) -> Transfer:
        """This partition followed by another."""
        n, b, c, m = other.apply(g, self.n, self.b, self.c, self.m)
        tn, tb = self.tn, self.tb
        # Entries without a cut here may have their first one there.
        if self.tot_n < g.max_n and self.tot_b < g.max_b:
            tn = np.concatenate([tn, other.tn + self.tot_n])
            tb = np.concatenate([tb, other.tb + self.tot_b])
            n, b = np.concatenate([n, other.n]), np.concatenate([b, other.b])
            c, m = np.concatenate([c, other.c]), np.concatenate([m, other.m])
        return Transfer(
            tn, tb, n, b, c, m, self.tot_n + other.tot_n, self.tot_b + other.tot_b
        )

    def columns(self, part: int) -> dict[str, np.ndarray]:
        size = len(self.tn)
        idx = np.arange(size + 1)
        one = lambda a, last: np.append(a, last).astype(np.int64)
        return {
            "part": np.full(size + 1, part),
            "kind": np.append(np.full(size, ROW), TOTAL),
            "idx": idx,
            "tn": one(self.tn, self.tot_n),
            "tb": one(self.tb, self.tot_b),
            "n": one(self.n, 0),
            "b": one(self.b, 0),
            "c": one(self.c, 0),
            "m": one(self.m, 0),
        }


def _summary_table(columns: dict[str, np.ndarray]) -> pa.Table:
    small = ("part", "kind")
    return pa.table(
        {k: columns[k].astype(np.int32 if k in small else np.int64) for k in SUMMARY_COLUMNS}
    )


def _const(part: int, state: tuple[int, int, int]) -> dict[str, np.ndarray]:
    n, b, t = state
    row = {"part": part, "kind": CONST, "idx": 0, "tn": 0, "tb": 0, "n": n, "b": b, "c": 0, "m": t}
    return {k: np.array([v]) for k, v in row.items()}


def _summarise(rows: _Rows, part: int, continues: bool) -> dict[str, np.ndarray]:
    """How the last key of a partition leaves it."""
    g = rows.g
    if not continues or len(rows.starts) > 1:
        first = rows.first_cuts(None)
        return _const(part, rows.exit_state(int(rows.starts[-1]), int(first[-1])))
    # An empty total has the latest possible first cut.
    latest = min(
        int(np.searchsorted(rows.n1, g.max_n)), int(np.searchsorted(rows.b1, g.max_b))
    )
    lines = np.arange(min(latest + 1, rows.len))
    at, c, m = lines.copy(), rows.c[lines].copy(), rows.m[lines].copy()
    live = np.arange(len(lines))
    while len(live):
        nxt = rows.next[at[live]]
        go = nxt < rows.len
        live, nxt = live[go], nxt[go]
        at[live] = nxt
        m[live] = np.maximum(m[live] + rows.c[nxt], rows.m[nxt])
        c[live] += rows.c[nxt]
    return Transfer(
        rows.n1[lines],
        rows.b1[lines],
        rows.n1[-1] - rows.n1[at],
        rows.b1[-1] - rows.b1[at] + rows.r[at],
        c,
        m,
        int(rows.n1[-1]),
        int(rows.b1[-1]),
    ).columns(part)


def _steps(table: pa.Table) -> Iterator[tuple[int, Transfer | tuple[int, int, int]]]:
    """Summaries by partition, in order."""
    cols = {name: table.column(name).to_numpy() for name in SUMMARY_COLUMNS}
    order = np.lexsort((cols["idx"], cols["part"]))
    cols = {k: v[order] for k, v in cols.items()}
    ids, starts = np.unique(cols["part"], return_index=True)
    for part, lo, hi in zip(ids.tolist(), starts, np.append(starts[1:], len(order))):
        x = {k: v[lo:hi] for k, v in cols.items()}
        if x["kind"][0] == CONST:
            yield part, (int(x["n"][0]), int(x["b"][0]), int(x["m"][0]))
        else:
            lines = [x[k][:-1] for k in ("tn", "tb", "n", "b", "c", "m")]
            yield part, Transfer(*lines, int(x["tn"][-1]), int(x["tb"][-1]))


def _after(g: Greedy, state, step):
    """State after one partition or group."""
    if isinstance(step, tuple):
        return step
    n, b, t = state
    one = lambda v: np.array([v], dtype=np.int64)
    n, b, c, m = step.apply(g, one(n), one(b), one(0), one(NEVER))
    return int(n[0]), int(b[0]), max(int(m[0]), t + int(c[0]))


def _walk_entries(table: pa.Table, g: Greedy, carried: set[int], state=None) -> pa.Table:
    """Entry states of the partitions (or groups) in a table of summaries."""
    out = []
    for part, step in _steps(table):
        if part in carried and state is not None:
            out.append((part, *state))
        state = _after(g, state, step) if state is not None or isinstance(step, tuple) else None
    cols = list(zip(*out)) if out else [(), (), (), ()]
    return pa.table(
        {
            "part": pa.array(cols[0], pa.int32()),
            "n": pa.array(cols[1], pa.int64()),
            "b": pa.array(cols[2], pa.int64()),
            "t": pa.array(cols[3], pa.int64()),
        }
    )


def _entry_states(split: Split, g: Greedy, fan: int) -> dict[int, tuple[int, int, int]]:
    """Entry state of each partition that continues a key: at most one row per partition."""
    carried, feeding, key = split.carried(), split.feeding(), split.key
    if not carried:
        return {}
    # Summaries of a bounded number of partitions or groups; never data rows.
    together = (F.col("part") * 0).alias("whole")

    def summarise(batches):
        table = read_partition(batches)
        if table is not None:
            part = table.column("part")[0].as_py()
            if part in feeding:
                lines = _summarise(_Rows(table, key, g), part, part in carried)
            else:
                # The end of a chain: only its entry state is asked for.
                lines = _const(part, (0, 0, 0))
            yield from _summary_table(lines).to_batches()

    narrow = split.only(feeding | carried, key, "n", "b", "r", "c", "m")
    summaries = narrow.mapInArrow(summarise, SUMMARY)
    read = lambda rows: {r["part"]: (r["n"], r["b"], r["t"]) for r in rows}
    width = max(fan, math.isqrt(len(split.parts)) + 1)
    if len(split.parts) <= width:
        whole = summaries.groupBy(together).applyInArrow(
            lambda t: _walk_entries(t, g, carried), ENTRY
        )
        return read(whole.collect())

    summaries = summaries.persist()
    grouped = summaries.withColumn("grp", F.expr(f"part div {width}").cast("int"))

    def compose(table: pa.Table) -> pa.Table:
        grp, done = table.column("grp")[0].as_py(), None
        for _, step in _steps(table):
            if isinstance(step, tuple) or done is None:
                done = step
            elif isinstance(done, tuple):
                done = _after(g, done, step)
            else:
                done = done.then(g, step)
        cols = _const(grp, done) if isinstance(done, tuple) else done.columns(grp)
        return _summary_table(cols)

    per_group = grouped.groupBy("grp").applyInArrow(compose, SUMMARY)
    everything = set(range(max(p.id for p in split.parts) + 1))
    starts = read(
        per_group.groupBy(together)
        .applyInArrow(lambda t: _walk_entries(t, g, everything), ENTRY)
        .collect()
    )

    def inside(table: pa.Table) -> pa.Table:
        grp = table.column("grp")[0].as_py()
        return _walk_entries(table, g, carried, starts.get(grp))

    entries = read(grouped.groupBy("grp").applyInArrow(inside, ENTRY).collect())
    summaries.unpersist()
    return entries


def _carried_numbers(rows: _Rows, cut: np.ndarray, entry) -> np.ndarray:
    """The carried number after each row."""
    g, at = rows.g, np.flatnonzero(cut)
    c, m = rows.c[at], rows.m[at]
    run = rows.run[at]
    start = np.full(len(rows.starts), g.init_t, dtype=np.int64)
    if entry is not None:
        start[0] = entry[2]
    if not len(at):
        return start[rows.run]
    if int(m.max()) > NEVER:
        values, last, t = [], -1, 0
        for r, ci, mi in zip(run.tolist(), c.tolist(), m.tolist()):
            if r != last:
                t, last = int(start[r]), r
            t = max(mi, t + ci)
            values.append(t)
        done = np.array(values, dtype=np.int64)
    else:
        total = np.cumsum(c)
        first = np.searchsorted(run, np.arange(len(rows.starts)))
        done = start[run] + total - rows.before(total, first)[run]
    # Each row takes the number of the latest cut in its own run.
    seen = np.cumsum(cut)
    fresh = seen == rows.before(seen, rows.starts)[rows.run]
    out = start[rows.run]
    out[~fresh] = done[seen[~fresh] - 1]
    return out


def greedy_cuts(split: Split, g: Greedy, columns: list[str], fan: int = 64) -> DataFrame:
    """Rows with ``cut`` (a cut falls on this row) and ``t`` (the carried number after it).

    ``split.df`` holds the columns n, b, r, c and m of ``Greedy``; ``columns`` are passed through.
    """
    entries, key = _entry_states(split, g, fan), split.key
    passed = [key, *[c for c in columns if c != key]]

    def run(batches):
        table = read_partition(batches)
        if table is None:
            return
        entry = entries.get(table.column("part")[0].as_py())
        rows = _Rows(table, key, g)
        cut = rows.walk(rows.first_cuts(entry), rows.ends)
        t = _carried_numbers(rows, cut, entry)
        out = table.select(passed).append_column("cut", pa.array(cut)).append_column("t", pa.array(t))
        yield from out.to_batches(max_chunksize=1 << 16)

    types = {f.name: f.dataType.simpleString() for f in split.df.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in passed) + ", cut boolean, t bigint"
    needed = [*passed, *[c for c in ("n", "b", "r", "c", "m") if c not in passed]]
    return split.all(*needed).mapInArrow(run, schema)
