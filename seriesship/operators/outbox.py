"""The durable outbox: admission under a byte budget, FIFO drains, outcomes and counters.

An outbox is a folder of append-only tables, one sub-folder per writer and epoch: ``records`` (accepted),
``rejected`` (all others, with the reason), ``epochs`` (what a finished append had been given), ``attempts``
(the delivery ledger) and ``finished`` (record ids that left the queue, and why). What waits is records without
finished ones; nothing is rewritten on a drain. A snapshot holds the state up to some epoch of each writer; reading
what waits takes the last snapshot and the epochs after it, so the history before it is never read again.

An append shows once its row in ``epochs`` is written. Given again, it changes nothing, whatever was drained in
between; a writer's epoch that comes with other requests is an error, as when a stream starts anew under the name
of an earlier one. Delivery is at least once.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesship.config import RetryPolicy
from seriesship.operators.ordered import UNLIMITED, read_partition, run_starts, split_ordered
from seriesship.operators.outcome import PERMANENT, RETRYABLE, SUCCESS, attempt_class, with_due
from seriesship.schema import ATTEMPTS

# --- admission ---------------------------------------------------------------------------------------


def _admit_run(sizes: Iterable[int], pending: int, limit: int) -> tuple[list[bool], int]:
    """Accept in order what still fits; a full queue accepts nothing, not even empty records."""
    out = []
    for size in sizes:
        fits = pending < limit and pending + size <= limit
        if fits:
            pending += size
        out.append(fits)
    return out, pending


def _admit_partition(table: pa.Table, key: str, limit: int, entry):
    """Flags and accept numbers of a partition; the first queue may continue from (pending, count)."""
    starts = run_starts(table.column(key)).tolist()
    ends = [*starts[1:], table.num_rows]
    sizes = table.column("size").to_pylist()
    before = table.column("pending").to_pylist()
    flags, numbers, pending, count = [], [], 0, 0
    for i, (lo, hi) in enumerate(zip(starts, ends)):
        pending, count = entry if i == 0 and entry is not None else (before[lo], 0)
        got, pending = _admit_run(sizes[lo:hi], pending, limit)
        for fits in got:
            count += fits
            numbers.append(count if fits else None)
        flags.extend(got)
    return flags, numbers, (pending, count)


def admit(
    df: DataFrame,
    key: str,
    order: list[str],
    max_bytes: int,
    size: str = "size_bytes",
    pending: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Admission in arrival order: (key, order, ``accepted``, ``accept_no``).

    The order must be unique in a queue; a null queue is one of its own.
    ``accept_no`` counts accepted records of a queue from 1. ``pending`` gives bytes already waiting as
    (key, pending_bytes); a limit of zero or less accepts everything.

    A queue may span partitions. Over those the driver carries (pending bytes, count) along: a partition
    that fits as a whole, or of which nothing can fit, follows from its sum and its smallest size. Only one
    in which the queue fills up is run for its exit state, after which the room left is smaller than the
    record that did not fit. Queues do not wait for each other: one job settles such a partition of all of them.
    """
    limit = max_bytes if max_bytes > 0 else UNLIMITED
    rows = df.select(key, *order, F.col(size).cast("bigint").alias("size"))
    if pending is None:
        rows = rows.withColumn("pending", F.lit(0).cast("bigint"))
    else:
        waiting = pending.select(F.col(key).alias("_key"), F.col("pending_bytes").cast("bigint").alias("pending"))
        rows = rows.join(waiting, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
        rows = rows.withColumn("pending", F.coalesce("pending", F.lit(0).cast("bigint")))
    stats = {"bytes": F.sum("size"), "smallest": F.min("size")}
    split = split_ordered(rows, key, order, stats, partitions)
    carried, feeding = split.carried(), split.feeding()

    def exits(parts: dict[int, tuple[int, int] | None]) -> dict[int, tuple[int, int]]:
        if not parts:
            return {}

        def run(batches):
            table = read_partition(batches)
            if table is not None:
                part = table.column("part")[0].as_py()
                _, _, (p, n) = _admit_partition(table, key, limit, parts[part])
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()),
                        "p": pa.array([p], pa.int64()),
                        "n": pa.array([n], pa.int64()),
                    }
                )

        narrow = split.only(parts, key, "size", "pending")
        done = narrow.mapInArrow(run, "part int, p bigint, n bigint").collect()
        return {r["part"]: (r["p"], r["n"]) for r in done}

    # Exit states that do not depend on an entry.
    known = exits({p.id: None for p in split.parts if p.id in feeding and not (p.continues and p.single)})
    # The others follow from the one before, in chains that do not touch each other.
    chains: list[tuple[list, tuple[int, int]]] = []
    for p in split.parts:
        if p.id in carried:
            chains[-1][0].append(p)
        if p.id in known:
            chains.append(([], known[p.id]))
    entries: dict[int, tuple[int, int]] = {}
    while chains:
        asked: dict[int, tuple[int, int]] = {}
        open_ = []
        for parts, state in chains:
            for at, p in enumerate(parts):
                entries[p.id] = state
                if p.id not in feeding or p.id in known:
                    continue
                waiting, count = state
                if waiting < limit and waiting + p.stats["bytes"] < limit:
                    state = (waiting + p.stats["bytes"], count + p.rows)
                elif waiting < limit and waiting + p.stats["smallest"] <= limit:
                    asked[p.id] = state
                    open_.append((p.id, parts[at + 1 :]))
                    break
        done = exits(asked)
        chains = [(rest, done[part]) for part, rest in open_]

    def run(batches):
        table = read_partition(batches)
        if table is not None:
            entry = entries.get(table.column("part")[0].as_py())
            flags, numbers, _ = _admit_partition(table, key, limit, entry)
            out = table.select([key, *order]).append_column("accepted", pa.array(flags, pa.bool_()))
            out = out.append_column("accept_no", pa.array(numbers, pa.int64()))
            yield from out.to_batches(max_chunksize=1 << 16)

    types = {f.name: f.dataType.simpleString() for f in split.df.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in [key, *order])
    return split.all(key, *order, "size", "pending").mapInArrow(
        run, f"{schema}, accepted boolean, accept_no bigint"
    )


# --- draining ----------------------------------------------------------------------------------------


def drain_slice(outbox: DataFrame, now_ms: int, concurrency: int = 1, key: str = "queue") -> DataFrame:
    """Records to send now: due, and behind fewer than ``concurrency`` waiting ones.

    Only the first few waiting records of a queue matter, so each task keeps that many per queue before the
    shuffle; no queue is sorted as a whole.
    """
    n = max(concurrency, 1)
    due = F.coalesce(F.col("next_due_ms"), F.lit(0)) <= now_ms
    waiting = outbox.where(~due).select(key, "record_id")
    first = (
        waiting.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy("record_id")))
        .where(F.col("rn") <= n)
        .groupBy(key)
        .agg(F.max(F.when(F.col("rn") == n, F.col("record_id"))).alias("blocked_from"))
    )
    reach = outbox.where(due).join(first, key, "left")
    return reach.where(
        F.col("blocked_from").isNull() | (F.col("record_id") < F.col("blocked_from"))
    ).drop("blocked_from")


def removal(outcome: Column, error_class: Column) -> Column:
    """How an attempt ends a record: sent, dropped, or null while it stays.

    Cancelled sends and those past a caller's deadline leave the record in the queue.
    """
    stays = F.coalesce(error_class.isin("cancelled", "deadline"), F.lit(False))
    return F.when(outcome == SUCCESS, "sent").when((outcome == PERMANENT) & ~stays, "dropped")


def apply_outcomes(outbox: DataFrame, attempts: DataFrame, retry: RetryPolicy) -> DataFrame:
    """The outbox after its latest attempts: finished records are gone, failed ones wait.

    Retryable failures stay however many there were.
    """
    keys = ["queue", "record_id"]  # ids count per queue
    what = F.struct("attempt", "at_ms", "status", "error_class", "error_text", "retry_after")
    latest = attempts.groupBy(*keys).agg(F.max(what).alias("a")).select(*keys, "a.*")
    judged = with_due(latest.withColumn("outcome", attempt_class()), retry.for_outbox())
    known = judged.select(
        *keys,
        removal(F.col("outcome"), F.col("error_class")).alias("removed"),
        F.when(F.col("outcome") == RETRYABLE, F.col("next_due_ms")).alias("due"),
    )
    return (
        outbox.join(known, keys, "left")
        .where("removed is null")
        .withColumn("next_due_ms", F.coalesce("due", "next_due_ms"))
        .drop("removed", "due")
    )


# --- counters ----------------------------------------------------------------------------------------


def pending(outbox: DataFrame, key: str = "queue") -> DataFrame:
    """Bytes of records that have not left the queue."""
    return outbox.groupBy(key).agg(F.sum("size_bytes").alias("pending_bytes"))


def counters(
    records: DataFrame, attempts: DataFrame, corrupt: DataFrame | None = None, key: str = "queue"
) -> DataFrame:
    """Totals per queue. ``corrupt`` lists quarantined records; they count as dropped too.

    A cancelled send is no failure, one past a caller's deadline is a failure that drops nothing.
    """
    zero = F.lit(0).cast("bigint")
    kind = attempt_class()
    cancelled = F.coalesce(F.col("error_class") == "cancelled", F.lit(False))
    late = F.coalesce(F.col("error_class") == "deadline", F.lit(False))
    names = (
        "enqueued", "sent", "send_failures", "retryable_failures", "permanent_failures", "dropped",
        "corrupt",
    )

    def shape(df: DataFrame, **given: Column) -> DataFrame:
        return df.select(key, *[given.get(n, zero).cast("bigint").alias(n) for n in names])

    one = lambda c: F.when(c, 1).otherwise(0)
    gone = (kind == PERMANENT) & ~cancelled & ~late
    rows = shape(records, enqueued=F.lit(1)).unionByName(
        shape(
            attempts,
            sent=one(kind == SUCCESS),
            send_failures=one((kind != SUCCESS) & ~cancelled),
            retryable_failures=one(kind == RETRYABLE),
            permanent_failures=one(gone),
            dropped=one(gone),
        )
    )
    if corrupt is not None:
        rows = rows.unionByName(shape(corrupt, dropped=F.lit(1), corrupt=F.lit(1)))
    return rows.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])


def gauges(outbox: DataFrame, max_bytes: int = 0, key: str = "queue") -> DataFrame:
    """Pending bytes, whether the queue is blocked, and records being sent."""
    blocked = F.when(F.col("pending_bytes") >= max_bytes, 1).otherwise(0)
    return (
        outbox.groupBy(key)
        .agg(
            F.sum("size_bytes").alias("pending_bytes"),
            F.count_if(F.col("state") == "sending").alias("inflight"),
        )
        .withColumn("blocked", blocked if max_bytes > 0 else F.lit(0))
    )


def recover(outbox: DataFrame) -> DataFrame:
    """After a restart: whatever was pending or being sent is pending again, and due at once."""
    return outbox.where(F.col("state").isin("sending", "pending")).withColumns(
        {"state": F.lit("pending"), "next_due_ms": F.lit(0).cast("bigint")}
    )


def next_ids(records: DataFrame, key: str = "queue") -> DataFrame:
    """The highest id each queue has given out."""
    return records.groupBy(key).agg(F.max("record_id").alias("max_id"))


def with_record_ids(
    accepted: DataFrame, given: DataFrame | None = None, key: str = "queue"
) -> DataFrame:
    """Ids of accepted records: the queue's highest id plus the accept number."""
    if given is None:
        return accepted.withColumn("record_id", F.col("accept_no"))
    joined = accepted.join(given.select(key, "max_id"), key, "left")
    return joined.withColumn(
        "record_id", F.coalesce("max_id", F.lit(0)) + F.col("accept_no")
    ).drop("max_id")


# --- stored outbox -----------------------------------------------------------------------------------

#: Writers name folders.
WRITER = re.compile(r"[A-Za-z0-9_.-]+")
OVER_BUDGET, FORBIDDEN, NO_QUEUE = "over budget", "forbidden header", "no queue"
RECORDS = (
    "record_id bigint, queue string, tenant_id string, body binary, content_type string, "
    "content_encoding string, protocol_version string, headers map<string,array<string>>, "
    "size_bytes bigint"
)
FINISHED = "record_id bigint, queue string, why string, at_ms bigint"
LEDGER = f"{ATTEMPTS}, next_due_ms bigint"
REJECTED = f"request_id bigint, arrival_ms bigint, {RECORDS.removeprefix('record_id bigint, ')}, reason string"
EPOCHS = "requests bigint, digest string"
PLACE = "writer string, epoch bigint"
#: What is known of a record: where it is stored (null if not seen yet), its latest attempt, whether it has left.
STATE = (
    "queue string, record_id bigint, place struct<writer:string,epoch:bigint,size_bytes:bigint>, "
    "due struct<tries:int,next_due_ms:bigint>, gone boolean"
)
HIGHEST = "queue string, max_id bigint"
COVERED = "source string, writer string, upto bigint"
SNAP = "snap bigint"
DRAINS = "drain"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


#: Stands for a null order value.
NULL_FIRST = -(1 << 63)


def _hashable(df: DataFrame) -> list[Column]:
    """All columns, maps as sorted lists of their entries."""
    names = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return [F.array_sort(F.map_entries(f"`{c}`")) if t == "map" else F.col(f"`{c}`") for c, t in names.items()]


def digest(rows: DataFrame) -> tuple[int, str]:
    """What a set of rows is known by: their number, and the sum of the hashes of all their columns."""
    total = F.coalesce(F.sum(F.xxhash64(*_hashable(rows)).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return tuple(rows.agg(F.count("*"), total).first())


class Outbox:
    """An outbox stored as append-only Parquet tables under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _stored(self, table: str, schema: str, place: str = PLACE) -> DataFrame:
        """All rows of a table, with the writer and epoch they are from."""
        try:
            return self.spark.read.schema(f"{schema}, {place}").parquet(posixpath.join(self.path, table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            # An empty relation that the optimizer sees through: what joins it or reads it goes away.
            fields = StructType.fromDDL(f"{schema}, {place}")
            return self.spark.range(1).where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    # Snapshots. Epochs of a writer count upwards, so one number says how far a snapshot reaches.

    def _snapshot(self) -> tuple[int | None, dict[tuple[str, str], int]]:
        """The last finished snapshot and, by table and writer, the epoch it reaches: a few rows for each writer."""
        marks = self._stored("snapshots", COVERED, SNAP)
        last = marks.agg(F.max("snap")).first()[0]
        rows = [] if last is None else marks.where(F.col("snap") == last).collect()
        return last, {(r["source"], r["writer"]): r["upto"] for r in rows if r["source"] is not None}

    def _since(self, table: str, schema: str, covered: dict, upto: dict | None = None) -> DataFrame:
        """Rows of epochs that no snapshot covers, up to those of ``upto``. The condition prunes folders."""
        rows = self._stored(table, schema)
        for (source, writer), epoch in covered.items():
            if source == table:
                rows = rows.where((F.col("writer") != writer) | (F.col("epoch") > epoch))
        if upto is not None:
            reach = [(F.col("writer") == w) & (F.col("epoch") <= e) for (source, w), e in upto.items() if source == table]
            rows = rows.where(reduce(or_, reach, F.lit(False)))
        return rows

    def _records_since(self, covered: dict, upto: dict | None = None) -> DataFrame:
        """The same of records, and of finished appends only."""
        done = self._since("epochs", EPOCHS, {("epochs", w): e for (s, w), e in covered.items() if s == "records"})
        rows = self._since("records", RECORDS, covered, upto).select("queue", "record_id", "size_bytes", "writer", "epoch")
        return rows.join(done.select("writer", "epoch"), ["writer", "epoch"], "left_semi")

    def _state(self, snap: int | None, covered: dict, without: tuple[str, int] | None = None, upto: dict | None = None) -> DataFrame:
        """One row for each record that has not been forgotten, by one grouping of a snapshot and what followed."""
        if without is not None and any(w == without[0] and e >= without[1] for (s, w), e in covered.items() if s != "records"):
            raise ValueError(f"epoch {without[1]} of {without[0]!r} is part of a snapshot and can't be given again")

        def of(rows: DataFrame, **given: Column) -> DataFrame:
            if without is not None:
                rows = rows.where((F.col("writer") != without[0]) | (F.col("epoch") != without[1]))
            types = {"place": "struct<writer:string,epoch:bigint,size_bytes:bigint>", "due": "struct<tries:int,next_due_ms:bigint>", "gone": "boolean"}
            return rows.select("queue", "record_id", *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()])

        parts = [
            of(self._records_since(covered, upto), place=F.struct("writer", "epoch", "size_bytes")),
            of(self._since("attempts", LEDGER, covered, upto), due=F.struct("attempt", "next_due_ms")),
            of(self._since("finished", FINISHED, covered, upto), gone=F.lit(True)),
        ]
        if snap is not None:
            before = self._stored("live", STATE, SNAP)
            parts.append(before.where(F.col("snap") == snap).drop("snap"))
        rows = reduce(DataFrame.unionByName, parts)
        return rows.groupBy("queue", "record_id").agg(
            F.max("place").alias("place"), F.max("due").alias("due"), F.coalesce(F.bool_or("gone"), F.lit(False)).alias("gone")
        )

    def _highest(self, snap: int | None, covered: dict, upto: dict | None = None) -> DataFrame:
        """The highest id that each queue has given out."""
        ids = next_ids(self._records_since(covered, upto))
        if snap is not None:
            before = self._stored("highest", HIGHEST, SNAP)
            ids = ids.unionByName(before.where(F.col("snap") == snap).drop("snap"))
        return ids.groupBy("queue").agg(F.max("max_id").alias("max_id"))

    def compact(self, keep: int = 1) -> int | None:
        """Writes a snapshot of all but the last ``keep`` epochs of each writer, which may be given again, and returns
        its number; null if there is nothing new to cover.

        A snapshot shows once its row in ``snapshots`` is written. It holds what waits, and marks of attempts and ends of
        records whose own append is not covered yet. One compaction runs at a time; folders of epochs that the last
        snapshot covers are needed for bodies and counters only.
        """
        snap, covered = self._snapshot()
        upto = dict(covered)
        def epochs(table: str, schema: str, source: str) -> DataFrame:
            # Partition values alone: no file is opened for the columns.
            return self._since(table, schema, {(table, w): e for (s, w), e in covered.items() if s == source}).select("writer", "epoch")

        # A drain is covered as a whole; one that delivers or ends nothing leaves no row in one of its tables.
        drained = epochs("attempts", LEDGER, "attempts").union(epochs("finished", FINISHED, "finished"))
        top = W.partitionBy("writer").orderBy(F.desc("epoch"))
        for known, sources in ((epochs("epochs", EPOCHS, "records"), ("records",)), (drained, ("attempts", "finished"))):
            ranked = known.distinct().withColumn("rn", F.row_number().over(top))
            for r in ranked.where(F.col("rn") > keep).groupBy("writer").agg(F.max("epoch").alias("upto")).collect():
                upto.update({(source, r["writer"]): r["upto"] for source in sources})
        if upto == covered:
            return None
        new = 0 if snap is None else snap + 1
        # A record that is stored and has left is forgotten.
        state = self._state(snap, covered, upto=upto).where(F.col("place").isNull() | ~F.col("gone"))
        for table, rows in (("live", state), ("highest", self._highest(snap, covered, upto))):
            rows.write.mode("overwrite").parquet(posixpath.join(self.path, table, f"snap={new}"))
        marks = self.spark.createDataFrame([(s, w, e) for (s, w), e in upto.items()], COVERED)
        marks.write.mode("overwrite").parquet(posixpath.join(self.path, "snapshots", f"snap={new}"))
        return new

    def _read(self, table: str, schema: str, without: tuple[str, int] | None = None) -> DataFrame:
        rows = self._stored(table, schema)
        if without is not None:
            rows = rows.where((F.col("writer") != without[0]) | (F.col("epoch") != without[1]))
        return rows.drop("writer", "epoch")

    def _write(self, df: DataFrame, table: str, writer: str, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(
            posixpath.join(self.path, table, f"writer={writer}", f"epoch={epoch_id}")
        )

    def _shown(self, table: str, schema: str) -> DataFrame:
        """Rows of finished appends only."""
        done = self._stored("epochs", EPOCHS).select("writer", "epoch")
        return self._stored(table, schema).join(done, ["writer", "epoch"], "left_semi")

    def records(self) -> DataFrame:
        return self._shown("records", RECORDS).drop("writer", "epoch")

    def rejected(self) -> DataFrame:
        """Requests that were not taken, and why."""
        return self._shown("rejected", REJECTED).drop("writer", "epoch")

    def attempts(self, without: tuple[str, int] | None = None) -> DataFrame:
        return self._read("attempts", LEDGER, without)

    def finished(self, without: tuple[str, int] | None = None) -> DataFrame:
        return self._read("finished", FINISHED, without)

    def append(
        self,
        requests: DataFrame,
        epoch_id: int,
        max_pending_bytes: int = 0,
        order: tuple[str, ...] = ("arrival_ms", "request_id"),
        writer: str = "main",
        refused: DataFrame | None = None,
        given: tuple[int, str] | None = None,
    ) -> None:
        """Store the requests that fit the budget, and all others as rejected.

        ``refused`` has further requests with a ``reason``, which are not taken in any case; a request without a
        queue joins them. Requests equal in queue and order are records of their own, in the order of their hashes;
        null order values come first. A repeated epoch of a writer changes nothing; one with other requests raises
        ``ValueError``. What an epoch is known by is the :func:`digest` of its requests, or ``given``, that of what
        they were made from, where making them again gives others (with another clock).
        """
        if not WRITER.fullmatch(writer) or writer == DRAINS:
            raise ValueError(f"not a writer's name: {writer!r}")
        given = given or digest(requests)
        known = self._stored("epochs", EPOCHS).where((F.col("writer") == writer) & (F.col("epoch") == epoch_id))
        before = known.select(*_names(EPOCHS)).first()
        if before is not None:
            if tuple(before) != given:
                raise ValueError(f"epoch {epoch_id} of writer {writer!r} was stored with other requests")
            return
        # Requests equal in queue and order follow by the hash of the whole row; rows equal in that too may stand for
        # each other. Bodies are dealt out by queue and order once: ids come back as a list for each, so that one join
        # tells what is taken and what is not.
        keys = ["queue", *[f"_order{i}" for i in range(len(order))]]
        first = {f"_order{i}": F.coalesce(F.col(c).cast("bigint"), F.lit(NULL_FIRST)) for i, c in enumerate(order)}
        spread = requests.where("queue is not null").withColumns({**first, "_row": F.xxhash64(*_hashable(requests))})
        snap, covered = self._snapshot()
        left = self._state(snap, covered).where(F.col("place").isNotNull() & ~F.col("gone")).select("queue", "place.size_bytes")
        narrow = spread.select(*keys, "_row", "size_bytes")
        flags = admit(narrow, "queue", [*keys[1:], "_row"], max_pending_bytes, pending=pending(left))
        ids = with_record_ids(flags, self._highest(snap, covered)).groupBy(*keys)
        ids = ids.agg(F.array_sort(F.collect_list(F.struct("_row", "record_id"))).alias("ids"))
        place = F.row_number().over(W.partitionBy(*keys).orderBy("_row", "size_bytes")) - 1
        told = spread.withColumn("_place", place).join(ids, keys)
        told = told.withColumn("record_id", F.get("ids", F.col("_place"))["record_id"]).persist()
        self._write(told.where("record_id is not null").select(*_names(RECORDS)), "records", writer, epoch_id)
        over = told.where("record_id is null").withColumn("reason", F.lit(OVER_BUDGET)).select(*_names(REJECTED))
        lost = requests.where("queue is null").withColumn("reason", F.lit(NO_QUEUE)).select(*_names(REJECTED))
        over = over.unionByName(lost)
        if refused is not None:
            over = over.unionByName(refused.select(*_names(REJECTED)))
        self._write(over, "rejected", writer, epoch_id)
        told.unpersist()
        self._write(self.spark.createDataFrame([given], EPOCHS), "epochs", writer, epoch_id)

    def waiting(self, without: tuple[str, int] | None = None) -> DataFrame:
        """Records still to deliver and when each is due, not counting one drain's own rows.

        Bodies and headers are left out: :meth:`whole` gets them for the few that are picked.
        """
        state = self._state(*self._snapshot(), without).where(F.col("place").isNotNull() & ~F.col("gone"))
        return state.select(
            "queue",
            "record_id",
            "place.size_bytes",
            "place.writer",
            "place.epoch",
            F.coalesce("due.next_due_ms", F.lit(0).cast("bigint")).alias("next_due_ms"),
            F.coalesce("due.tries", F.lit(0)).alias("tries"),
        )

    def whole(self, picked: DataFrame) -> DataFrame:
        """The records that ``picked``, rows of :meth:`waiting`, stand for, with ``tries``."""
        keys = ["writer", "epoch", "queue", "record_id"]
        found = self._stored("records", RECORDS).join(picked.select(*keys, "tries"), keys)
        return found.drop("writer", "epoch")

    def settle(
        self,
        attempts: DataFrame,
        epoch_id: int,
        retry: RetryPolicy,
        corrupt: DataFrame | None = None,
        now_ms: int = 0,
        writer: str = DRAINS,
    ) -> None:
        """Write a drain's attempts to the ledger, then finish what they ended and what is corrupt."""
        judged = with_due(attempts.withColumn("outcome", attempt_class()), retry.for_outbox())
        due = F.when(F.col("outcome") == RETRYABLE, F.col("next_due_ms")).otherwise(F.lit(0))
        self._write(judged.withColumn("next_due_ms", due).select(*_names(LEDGER)), "attempts", writer, epoch_id)
        ledger = self.spark.read.schema(LEDGER).parquet(
            posixpath.join(self.path, "attempts", f"writer={writer}", f"epoch={epoch_id}")
        )
        why = removal(attempt_class(), F.col("error_class"))
        ended = ledger.select("record_id", "queue", why.alias("why"), "at_ms").where("why is not null")
        if corrupt is not None:
            at = F.lit(now_ms).cast("bigint").alias("at_ms")
            ended = ended.unionByName(
                corrupt.select("record_id", "queue", F.lit("corrupt").alias("why"), at)
            )
        self._write(ended, "finished", writer, epoch_id)
