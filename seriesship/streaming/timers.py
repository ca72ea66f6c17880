"""Retry timers: a stream of attempts becomes a stream of records that are due.

For each record of a queue the state holds the number of its latest attempt and when it is due. A failed attempt that may
be repeated sets that time, a later one moves it, and one that ends the record takes it away. A queue numbers its records
in a row, so ``2**BLOCK_BITS`` neighbours share one state and one timer, that of the first of them to be due. A block is
read and written once for all its attempts of a micro-batch, and once when some of its records are due; no other block is
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from seriesship.config import RetryPolicy
from seriesship.operators.outbox import removal
from seriesship.operators.outcome import RETRYABLE, attempt_class, with_due

#: The state store that timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DUE = "queue string, record_id bigint, tries int, due_ms bigint"
#: Neighbours whose state is kept together, as a power of two. Also the most that a touched record makes read.
BLOCK_BITS = 8
_STATE = "record_id array<bigint>, tries array<int>, due_ms array<bigint>, over array<boolean>"
_NAMES = ["record_id", "tries", "due_ms", "over"]
#: The time of a record that woke and has not been tried again.
NO_TIME = (1 << 63) - 1


class RetryTimers(StatefulProcessor):
    """State and timer of a block of one queue's records. ``forget_ms``: how long an ended record is known, so that
    attempts that are read again, of which a source may have any number, do not bring it back."""

    def __init__(self, forget_ms: int, clock: str = "event") -> None:
        self.forget_ms, self.clock = forget_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)

    def _known(self) -> pd.DataFrame:
        columns = self.held.get() if self.held.exists() else ([], [], [], [])
        known = pd.DataFrame({n: list(c) for n, c in zip(_NAMES, columns)})
        return known.astype({"record_id": "int64", "tries": "int64", "due_ms": "int64", "over": "bool"})

    def _keep(self, known: pd.DataFrame, before: int) -> None:
        """Writes the block down and sets its timer, which was at ``before``."""
        first = int(known["due_ms"].min()) if len(known) else NO_TIME
        if len(known):
            self.held.update(tuple(known[n].tolist() for n in _NAMES))
        else:
            self.held.clear()
        if first != before:
            if before != NO_TIME:
                self.handle.deleteTimer(before)
            if first != NO_TIME:
                self.handle.registerTimer(first)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        latest = None
        for frame in rows:
            both = frame if latest is None else pd.concat([latest, frame], ignore_index=True)
            latest = both.sort_values(["attempt", "at_ms"], ascending=False, kind="stable").drop_duplicates("record_id")
        known = self._known()
        # What has been counted changes nothing when it comes again.
        tries = latest["record_id"].map(known.set_index("record_id")["tries"]).fillna(0)
        new = latest[latest["attempt"] > tries]
        if len(new):
            over = new["removed"].notna()
            state = pd.DataFrame(
                {
                    "record_id": new["record_id"],
                    "tries": new["attempt"].astype("int64"),
                    "due_ms": new["due_ms"].where(~over, new["at_ms"] + self.forget_ms),
                    "over": over,
                }
            )
            before = int(known["due_ms"].min()) if len(known) else NO_TIME
            others = known[~known["record_id"].isin(state["record_id"])]
            self._keep(pd.concat([others, state], ignore_index=True) if len(others) else state, before)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        event = self.clock == "event"
        now = timerValues.getCurrentWatermarkInMs() if event else timerValues.getCurrentProcessingTimeInMs()
        known = self._known()
        due = known["due_ms"] <= now
        woken = known[due & ~known["over"]]
        # One wake for an attempt; an ended record is forgotten. The timer that went off is gone.
        left = known[~(due & known["over"])]
        self._keep(left.assign(due_ms=left["due_ms"].mask(due, NO_TIME)), NO_TIME)
        if len(woken):
            yield woken.assign(queue=key[0])[["queue", "record_id", "tries", "due_ms"]]

    def close(self) -> None:
        pass


def use_timers(spark: SparkSession) -> None:
    """Sets the session's state store to one that has timers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def due_records(
    attempts: DataFrame, retry: RetryPolicy, lateness: str = "0 seconds", forget_ms: int = 86_400_000, clock: str = "event"
) -> DataFrame:
    """Records of a stream of ``attempts`` (as in the ledger) whose time to be sent again has come: ``queue``,
    ``record_id``, ``tries`` so far and ``due_ms``.

    With ``clock="event"`` time is what the attempts' ``at_ms`` say, minus ``lateness`` (attempts later than that are not
    seen), so that a stream read again gives the same; with ``"processing"`` it is the clock of the cluster. A retryable
    failure waits by ``retry`` or as long as the receiver asked; a cancelled send, or one past a caller's deadline,
    leaves its record due at once. Attempts without queue, record, number or time are no attempts and left out.
    Attempts of a record count by number, then time; a lower or equal number that comes later changes nothing.
    The session needs :func:`use_timers`.
    """
    known = attempts.where("queue is not null and record_id is not null and attempt is not null and at_ms is not null")
    judged = with_due(known.withColumn("outcome", attempt_class()), retry.for_outbox())
    waits = F.when(F.col("outcome") == RETRYABLE, F.col("next_due_ms")).otherwise(F.col("at_ms"))
    rows = judged.select(
        "queue",
        F.shiftright("record_id", BLOCK_BITS).alias("block"),
        "record_id",
        "attempt",
        "at_ms",
        removal(F.col("outcome"), F.col("error_class")).alias("removed"),
        waits.alias("due_ms"),
        F.timestamp_millis("at_ms").alias("at"),
    )
    if clock not in ("event", "processing"):
        raise ValueError(f"unknown clock: {clock!r}")
    if clock == "event":
        rows = rows.withWatermark("at", lateness)
    mode = "EventTime" if clock == "event" else "ProcessingTime"
    return rows.groupBy("queue", "block").transformWithStateInPandas(RetryTimers(forget_ms, clock), DUE, "Append", mode)
