import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesship import RetryPolicy
from seriesship.operators.outbox import apply_outcomes
from seriesship.schema import ATTEMPTS
from seriesship.streaming import timers as T

RETRY = RetryPolicy(5, 1_000, 8_000)


@pytest.fixture
def feed(spark, tmp_path):
    """Attempts written file by file and read as a stream; ``run`` goes on from the stream's checkpoint."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    T.use_timers(spark)
    folder, out, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))

    def run(*rows, keep=1_000_000):
        spark.createDataFrame([attempt(*r) for r in rows], ATTEMPTS).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(ATTEMPTS).option("maxFilesPerTrigger", 1).parquet(folder)
        due = T.due_records(stream, RETRY, forget_ms=keep)
        query = due.writeStream.option("checkpointLocation", marks).trigger(availableNow=True).start(out, format="parquet")
        query.awaitTermination()
        return sorted((r.queue, r.record_id, r.tries, r.due_ms) for r in spark.read.parquet(out).collect())

    yield run
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def attempt(queue, record, number, at, status=503, error=None, after=None):
    return (record, queue, number, at, "send", status, error, None, after, None)


#: Moves time on; its own record is finished.
def clock(at):
    return ("clock", at, 1, at, 204)


def test_wakes_survive_restarts(feed):
    """Every call is a stream of its own that goes on from the checkpoint of the one before."""
    assert feed(("q", 1, 1, 10_000), ("q", 2, 1, 10_000, 204), ("r", 1, 1, 10_500, 503, None, "5"), clock(10_900)) == []
    woken = [("q", 1, 1, 11_000)]
    assert feed(clock(12_000)) == woken
    # The second try fails too, before anyone asks again; record 2 is read again and stays finished.
    assert feed(("q", 1, 2, 12_500), ("q", 2, 1, 12_500, 503), clock(14_000)) == woken
    woken += [("q", 1, 2, 14_500)]
    assert feed(clock(15_000)) == woken
    assert feed(("q", 1, 3, 15_100, 200), clock(15_600)) == sorted(woken + [("r", 1, 1, 15_500)])
    assert feed(clock(60_000)) == sorted(woken + [("r", 1, 1, 15_500)])


def test_a_later_attempt_moves_the_timer(feed):
    assert feed(("q", 1, 1, 10_000), ("q", 1, 2, 10_100), ("q", 1, 1, 10_050), clock(10_200)) == []
    assert feed(("q", 1, 1, 10_300), clock(12_099)) == []
    assert feed(clock(12_200)) == [("q", 1, 2, 12_100)]


def test_cancelled_sends_are_due_at_once_and_permanent_ones_never(feed):
    rows = [("q", 1, 1, 10_000, None, "cancelled"), ("q", 2, 1, 10_000, None, "deadline"), ("q", 3, 1, 10_000, 400)]
    assert feed(*rows, clock(10_001)) == [("q", 1, 1, 10_000), ("q", 2, 1, 10_000)]


def test_ended_records_are_forgotten(feed):
    feed(("q", 1, 1, 10_000, 204), clock(10_001), keep=2_000)
    feed(clock(13_000), keep=2_000)
    assert feed(("q", 1, 1, 13_500), clock(15_000), keep=2_000) == [("q", 1, 1, 14_500)]


def test_rows_that_are_no_attempts(feed):
    assert feed((None, 1, 1, 1), ("q", None, 1, 1), ("q", 1, None, 1), ("q", 1, 1, None), clock(90_000)) == []


def test_the_stream_agrees_with_the_batch(spark, feed):
    rows = [(f"q{i % 3}", i % 40, 1 + i // 40, 10_000 + 37 * i, [503, 204, 429, 400][i * i % 7 % 4]) for i in range(200)]
    rows = [r for i, r in enumerate(rows) if not any(p[:2] == r[:2] and p[4] in (204, 400) for p in rows[:i])]
    now = max(r[3] for r in rows)
    attempts = spark.createDataFrame([attempt(*r) for r in rows], ATTEMPTS)
    box = attempts.select("queue", "record_id").distinct().withColumn("next_due_ms", F.lit(0).cast("bigint"))
    left = apply_outcomes(box, attempts, RETRY).where(F.col("next_due_ms") <= now).collect()
    got = feed(*rows, clock(now))
    assert [g[:2] + g[3:] for g in got] == sorted((r.queue, r.record_id, r.next_due_ms) for r in left) and len(got) > 5


def test_unknown_clock(spark):
    with pytest.raises(ValueError, match="clock"):
        T.due_records(spark.createDataFrame([], ATTEMPTS), RETRY, clock="sun")


class Store:
    """A block's state and its timers, without a stream. Counts how often the state is read and written."""

    def __init__(self):
        self.value, self.timers, self.uses = None, set(), 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        self.uses += 1
        return self.value

    def update(self, value):
        self.uses += 1
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


class At:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.now


def test_neighbours_share_one_state_and_one_timer():
    store = Store()
    timers = T.RetryTimers(1_000)
    timers.init(store)
    columns = ["record_id", "attempt", "at_ms", "removed", "due_ms"]
    frame = lambda *rows: pd.DataFrame(rows, columns=columns)
    many = frame(*[(i, 1, 10, "sent" if i == 7 else None, 100 + i) for i in range(200)])
    assert list(timers.handleInputRows(("q", 0), iter([many[:90], many[90:]]), None)) == []
    assert store.timers == {100} and store.uses == 1
    [out] = timers.handleExpiredTimer(("q", 0), At(249), None)
    store.timers.remove(100)  # went off
    assert out["record_id"].tolist() == [i for i in range(150) if i != 7]
    assert store.timers == {250} and store.uses == 3
    # Read again, tried again, ended: records 3 (nothing new), 4 (again), 160 (gone before it was due).
    again = frame((3, 1, 10, None, 103), (4, 2, 300, None, 400), (160, 2, 300, "dropped", 300))
    assert list(timers.handleInputRows(("q", 0), iter([again]), None)) == []
    [out] = timers.handleExpiredTimer(("q", 0), At(2_000), None)
    assert out["record_id"].tolist() == [i for i in range(150, 200) if i != 160] + [4]
    assert out["tries"].tolist() == [1] * 49 + [2] and not {7, 160} & set(store.value[0])


def test_blocks_and_far_numbers(feed):
    rows = [("q", i, 1, 10_000) for i in (-(1 << 63), -1, 0, 255, 256, (1 << 63) - 1)]
    assert feed(*rows, clock(20_000)) == [("q", r[1], 1, 11_000) for r in rows]
