import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from seriesship import ClientConfig, RetryPolicy
from seriesship.functions import wire
from seriesship.operators import outbox as X
from seriesship.operators.deliver import deliver
from seriesship.schema import ATTEMPTS, REQUESTS
from seriesship.streaming.intake import drain, enqueue

# Transports run in tasks, which do not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLIENT = ClientConfig("http://h/{tenant}/w", retry=RetryPolicy(1, 1000, 30_000))


def body(n):
    return wire.compress(wire.series_wire(b"", [(float(n), n)]))


def request(i, queue="q", at=0, data=None, headers=None):
    return (i, queue, "t", body(i) if data is None else data, "", "", "", headers, at, None)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), REQUESTS)


def value(data):
    return int(wire.decode_body(data)[0][1][0]["value"])


@pytest.fixture
def box(spark, tmp_path):
    return X.Outbox(spark, str(tmp_path / "outbox"))


def ids(df):
    return sorted((r.queue, r.record_id) for r in df.select("queue", "record_id").collect())


def totals(box):
    """All counters of the single queue ``q``."""
    corrupt = box.finished().where("why = 'corrupt'")
    [r] = X.counters(box.records(), box.attempts(), corrupt).collect()
    return {k: v for k, v in r.asDict().items() if k != "queue" and v}


def test_ids_continue_and_epochs_repeat(spark, box):
    enqueue(box, requests(spark, request(7, at=2), request(3, at=1), request(1, "r")), 0, CLIENT)
    assert ids(box.records()) == [("q", 1), ("q", 2), ("r", 1)]
    second = requests(spark, request(9))
    enqueue(box, second, 1, CLIENT)
    enqueue(box, second, 1, CLIENT)
    assert ids(box.records()) == [("q", 1), ("q", 2), ("q", 3), ("r", 1)]
    assert [value(r.body) for r in box.records().where("queue = 'q'").orderBy("record_id").collect()] == [3, 7, 9]


def test_forbidden_headers_are_refused_at_the_door(spark, box):
    enqueue(box, requests(spark, request(1, headers={"content-type": ["x"]}), request(2)), 0, CLIENT)
    assert [value(r.body) for r in box.records().collect()] == [2]
    assert [(value(r.body), r.reason) for r in box.rejected().collect()] == [(1, X.FORBIDDEN)]


def test_budget_counts_what_still_waits(spark, box):
    small = 40
    enqueue(box, requests(spark, *[request(i, at=i) for i in range(5)]), 0, CLIENT, max_pending_bytes=3 * small)
    kept = box.records().count()
    assert 0 < kept < 5
    drain(box, CLIENT, lambda u, h, b: {"status": 200}, 100, now_ms=5)
    enqueue(box, requests(spark, request(8)), 1, CLIENT, max_pending_bytes=3 * small)
    assert box.records().count() == kept + 1


def test_what_does_not_fit_is_kept_as_rejected(spark, box):
    enqueue(box, requests(spark, *[request(i, at=i) for i in range(5)]), 0, CLIENT, max_pending_bytes=120)
    kept = {value(r.body) for r in box.records().collect()}
    lost = {(value(r.body), r.reason) for r in box.rejected().collect()}
    assert kept and {i for i, _ in lost} == set(range(5)) - kept and {w for _, w in lost} == {X.OVER_BUDGET}


def plain(spark, *rows):
    return spark.createDataFrame([(i, "q", "t", b"x" * 3 + bytes([i]), "", "", "", None, i, size) for i, size in rows], REQUESTS)


def test_repeat_after_a_drain(spark, box):
    """Epoch 2 given again, with more room by now, gives the same records and ids."""
    box.append(plain(spark, (1, 90)), 1, 100)
    second = plain(spark, (2, 50), (3, 10))
    box.append(second, 2, 100)
    stored = sorted((r.record_id, r.size_bytes) for r in box.records().collect())
    assert stored == [(1, 90), (2, 10)]
    drained = spark.createDataFrame([(1, "q", 1, 0, "send", 200, None, None, None, None)], ATTEMPTS)
    box.settle(drained, 0, RetryPolicy())
    box.append(second, 2, 100)
    assert sorted((r.record_id, r.size_bytes) for r in box.records().collect()) == stored
    assert [(r.record_id, r.size_bytes) for r in box.waiting().collect()] == [(2, 10)]
    assert [r.size_bytes for r in box.rejected().collect()] == [50]


def test_writers_and_new_checkpoints(spark, box):
    box.append(plain(spark, (1, 5)), 0, writer="a")
    box.append(plain(spark, (2, 5)), 0, writer="b")
    assert ids(box.records()) == [("q", 1), ("q", 2)]
    with pytest.raises(ValueError, match="other requests"):  # a stream that counts from 0 again
        box.append(plain(spark, (3, 5)), 0, writer="a")
    box.append(plain(spark, (3, 5)), 0, writer="a2")
    assert ids(box.records()) == [("q", 1), ("q", 2), ("q", 3)]
    with pytest.raises(ValueError):
        box.append(plain(spark, (4, 5)), 0, writer="../x")


def test_an_append_that_broke_off_does_not_show(spark, box):
    box._write(plain(spark, (9, 5)).withColumn("record_id", F.lit(1)).select(*X._names(X.RECORDS)), "records", "main", 0)
    assert box.records().count() == 0 == box.waiting().count()
    box.append(plain(spark, (1, 5)), 0)
    assert ids(box.records()) == [("q", 1)]


def test_picking_reads_no_bodies(spark, box):
    box.append(plain(spark, (1, 5)), 0)
    plan = X.drain_slice(box.waiting(), 0)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("body" in line or "headers" in line for line in scans)


def test_outcomes_stay_in_their_queue(spark):
    snapshot = spark.createDataFrame([(1, "a", 5, 0), (1, "b", 5, 0)], "record_id bigint, queue string, size_bytes bigint, next_due_ms bigint")
    tries = spark.createDataFrame([(1, "a", 1, 0, "send", 200, None, None, None, None)], ATTEMPTS)
    assert ids(X.apply_outcomes(snapshot, tries, RetryPolicy())) == [("b", 1)]


def test_fifo_delivery_and_counters(spark, box, tmp_path):
    log = tmp_path / "sent"

    def transport(url, headers, data):
        with open(log, "a") as f:
            f.write(f"{url} {headers['User-Agent'][0]} {value(data)}\n")
        return {"status": 204}

    enqueue(box, requests(spark, *[request(i, at=i) for i in range(1, 8)]), 0, CLIENT)
    drain(box, CLIENT, transport, 0, now_ms=10)
    assert log.read_text().split("\n")[:-1] == [f"http://h/t/w seriesship {i}" for i in range(1, 8)]
    assert totals(box) == {"enqueued": 7, "sent": 7}
    assert box.waiting().count() == 0


def test_retry_keeps_the_queue_in_order(spark, box, tmp_path):
    log = tmp_path / "sent"

    def transport(url, headers, data):
        with open(log, "a") as f:
            f.write(f"{value(data)} ")
        tries = log.read_text().split().count("1")
        return {"status": 503} if value(data) == 1 and tries == 1 else {"status": 200}

    enqueue(box, requests(spark, request(1), request(2)), 0, CLIENT)
    drain(box, CLIENT, transport, 0, now_ms=0)
    assert [(r.record_id, r.next_due_ms) for r in box.waiting().orderBy("record_id").collect()] == [(1, 1000), (2, 0)]
    drain(box, CLIENT, transport, 1, now_ms=999)
    assert log.read_text() == "1 "
    drain(box, CLIENT, transport, 2, now_ms=1000)
    assert log.read_text() == "1 1 2 "
    assert totals(box) == {"enqueued": 2, "sent": 2, "send_failures": 1, "retryable_failures": 1}


def test_retry_after_and_growing_waits(spark, box):
    enqueue(box, requests(spark, request(1)), 0, CLIENT)
    due = []
    for epoch, header in enumerate([None, "60", None]):
        answer = {"status": 429, "retry_after": header}
        drain(box, CLIENT, lambda u, h, b, a=answer: a, epoch, now_ms=due[-1] if due else 0)
        due.append(box.waiting().first().next_due_ms)
    assert due == [1000, 61_000, 65_000]


def test_permanent_failure_drops(spark, box):
    enqueue(box, requests(spark, request(1)), 0, CLIENT)
    drain(box, CLIENT, lambda u, h, b: {"status": 400}, 0, now_ms=0)
    assert totals(box) == {"enqueued": 1, "send_failures": 1, "permanent_failures": 1, "dropped": 1}
    assert X.pending(box.waiting()).count() == 0


def test_cancelled_send_leaves_the_record(spark, box):
    enqueue(box, requests(spark, request(1), request(2)), 0, CLIENT)
    drain(box, CLIENT, lambda u, h, b: {"error_class": "cancelled"}, 0, now_ms=0)
    assert ids(box.waiting()) == [("q", 1), ("q", 2)]
    assert totals(box) == {"enqueued": 2}


def test_corrupt_record_does_not_block(spark, box):
    enqueue(box, requests(spark, request(1, data=b"not-an-envelope"), request(2, at=1)), 0, CLIENT)
    drain(box, CLIENT, lambda u, h, b: {"status": 200}, 0, now_ms=0)
    assert box.waiting().count() == 0
    assert totals(box) == {"enqueued": 2, "sent": 1, "dropped": 1, "corrupt": 1}


def test_repeated_drain_epoch_is_harmless(spark, box):
    enqueue(box, requests(spark, request(1)), 0, CLIENT)
    for _ in range(2):
        drain(box, CLIENT, lambda u, h, b: {"status": 200}, 0, now_ms=0)
    assert box.waiting().count() == 0 and box.attempts().count() == 1


def test_transport_errors_become_attempts(spark):
    def transport(url, headers, data):
        raise OSError("connection refused")

    line = requests(spark, request(1), request(2)).withColumn("record_id", F.col("request_id"))
    [r] = deliver(line, CLIENT, transport, 0).collect()
    assert (r.record_id, r.error_class, r.error_text) == (1, "other", "connection refused")
    assert deliver(line, CLIENT, transport, 0, concurrency=2).count() == 2


def test_drain_slice(spark):
    rows = [("q", i, 100 if i in (3, 5) else 0) for i in range(1, 8)] + [("r", 1, 0), ("s", 1, 100)]
    df = spark.createDataFrame(rows, "queue string, record_id bigint, next_due_ms bigint")
    for n, want in ((1, [1, 2]), (2, [1, 2, 4]), (3, [1, 2, 4, 6, 7])):
        assert ids(X.drain_slice(df, 50, n)) == [("q", i) for i in want] + [("r", 1)]
    plan = X.drain_slice(df, 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan, "each task keeps a few waiting records per queue"


def test_outcomes_applied_to_a_snapshot(spark):
    rows = [(i, "q", 5, 0) for i in range(1, 6)]
    snapshot = spark.createDataFrame(rows, "record_id bigint, queue string, size_bytes bigint, next_due_ms bigint")
    answers = {1: (200, None), 2: (503, None), 3: (400, None), 4: (None, "deadline")}
    tries = [
        (i, "q", n, 10 * n, "send", s if n == 2 else 503, e if n == 2 else None, None, None, None)
        for i, (s, e) in answers.items() for n in (1, 2)
    ]
    left = X.apply_outcomes(snapshot, spark.createDataFrame(tries, ATTEMPTS), RetryPolicy())
    assert {r.record_id: r.next_due_ms for r in left.collect()} == {2: 20 + 2000, 4: 0, 5: 0}


def test_recovery(spark):
    rows = [(1, "sending", 9), (2, "pending", 0), (3, "corrupt", 0)]
    df = spark.createDataFrame(rows, "record_id bigint, state string, next_due_ms bigint")
    assert [(r.record_id, r.state, r.next_due_ms) for r in X.recover(df).collect()] == [
        (1, "pending", 0), (2, "pending", 0)
    ]


def test_requests_without_queue_are_refused(spark, box):
    rows = requests(spark, request(1, None, data=b"x"), request(2, "q", data=b"y"), request(3, "q", data=b"z"))
    enqueue(box, rows, 0, CLIENT, max_pending_bytes=1000)
    assert ids(box.records()) == [("q", 1), ("q", 2)]
    assert [(r.body, r.reason) for r in box.rejected().collect()] == [(b"x", X.NO_QUEUE)]


def test_repeated_requests_are_records_of_their_own(spark, box):
    """Equal queue, arrival and id, equal bodies among them; null arrival times and ids come first."""
    rows = [request(5, at=1, data=bytes([n])) for n in (1, 2, 3, 3)] + [(None, "q", "t", b"n", "", "", "", None, None, None)]
    enqueue(box, requests(spark, *rows), 0, CLIENT)
    stored = {r.record_id: r.body for r in box.records().collect()}
    assert sorted(stored) == [1, 2, 3, 4, 5] and stored[1] == b"n"
    assert sorted(stored.values()) == [b"\x01", b"\x02", b"\x03", b"\x03", b"n"]


def test_repeated_requests_under_a_budget(spark, box):
    rows = plain(spark, *[(7, 10)] * 6, (8, 10))
    box.append(rows, 0, 45)
    assert sorted(r.record_id for r in box.records().collect()) == [1, 2, 3, 4]
    assert [r.request_id for r in box.rejected().orderBy("request_id").collect()] == [7, 7, 8]


def counter(spark):
    from seriesship.schema import FAMILY_METRICS

    return spark.createDataFrame([("q", 0, 0, "c", "COUNTER", [], None, 1.0, None, None)], FAMILY_METRICS)


def test_a_repeated_epoch_without_a_set_clock(spark, box):
    """A micro-batch comes again after a crash, at another time, and changes nothing; another batch is refused."""
    from seriesship import PushConfig
    from seriesship.plans.push import push
    from seriesship.streaming.intake import to_requests

    batch = counter(spark)
    for now in (1_000, 2_000):
        enqueue(box, to_requests(push(batch, PushConfig(now_ms=now))), 0, CLIENT, given=X.digest(batch))
    assert ids(box.records()) == [("q", 1)]
    with pytest.raises(ValueError, match="other requests"):
        other = batch.withColumn("value", F.lit(2.0))
        enqueue(box, to_requests(push(other, PushConfig())), 0, CLIENT, given=X.digest(other))


def test_digest_sees_every_column(spark):
    base = requests(spark, request(1, headers={"a": ["x"], "b": []}))
    same = requests(spark, request(1, headers={"b": [], "a": ["x"]}))
    assert X.digest(base) == X.digest(same)
    for change in ({"headers": F.create_map(F.lit("a"), F.array(F.lit("y")))}, {"protocol_version": F.lit("2")}, {"size_bytes": F.lit(9)}):
        assert X.digest(base) != X.digest(base.withColumns(change))
    assert X.digest(base) != X.digest(base.union(base))


def history(spark, box, turns):
    """Appends and drains in turn; some bodies fail for now, some for good."""
    def answer(url, headers, data):
        n = value(data)
        return {"status": [204, 503, 400, 204, 204][n % 5]}

    for t in turns:
        enqueue(box, requests(spark, *[request(5 * t + i, f"q{i % 2}", at=i) for i in range(5)]), t, CLIENT, max_pending_bytes=400)
        drain(box, CLIENT, answer, t, now_ms=1_000 * t, concurrency=2)


def seen(box):
    cols = ("queue", "record_id", "size_bytes", "writer", "epoch", "next_due_ms", "tries")
    return sorted(tuple(r[c] for c in cols) for r in box.waiting().collect())


def test_snapshots_change_nothing_but_what_is_read(spark, box, tmp_path):
    plain_box = X.Outbox(spark, str(tmp_path / "plain"))
    for t in range(3):
        history(spark, box, [t])
        history(spark, plain_box, [t])
        if t:
            assert box.compact() is not None
        assert seen(box) == seen(plain_box) and seen(box)
    assert ids(box.records()) == ids(plain_box.records()) and ids(box.rejected().withColumn("record_id", F.col("request_id"))) == ids(
        plain_box.rejected().withColumn("record_id", F.col("request_id"))
    )
    # Nothing that the snapshot covers is opened any more.
    for file in (tmp_path / "outbox").glob("*/writer=*/epoch=[01]/*.parquet"):
        file.write_bytes(b"no table")
    assert seen(box) == seen(plain_box)
    enqueue(box, requests(spark, request(99)), 9, CLIENT)
    assert ("q", 1) in [r[:2] for r in seen(box)]
    assert box.compact() == 2 and box.compact() is None  # nothing new


def test_ends_of_records_that_a_snapshot_does_not_cover(spark, box):
    """Drains 0 and 1 are covered while the append they emptied is not: its records stay gone, tries are kept."""
    enqueue(box, requests(spark, request(1), request(2, "r"), request(3, "r")), 0, CLIENT)
    busy = lambda u, h, b: {"status": 204 if value(b) == 1 else 503}
    drain(box, CLIENT, busy, 0, now_ms=0)
    drain(box, CLIENT, busy, 1, now_ms=5_000)
    drain(box, CLIENT, lambda u, h, b: {"status": 503}, 2, now_ms=50_000)
    before = seen(box)
    assert box.compact() == 0 and box._snapshot()[1] == {("attempts", "drain"): 1, ("finished", "drain"): 1}
    assert seen(box) == before and [r[1:2] + r[6:] for r in before] == [(1, 3), (2, 0)]
    enqueue(box, requests(spark, request(4, "r")), 1, CLIENT)
    assert box.compact() == 1 and ids(box.waiting()) == [("r", 1), ("r", 2), ("r", 3)]


def test_epochs_in_a_snapshot_are_not_drained_again(spark, box):
    history(spark, box, range(3))
    box.compact()
    with pytest.raises(ValueError, match="snapshot"):
        box.waiting(without=(X.DRAINS, 0))
    assert box.waiting(without=(X.DRAINS, 2)).count() >= box.waiting().count()
    second = requests(spark, *[request(5 + i, f"q{i % 2}", at=i) for i in range(5)])
    kept = ids(box.records())
    enqueue(box, second, 1, CLIENT, max_pending_bytes=400)  # a covered append given again
    assert ids(box.records()) == kept
