"""Sequential operators against plain loops, with a key that spans most partitions."""

import random

import pytest

from seriesship.operators import ordered
from seriesship.operators.batching import assign_batches, batch_numbers, batch_numbers_by_count
from seriesship.operators.outbox import admit
from seriesship.operators.rate import rate_schedule, with_deadline


def hot(i, rng):
    return "hot" if i % 3 else rng.choice("abcz")


def plain_batches(rows, max_n, max_b):
    out, state = {}, {}
    for k, o, n, b in sorted(rows):
        if n:
            s = state.setdefault(k, [0, 0, 0])
            out[k, o] = s[2]
            s[0], s[1] = s[0] + n, s[1] + b
            if s[0] >= max_n or s[1] >= max_b:
                state[k] = [0, 0, s[2] + 1]
    return out


@pytest.fixture(scope="module")
def units(spark):
    rng = random.Random(5)
    rows = [(hot(i, rng), i, rng.randint(0, 3), rng.randint(16, 60)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o bigint, n bigint, b bigint").persist()
    return rows, df


@pytest.mark.parametrize("parts,fan", [(1, 64), (13, 64), (13, 2)])
@pytest.mark.parametrize("max_n,max_b", [(5, 120), (1000, 333), (1, 1), (10**6, 10**9), (3, 10**9)])
def test_batches(units, max_n, max_b, parts, fan):
    rows, df = units
    got = batch_numbers(df, "k", ["o"], max_n, max_b, parts, fan).collect()
    assert {(r.k, r.o): r.batch_no for r in got} == plain_batches(rows, max_n, max_b)


def test_partitions_with_too_many_rows_are_split_again(units, monkeypatch):
    rows, df = units
    monkeypatch.setattr(ordered, "ROWS_PER_PART", 60)
    key = df.where("n > 0").selectExpr("k", "o")
    assert len(ordered.split_ordered(key, "k", ["o"], partitions=1).parts) > 5
    got = batch_numbers(df, "k", ["o"], 17, 517, 1).collect()
    assert {(r.k, r.o): r.batch_no for r in got} == plain_batches(rows, 17, 517)


def test_small_partitions_are_not_put_together_beyond_the_limit(spark, monkeypatch):
    """Many narrow rows would fit into few partitions by their bytes; tasks hold them as arrays."""
    monkeypatch.setattr(ordered, "ROWS_PER_PART", 5_000)
    rows = spark.range(40_000).selectExpr("id % 2 as k", "id as o")
    before = {n: spark.conf.get(n) for n in ("spark.sql.adaptive.coalescePartitions.parallelismFirst",)}
    seen, jobs = [], ordered.split_ordered
    monkeypatch.setattr(ordered, "split_ordered", lambda *a, **k: seen.append(a) or jobs(*a, **k))
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        split = ordered.split_ordered(rows, "k", ["o"])
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert max(p.rows for p in split.parts) <= 5_000 and sum(p.rows for p in split.parts) == 40_000
    assert len(seen) == 1  # split once, not again


def test_partitions_hold_a_bounded_number_of_rows():
    """Four tasks of an executor, at 500 bytes a row, have to stay well under its memory."""
    assert 4 * 500 * ordered.ROWS_PER_PART <= 2_000_000_000


def test_batches_by_count(units):
    rows, df = units
    got = batch_numbers_by_count(df, "k", ["o"], 7, 9).collect()
    assert {(r.k, r.o): r.batch_no for r in got} == plain_batches(
        [(k, o, 1, 0) for k, o, _, _ in rows], 7, 10**9
    )


def sizes(df):
    rows = df.groupBy("batch_no").count().orderBy("batch_no").collect()
    return [r["count"] for r in rows]


def series(spark, names, text=""):
    rows = [
        ("p", i, [("__name__", n), ("label", text or n)], [(1.0, 1)]) for i, n in enumerate(names)
    ]
    return spark.createDataFrame(
        rows,
        "push_key string, ord bigint, labels array<struct<name:string,value:string>>, "
        "samples array<struct<value:double,timestamp:bigint>>",
    )


def test_series_limits(spark):
    five = series(spark, [f"m{i}" for i in range(1, 6)])
    assert sizes(assign_batches(five, order="ord", max_series=2, atomic="series")) == [2, 2, 1]
    three = series(spark, ["a", "b", "c"], "x" * 100)
    assert sizes(assign_batches(three, order="ord", max_bytes=100, atomic="series")) == [1, 1, 1]
    assert sizes(assign_batches(five, order="ord", atomic="series")) == [5]


def test_families_stay_whole(spark):
    rows = [("p", i // 3, i, [("__name__", f"metric_{i // 3}")], 1.0, 1) for i in range(9)]
    df = spark.createDataFrame(
        rows,
        "push_key string, family_ord bigint, metric_ord bigint, "
        "labels array<struct<name:string,value:string>>, value double, timestamp bigint",
    )
    assert sizes(assign_batches(df, max_series=4)) == [6, 3]
    assert sizes(assign_batches(df, max_series=1)) == [3, 3, 3]


@pytest.fixture(scope="module")
def line(spark):
    rng = random.Random(8)
    rows = []
    for i in range(350):
        at = rng.randint(0, 40_000)
        size = rng.choice([10, 50, 200, 900, 1000, 1001, 3500])
        rows.append((hot(i, rng), at, i, size, at + rng.choice([0, 500, 3000, 20_000])))
    schema = "k string, arrival_ms bigint, request_id bigint, size_bytes bigint, deadline_ms bigint"
    return rows, spark.createDataFrame(rows, schema).persist()


def plain_limiter(rows, limit, deadlines):
    out, state = {}, {}
    for k, at, i, size, until in sorted(rows):
        s = state.setdefault(k, [0, -(1 << 60), -(1 << 60)])
        now, out[i] = max(at, s[2]), None
        if deadlines and now > until:
            continue
        while size > 0:
            piece = min(size, limit)
            if s[0] < piece:
                if deadlines and max(now, s[1]) > until:
                    s[2] = until
                    break
                now = max(now, s[1])
                s[0], s[1] = limit, now + 1000
            s[0] -= piece
            size -= piece
        else:
            s[2] = out[i] = now
    return out


@pytest.mark.parametrize("limit", [1000, 100, 10**6, 3000])
def test_rate_limits(line, limit):
    rows, df = line
    for parts, fan in ((1, 64), (13, 2)):
        got = rate_schedule(df, "k", limit, partitions=parts, fan=fan).collect()
        assert {r.request_id: r.admit_ms for r in got} == plain_limiter(rows, limit, False)
    got = with_deadline(df, "k", limit, partitions=13).collect()
    assert {r.request_id: r.admit_ms for r in got} == plain_limiter(rows, limit, True)


def test_limiter_literals(spark):
    def admits(limit, *sizes):
        rows = [("k", 0, i, s) for i, s in enumerate(sizes)]
        df = spark.createDataFrame(rows, "k string, arrival_ms bigint, request_id bigint, size_bytes bigint")
        got = rate_schedule(df, "k", limit).orderBy("request_id").collect()
        return [r.wait_ms for r in got]

    assert admits(1000, 1000, 100) == [0, 1000]
    assert admits(32 * 1024, 64 * 1024) == [1000]
    assert admits(1000, 0, -5, None) == [0, 0, 0]
    assert admits(0, 10**9, 10**9) == [0, 0]


def plain_admission(rows, limit, before):
    out, state = {}, {}
    for k, at, i, size, _ in sorted(rows):
        used, n = state.get(k, (before.get(k, 0), 0))
        ok = used < limit and used + size <= limit
        state[k] = (used + size, n + 1) if ok else (used, n)
        out[i] = (ok, n + 1 if ok else None)
    return out


@pytest.mark.parametrize("limit", [5, 7000, 60_000, 10**9])
@pytest.mark.parametrize("before", [{}, {"hot": 6_500, "a": 10}])
def test_admission(spark, line, limit, before):
    rows, df = line
    pending = spark.createDataFrame(list(before.items()), "k string, pending_bytes bigint") if before else None
    for parts in (1, 13):
        got = admit(df, "k", ["arrival_ms", "request_id"], limit, pending=pending, partitions=parts).collect()
        want = plain_admission(rows, limit, before)
        assert {r.request_id: (r.accepted, r.accept_no) for r in got} == want


def test_unlimited_admission(line):
    rows, df = line
    got = admit(df, "k", ["arrival_ms", "request_id"], 0, partitions=5).collect()
    assert len(got) == len(rows) and all(r.accepted for r in got)


def test_admission_settles_queues_side_by_side(spark):
    """Many queues that fill up take no more jobs than one."""

    def jobs(queues):
        rng = random.Random(7)
        rows = [(f"q{i % queues}", i, i, rng.randint(50, 60)) for i in range(40 * queues)]
        df = spark.createDataFrame(rows, "k string, arrival_ms bigint, request_id bigint, size_bytes bigint")
        group = f"admission-{queues}"
        spark.sparkContext.setJobGroup(group, group)
        got = admit(df, "k", ["arrival_ms", "request_id"], 700, partitions=2 * queues).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sum(r.accepted for r in got) in range(11 * queues, 14 * queues + 1)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(8) <= jobs(2) + 3


@pytest.mark.parametrize("partitions", [1, 5])
def test_null_keys_are_one_key(spark, partitions):
    from seriesship.operators.batching import assign_batches
    from seriesship.schema import SERIES

    rows = [(k, i, [("__name__", "m")], [(1.0, i)]) for k in (None, "", "k") for i in range(7)]
    df = spark.createDataFrame(rows, SERIES)
    out = assign_batches(df, order="ord", max_series=2, atomic="series", partitions=partitions)
    assert out.columns == [*df.columns, "batch_no"]
    got = sorted((str(r.push_key), r.ord, r.batch_no) for r in out.collect())
    assert got == sorted((str(k), i, i // 2) for k in (None, "", "k") for i in range(7))


def test_repeated_order_values_multiply_nothing(spark):
    from seriesship.operators.batching import assign_batches
    from seriesship.schema import SERIES

    rows = [("k", o, [("__name__", f"m{n}")], [(1.0, 1)]) for n, o in enumerate([0, 1, 1, 1, 2, None, None])]
    out = assign_batches(spark.createDataFrame(rows, SERIES), order="ord", max_series=2, atomic="series").collect()
    assert sorted(r.labels[0].value for r in out) == [f"m{n}" for n in range(7)]
    assert sorted((r.ord is not None, r.ord or 0, r.batch_no) for r in out) == [
        (False, 0, 0), (False, 0, 0), (True, 0, 1), (True, 1, 1), (True, 1, 1), (True, 1, 1), (True, 2, 2),
    ]


def test_null_keys_reach_a_body(spark):
    from seriesship.operators.encode import encode_batches

    rows = [(k, 0, i, [("__name__", "m")], [(1.0, i)]) for k in (None, "k") for i in range(3)]
    schema = "push_key string, batch_no bigint, ord bigint, labels array<struct<name:string,value:string>>, samples array<struct<value:double,timestamp:bigint>>"
    out = encode_batches(spark.createDataFrame(rows, schema), order="ord").collect()
    assert sorted((str(r.push_key), r.n_series) for r in out) == [("None", 3), ("k", 3)]


def test_null_queues_are_admitted_as_one(spark):
    from seriesship.operators.outbox import admit

    rows = [(k, i, 10) for k in (None, "q") for i in range(5)]
    df = spark.createDataFrame(rows, "queue string, request_id bigint, size_bytes bigint")
    pending = spark.createDataFrame([(None, 10), ("q", 20)], "queue string, pending_bytes bigint")
    for partitions in (1, 6):
        got = admit(df, "queue", ["request_id"], 40, pending=pending, partitions=partitions).collect()
        assert sorted((str(r.queue), r.request_id) for r in got if r.accepted) == [("None", 0), ("None", 1), ("None", 2), ("q", 0), ("q", 1)]
