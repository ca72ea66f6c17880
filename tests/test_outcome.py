import pytest
from pyspark.sql import functions as F

from seriesship import RetryPolicy
from seriesship.operators import outcome as O


def column(spark, values, fn, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_statuses(spark):
    codes = {200: "success", 201: "success", 204: "success", 299: "success"}
    codes |= {c: "permanent" for c in (100, 304, 400, 401, 403, 404, 600, 700)}
    codes |= {c: "retryable" for c in (429, 500, 502, 503, 504, 599)}
    assert column(spark, list(codes), O.classify_status, "int") == list(codes.values())


@pytest.mark.parametrize(
    "kind,text,want",
    [
        ("cancelled", "", "permanent"),
        ("deadline", "timeout", "permanent"),
        ("client_timeout", "", "retryable"),
        ("timeout", "x509: slow", "retryable"),
        ("other", "x509: unknown", "permanent"),
        ("other", "bad certificate", "permanent"),
        ("other", "tls: handshake", "permanent"),
        ("other", "TLS handshake failed", "permanent"),
        ("other", "connection refused", "retryable"),
        ("eof", None, "retryable"),
    ],
)
def test_errors(spark, kind, text, want):
    df = spark.createDataFrame([(kind, text)], "c string, t string")
    assert df.select(O.classify_error(F.col("c"), F.col("t")).alias("o")).first().o == want


def test_retry_after(spark):
    headers = {
        None: 0, "": 0, "120": 120_000, "0": 0, "-10": 0, "not-a-number": 0, " 5": 0, "+7": 7000,
        "Thu, 01 Jan 1970 00:00:31 GMT": 30_000, "Thu, 01 Jan 1970 00:00:00 GMT": 0,
        "thu, 01 jan 1970 0:00:02 GMT": 1000, "01 Jan 1970 00:00:31": 0, "5\n": 0,
    }
    got = column(spark, list(headers), lambda c: O.retry_after_ms(c, F.lit(1000)), "string")
    assert got == list(headers.values())


def test_http_dates_are_gmt_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = column(spark, ["Thu, 01 Jan 1970 00:00:31 GMT"], lambda c: O.retry_after_ms(c, F.lit(1000)), "string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [30_000]


def test_backoff(spark):
    waits = lambda low, high, n: column(
        spark, list(range(1, n + 1)), lambda c: O.backoff_ms(c, RetryPolicy(n, low, high)), "int"
    )
    assert waits(50, 30_000, 3) == [50, 100, 200]
    assert waits(1000, 5000, 5) == [1000, 2000, 4000, 5000, 5000]
    assert waits(1000, 200, 3) == [1000, 200, 200]
    assert waits(1000, 30_000, 200)[-1] == 30_000
    assert RetryPolicy(0, 1000, 200).for_outbox().max_wait_ms == 1000
    assert RetryPolicy(0).for_requests() == RetryPolicy(1, 1000, 30_000, 10 * 1024 * 1024)


def test_jitter_bounds(spark):
    for wait, room in ((10_000, 1000), (300_000, 10_000), (5, 1)):
        got = column(spark, [wait] * 100, lambda c: O.with_jitter(c, 1), "bigint")
        assert all(wait <= v < wait + max(room, 1) for v in got)


def attempt(request, n, status=None, error=None, kind="send", text=None):
    return (request, n, n * 10, kind, status, error, text, None)


SCHEMA = (
    "request_id bigint, attempt int, at_ms bigint, kind string, status int, error_class string, "
    "error_text string, retry_after string"
)


def test_sync_outcomes(spark):
    rows = [
        attempt(1, 1, 503), attempt(1, 2, 200), attempt(1, 3, 400),
        attempt(2, 1, 503), attempt(2, 2, 429), attempt(2, 3, 500), attempt(2, 4, 200),
        attempt(3, 1, 400),
        attempt(4, 1, error="eof"), attempt(4, 1, 204, kind="eof_replay"),
        attempt(5, 1, error="eof"), attempt(5, 1, 503, kind="eof_replay"), attempt(5, 2, error="cancelled"),
        attempt(6, 1, error="other", text="x509: no"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.request_id: (r.attempts, r.retries, r.status, r.error_class, r.outcome)
           for r in O.sync_outcome(df, RetryPolicy(2)).collect()}
    assert got == {
        1: (2, 1, 200, None, "success"),
        2: (3, 2, 500, None, "exhausted"),
        3: (1, 0, 400, None, "permanent"),
        4: (1, 0, 204, None, "success"),
        5: (2, 1, None, "cancelled", "permanent"),
        6: (1, 0, None, "other", "permanent"),
    }
    replays = {r.request_id: (r.replays, r.counted_attempts) for r in O.eof_replays(df).collect()}
    assert replays[4] == (1, 1) and replays[5] == (1, 2) and replays[1] == (0, 3)


def test_messages(spark):
    rows = [
        ("refused", "503 Service Unavailable", None), ("refused", None, b"x"),
        (None, "400 Bad Request", b'say "no"\n'), (None, None, b"x"), (None, "500", b"y" * 5000),
    ]
    df = spark.createDataFrame(rows, "error_text string, status_text string, body binary")
    got = [r.message for r in O.failure_text(df).collect()]
    assert got[:4] == [
        f"{O.FAILED}: status=503 Service Unavailable err=refused",
        f"{O.FAILED}: refused",
        f'{O.FAILED}: status=400 Bad Request body="say \\"no\\"\\n"',
        O.FAILED,
    ]
    assert got[4].endswith('="' + "y" * 4096 + '"')


def test_quoted_bytes(spark):
    golden = {
        b"plain text": '"plain text"',
        b'a"b\\c': '"a\\"b\\\\c"',
        b"\n\r\t\x07\x08\x0c\x0b": '"\\n\\r\\t\\a\\b\\f\\v"',
        b"\x00\x1b\x7f": '"\\x00\\x1b\\x7f"',
        "n\u00e9 \u4e2d \U0001f642".encode(): '"n\u00e9 \u4e2d \U0001f642"',
        b"\xc2\xa0": '"\\u00a0"',
        b"\xe2\x80\x8b": '"\\u200b"',
        b"\xf3\xa0\x80\x81": '"\\U000e0001"',
        b"cut \xc3": '"cut \\xc3"',
        b"\xff\xe4\xb8": '"\\xff\\xe4\\xb8"',
        b"": '""',
    }
    df = spark.createDataFrame([(bytearray(b), w) for b, w in golden.items()], "b binary, want string")
    for r in df.select("want", O.quoted(F.col("b")).alias("got")).collect():
        assert r["got"] == r["want"]
