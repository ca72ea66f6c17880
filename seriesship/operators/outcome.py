"""What a delivery attempt means: classification, waits and the outcome of a retried request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.config import ERROR_BODY_BYTES, RetryPolicy
from seriesship.functions.text import retry_after_ms

SUCCESS, RETRYABLE, PERMANENT = "success", "retryable", "permanent"


def classify_status(status: Column) -> Column:
    return (
        F.when((status >= 200) & (status < 300), SUCCESS)
        .when((status == 429) | ((status >= 500) & (status < 600)), RETRYABLE)
        .otherwise(PERMANENT)
    )


def classify_error(error_class: Column, text: Column) -> Column:
    """Class of a transport error.

    ``error_class`` is one of cancelled, deadline, client_timeout, timeout, eof or anything else.
    """
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(error_class.isin("cancelled", "deadline"), PERMANENT)
        .when(error_class.isin("client_timeout", "timeout"), RETRYABLE)
        .when(text.contains("x509:") | text.contains("certificate"), PERMANENT)
        .when(text.contains("tls:") | text.contains("TLS handshake"), PERMANENT)
        .otherwise(RETRYABLE)
    )


def attempt_class() -> Column:
    """Class of an attempt row; a transport error counts before a status."""
    failed = F.col("error_class").isNotNull()
    return F.when(failed, classify_error(F.col("error_class"), F.col("error_text"))).otherwise(
        classify_status(F.col("status"))
    )


def classify(df: DataFrame) -> DataFrame:
    return df.withColumn("outcome", attempt_class())


def backoff_ms(k: Column, retry: RetryPolicy) -> Column:
    """Wait before retry ``k``: the minimum first, then doubled up to the maximum."""
    doubled = F.least(
        F.lit(float(retry.min_wait_ms)) * F.pow(F.lit(2.0), k - 1), F.lit(float(retry.max_wait_ms))
    )
    return F.when(k <= 1, F.lit(retry.min_wait_ms)).otherwise(doubled.cast("bigint")).cast("bigint")


def backoff_schedule(df: DataFrame, retry: RetryPolicy) -> DataFrame:
    """One row per possible retry of every input row."""
    policy = retry.for_requests()
    every = F.sequence(F.lit(1), F.lit(policy.max_retries))
    return df.select("*", F.explode(every).alias("retry")).withColumn(
        "wait_ms", backoff_ms(F.col("retry"), policy)
    )


def wait_ms(attempt: Column, header: Column, at_ms: Column, retry: RetryPolicy) -> Column:
    """Wait after a failed attempt: Retry-After if given; the schedule advances all the same."""
    asked = F.nullif(retry_after_ms(header, at_ms), F.lit(0).cast("bigint"))
    return F.coalesce(asked, backoff_ms(attempt, retry))


def with_due(df: DataFrame, retry: RetryPolicy) -> DataFrame:
    """Add ``wait_ms`` and ``next_due_ms``, the attempt's time plus its wait."""
    return df.withColumn(
        "wait_ms", wait_ms(F.col("attempt"), F.col("retry_after"), F.col("at_ms"), retry)
    ).withColumn("next_due_ms", F.col("at_ms") + F.col("wait_ms"))


def with_jitter(wait: Column, seed: int | None = None) -> Column:
    """Add up to a tenth of the wait, at most ten seconds."""
    room = F.least(wait / 10, F.lit(10000.0))
    return wait + F.floor(room * F.rand(seed)).cast("bigint")


def sync_outcome(attempts: DataFrame, retry: RetryPolicy, key: str = "request_id") -> DataFrame:
    """How each request ended.

    The first success or permanent failure ends it; after the first try and ``max_retries`` retries the
    last retryable failure is final. A stale-connection replay shares the number of the attempt it repeats
    and supersedes it. All aggregates combine before the shuffle, so a request with very many attempts
    needs no sort in one task.
    """
    last_try = retry.for_requests().max_retries + 1
    replayed = F.col("kind") == "eof_replay"
    rank = F.struct("attempt", replayed.cast("int").alias("replay"))
    seen = attempts.withColumn("outcome", attempt_class()).where(F.col("attempt") <= last_try)
    ended = F.col("outcome") != RETRYABLE
    what = F.struct(rank.alias("rank"), "status", "error_class", "outcome", "at_ms")
    ends = seen.groupBy(key).agg(
        F.min(F.when(ended, what)).alias("end"),
        F.max(what).alias("last"),
    )
    final = F.coalesce("end", "last")
    # Attempts recorded after the end do not belong to the request.
    used = F.coalesce(F.col("end.rank.attempt"), F.col("last.rank.attempt"))
    return ends.select(
        key,
        used.alias("attempts"),
        (used - 1).alias("retries"),
        final["status"].alias("status"),
        final["error_class"].alias("error_class"),
        F.when(final["outcome"] == RETRYABLE, "exhausted")
        .otherwise(final["outcome"])
        .alias("outcome"),
    )


def eof_replays(attempts: DataFrame, key: str = "request_id") -> DataFrame:
    """Per request: immediate replays after a stale connection; they are not retries."""
    replayed = F.col("kind") == "eof_replay"
    return attempts.groupBy(key).agg(
        F.count_if(replayed).alias("replays"),
        F.count_if(~replayed).alias("counted_attempts"),
    )


# Escapes of a quoted text.
ESCAPES = {'"': '\\"', "\\": "\\\\", "\a": "\\a", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\v": "\\v"}
PRINTED = r"[\p{L}\p{M}\p{N}\p{P}\p{S} ]"
# Whole UTF-8 characters and, failing that, single bytes, in text that has one character for each byte.
UTF8 = (
    r"[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    r"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"
    r"|\xf4[\x80-\x8f][\x80-\xbf]{2}|[\x80-\xff]"
)


# Fixed value: how a failure's message begins.
FAILED = "remote_write failed"


def quoted(data: Column) -> Column:
    """Bytes as quoted text: control and other unprinted characters and broken bytes are escaped."""
    parts = F.regexp_extract_all(F.decode(data, "iso-8859-1"), F.lit(UTF8), F.lit(0))

    def shown(part: Column) -> Column:
        raw = F.encode(part, "iso-8859-1")
        byte = F.concat(F.lit("\\x"), F.lower(F.lpad(F.hex(raw), 2, "0")))
        char = raw.cast("string")
        code = F.lower(F.hex(F.encode(char, "utf-32")))
        wide = F.when(code.startswith("0000"), F.concat(F.lit("\\u"), F.right(code, F.lit(4)))).otherwise(
            F.concat(F.lit("\\U"), code)
        )
        out = F.when((F.length(part) == 1) & ((part > "\x7e") | (part < " ")), byte)
        out = out.when(char.rlike(PRINTED), char).otherwise(wide)
        for plain, escape in ESCAPES.items():
            out = F.when(part == plain, F.lit(escape)).otherwise(out)
        return out

    return F.concat(F.lit('"'), F.array_join(F.transform(parts, shown), ""), F.lit('"'))


def failure_text(df: DataFrame) -> DataFrame:
    """Add ``message``, by which of status and error is present. The body is cut to its first 4 KiB."""
    start = F.substring("body", 1, ERROR_BODY_BYTES)
    body = quoted(F.coalesce(start, F.lit(b"")))
    prefix = F.lit(FAILED)
    has_error, has_status = F.col("error_text").isNotNull(), F.col("status_text").isNotNull()
    return df.withColumn(
        "message",
        F.when(
            has_error & has_status,
            F.concat(prefix, F.lit(": status="), "status_text", F.lit(" err="), "error_text"),
        )
        .when(has_error, F.concat(prefix, F.lit(": "), "error_text"))
        .when(
            has_status, F.concat(prefix, F.lit(": status="), "status_text", F.lit(" body="), body)
        )
        .otherwise(prefix),
    )
