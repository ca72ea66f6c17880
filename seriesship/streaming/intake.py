"""Continuous intake: snapshots into an outbox, and drains of the outbox."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from seriesship.config import ClientConfig, PushConfig, RetryPolicy
from seriesship.operators.encode import with_body_error
from seriesship.operators.deliver import Transport, deliver
from seriesship.operators.outbox import DRAINS, FORBIDDEN, Outbox, digest, drain_slice
from seriesship.operators.requests import canonical_headers, record_size, split_reserved, with_defaults
from seriesship.plans.push import addressed, check_headers, push, push_series


def to_requests(encoded: DataFrame, cfg: PushConfig | None = None, queue: str = "push_key") -> DataFrame:
    """Encoded batches as requests of one queue per push, in batch order."""
    arrival = F.lit(0).cast("bigint").alias("arrival_ms")
    return encoded.select(F.col("batch_no").alias("request_id"), *addressed(encoded, cfg, queue), arrival)


def enqueue(
    outbox: Outbox,
    requests: DataFrame,
    epoch_id: int,
    client: ClientConfig,
    max_pending_bytes: int = 0,
    writer: str = "main",
    given: tuple[int, str] | None = None,
) -> None:
    """Requests into the outbox. Those with forbidden headers, like those that don't fit, go to its rejected table.

    ``given`` is the digest of what the requests were made from, if that is what a repeated epoch is told by.
    """
    # Admission looks at sizes first and takes the bodies later, and both kinds are written, so they are made once.
    held = requests.persist()
    allowed, forbidden = split_reserved(held, client)
    sized = record_size(canonical_headers(with_defaults(allowed, client)))
    refused = record_size(forbidden).withColumn("reason", F.lit(FORBIDDEN))
    outbox.append(sized, epoch_id, max_pending_bytes, writer=writer, refused=refused, given=given)
    held.unpersist()


def stream_push(
    metrics: DataFrame,
    outbox: Outbox,
    cfg: PushConfig,
    client: ClientConfig | None = None,
    max_pending_bytes: int = 0,
    writer: str = "main",
) -> DataStreamWriter:
    """A writer that pushes every micro-batch of metrics into the outbox.

    The batch plan runs on each micro-batch, so a hot queue is split as in batch work; the state between
    micro-batches is the outbox itself. Start it with a checkpoint location, and give every stream into an outbox,
    also one that starts anew without its old checkpoint, a ``writer`` name of its own. A micro-batch that comes
    again after a crash is known by its metrics, whatever the clock says by then.
    """
    return _stream_into(metrics, push, outbox, cfg, client, max_pending_bytes, writer)


def stream_push_series(
    series: DataFrame,
    outbox: Outbox,
    cfg: PushConfig,
    client: ClientConfig | None = None,
    max_pending_bytes: int = 0,
    writer: str = "main",
) -> DataStreamWriter:
    """The same for a stream of ready-made series."""
    return _stream_into(series, push_series, outbox, cfg, client, max_pending_bytes, writer)


def _stream_into(
    rows: DataFrame,
    plan: Callable[[DataFrame, PushConfig], DataFrame],
    outbox: Outbox,
    cfg: PushConfig,
    client: ClientConfig | None,
    max_pending_bytes: int,
    writer: str,
) -> DataStreamWriter:
    client = client or ClientConfig()
    check_headers(cfg, client)

    def one(batch: DataFrame, epoch_id: int) -> None:
        requests = to_requests(plan(batch, cfg), cfg)
        enqueue(outbox, requests, epoch_id, client, max_pending_bytes, writer, digest(batch))

    return rows.writeStream.foreachBatch(one)


def drain(
    outbox: Outbox,
    client: ClientConfig,
    transport: Transport,
    epoch_id: int,
    now_ms: int,
    concurrency: int = 1,
    writer: str = DRAINS,
) -> None:
    """One drain pass: pick what is due, quarantine corrupt records, send, write down the outcome.

    Picking sees ids and due times only; bodies are read for what was picked. Drains that run side by side, or
    count their epochs anew, need a ``writer`` name each.
    """
    due = drain_slice(outbox.waiting(without=(writer, epoch_id)), now_ms, concurrency)
    checked = with_body_error(outbox.whole(due)).persist()
    good = checked.where("error is null").drop("error")
    attempts = deliver(good, client, transport, now_ms, concurrency)
    corrupt = checked.where("error is not null")
    outbox.settle(attempts, epoch_id, client.retry or RetryPolicy(), corrupt, now_ms, writer)
    checked.unpersist()
