"""Whole pushes: from metrics or series to encoded requests and, with a transport, to attempts."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.config import ClientConfig, PushConfig
from seriesship.operators.batching import assign_batches
from seriesship.operators.deliver import Transport, deliver
from seriesship.operators.encode import encode_batches
from seriesship.operators.flatten import flatten
from seriesship.operators.relabel import check_rules, relabel
from seriesship.operators.requests import reserved_names

FAMILY_ORDER = ["family_ord", "metric_ord", "point_ord"]


def started(cfg: PushConfig) -> PushConfig:
    """The push with its clock read, once, if it has none given: points and deliveries share one time."""
    return cfg if cfg.now_ms is not None else replace(cfg, now_ms=time.time_ns() // 1_000_000)


def push_series_rows(metrics: DataFrame, cfg: PushConfig) -> DataFrame:
    """Flattened and relabelled series. Rules are checked before anything is read."""
    check_rules(cfg.rules, cfg.name_scheme)
    return relabel(flatten(metrics, cfg.external_labels, cfg.now_ms), cfg.rules, cfg.name_scheme)


def push_batches(metrics: DataFrame, cfg: PushConfig) -> DataFrame:
    """Series of a push with their batch numbers; families stay whole."""
    series = push_series_rows(metrics, cfg)
    return assign_batches(
        series, order="family_ord", max_series=cfg.max_series, max_bytes=cfg.max_bytes
    )


def addressed(encoded: DataFrame, cfg: PushConfig | None = None, queue: str = "push_key") -> list[Column]:
    """Columns of a request or record that a push gives: its queue, tenant, body and headers."""
    cfg = cfg or PushConfig()
    pairs = [x for name, values in cfg.headers.items() for x in (F.lit(name), F.array(*map(F.lit, values)))]
    headers = F.create_map(*pairs) if pairs else F.lit(None)
    return [
        F.col(queue).alias("queue"),
        (F.col(queue) if cfg.tenant is None else F.lit(cfg.tenant)).alias("tenant_id"),
        *map(F.col, ("body", "content_type", "content_encoding", "protocol_version")),
        headers.cast("map<string,array<string>>").alias("headers"),
    ]


def as_records(encoded: DataFrame, cfg: PushConfig | None = None, queue: str = "push_key") -> DataFrame:
    """Encoded batches as records of one queue per push, numbered in batch order."""
    return encoded.select((F.col("batch_no") + 1).alias("record_id"), *addressed(encoded, cfg, queue), F.lit(0).alias("tries"))


def check_headers(cfg: PushConfig, client: ClientConfig) -> None:
    """A push must not set a header that the client sets itself. Nothing is read before."""
    bad = sorted(n for n in cfg.headers if n.lower() in reserved_names(client))
    if bad:
        raise ValueError(f"reserved headers: {', '.join(bad)}")


def _send(encoded: DataFrame, cfg: PushConfig, client: ClientConfig, transport: Transport) -> DataFrame:
    # A push stops at its first failed batch; earlier ones stay sent.
    return deliver(as_records(encoded, cfg), client, stop_at_failure(transport), cfg.now_ms)


def stop_at_failure(transport: Transport) -> Transport:
    """Answers of any failing kind hold the queue, as a push gives up on every error."""

    def call(url, headers, body):
        got = transport(url, headers, body)
        status = got.get("status")
        ok = not got.get("error_class") and status is not None and 200 <= status < 300
        return got if ok else {**got, "stop": True}

    return call


def push(
    metrics: DataFrame,
    cfg: PushConfig,
    client: ClientConfig | None = None,
    transport: Transport | None = None,
) -> DataFrame:
    """Encoded requests of a push; with a transport, the attempts of delivering them."""
    cfg, client = started(cfg), client or ClientConfig()
    check_headers(cfg, client)
    encoded = encode_batches(push_batches(metrics, cfg), order=FAMILY_ORDER)
    if transport is None:
        return encoded
    return _send(encoded, cfg, client, transport)


def push_series(
    series: DataFrame,
    cfg: PushConfig,
    client: ClientConfig | None = None,
    transport: Transport | None = None,
) -> DataFrame:
    """The same for ready-made series: no label merge, no rules, a check after every series."""
    cfg, client = started(cfg), client or ClientConfig()
    check_headers(cfg, client)
    batched = assign_batches(
        series, order="ord", max_series=cfg.max_series, max_bytes=cfg.max_bytes, atomic="series"
    )
    encoded = encode_batches(batched, order="ord")
    if transport is None:
        return encoded
    return _send(encoded, cfg, client, transport)
