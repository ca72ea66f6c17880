"""The delivery sink: send one request per record through a transport the caller passes in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesship.config import ClientConfig
from seriesship.operators.requests import request_headers, route, with_defaults
from seriesship.schema import ATTEMPTS

# A transport takes (url, headers, body) and returns a dict with any of status, error_class, error_text,
# retry_after and body. It runs in tasks.
Transport = Callable[[str, dict[str, list[str]], bytes], dict]

OUTCOME_FIELDS = ("status", "error_class", "error_text", "retry_after", "body")


def prepare(records: DataFrame, cfg: ClientConfig) -> DataFrame:
    """Add target URL and full headers."""
    return request_headers(route(with_defaults(records, cfg), cfg.upstream_url), cfg)


def _final(got: dict) -> bool:
    """Whether an answer lets the queue move on."""
    if got.get("stop"):
        return False
    status, error = got.get("status"), got.get("error_class")
    text = got.get("error_text") or ""
    if error:
        broken = any(t in text for t in ("x509:", "certificate", "tls:", "TLS handshake"))
        return broken and error not in ("cancelled", "deadline", "client_timeout", "timeout")
    return not (status == 429 or 500 <= (status or 0) < 600)


def deliver(
    records: DataFrame,
    cfg: ClientConfig,
    transport: Transport,
    now_ms: int,
    concurrency: int = 1,
    key: str = "queue",
) -> DataFrame:
    """Send due records in id order and return one attempt row per send.

    Order is kept per queue: once ``concurrency`` records of a queue have failed for now, later ones are not
    tried. Rows stream through the task, so a long queue costs time but no memory.
    """
    ready = prepare(records, cfg).withColumn("entries", F.map_entries("send_headers"))
    tries = F.col("tries") if "tries" in ready.columns else F.lit(0)
    placed = (
        ready.select("record_id", key, tries.alias("tries"), "url", "entries", "body")
        .repartition(key)
        .sortWithinPartitions(key, "record_id")
    )

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue, failed = None, 0
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if getattr(r, key) != queue:
                    queue, failed = getattr(r, key), 0
                if failed >= concurrency:
                    continue
                headers = {e["key"]: list(e["value"]) for e in r.entries}
                try:
                    got = transport(r.url, headers, r.body)
                except Exception as e:  # noqa: BLE001 - whatever a transport raises is an attempt's error
                    got = {"error_class": "other", "error_text": str(e)}
                failed += not _final(got)
                row = {"record_id": r.record_id, "queue": queue, "attempt": r.tries + 1}
                row |= {"at_ms": now_ms, "kind": "send"}
                out.append(row | {f: got.get(f) for f in OUTCOME_FIELDS})
            frame = pd.DataFrame(out, columns=[*_COLUMNS])
            yield frame.astype({"status": "Int32"})

    return placed.mapInPandas(send, ATTEMPTS)


_COLUMNS = [c.split()[0] for c in ATTEMPTS.split(", ")]
