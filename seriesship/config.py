"""Job settings. They live on the driver and enter plans as literals."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed protocol values.
CONTENT_TYPE = "application/x-protobuf"
CONTENT_ENCODING = "snappy"
PROTOCOL_VERSION = "0.1.0"
# Receivers require this header by its name.
VERSION_HEADER = "X-Prometheus-Remote-Write-Version"
ERROR_BODY_BYTES = 4096
DEFAULT_MAX_SERIES = 10000
DEFAULT_MAX_BYTES = 3 * 1024 * 1024
DEFAULT_MAX_BODY = 10 * 1024 * 1024
DEFAULT_MIN_WAIT_MS = 1000
DEFAULT_MAX_WAIT_MS = 30000


@dataclass(frozen=True)
class RetryPolicy:
    """Retry settings; zero stands for "use the default"."""

    max_retries: int = 1
    min_wait_ms: int = 0
    max_wait_ms: int = 0
    max_body: int = 0

    def for_requests(self) -> RetryPolicy:
        """Settings for synchronous retries. A minimum above the maximum is kept as it is."""
        return RetryPolicy(
            max(self.max_retries, 1),
            self.min_wait_ms or DEFAULT_MIN_WAIT_MS,
            self.max_wait_ms or DEFAULT_MAX_WAIT_MS,
            self.max_body or DEFAULT_MAX_BODY,
        )

    def for_outbox(self) -> RetryPolicy:
        """Settings for outbox drains, where the maximum wait is never below the minimum."""
        low = self.min_wait_ms if self.min_wait_ms > 0 else DEFAULT_MIN_WAIT_MS
        high = self.max_wait_ms if self.max_wait_ms > 0 else DEFAULT_MAX_WAIT_MS
        return replace(self, min_wait_ms=low, max_wait_ms=max(low, high))


@dataclass(frozen=True)
class ClientConfig:
    """Where and how requests are delivered."""

    upstream_url: str = ""
    tenant_header: str = ""
    bearer_token: str = ""
    user_agent: str = "seriesship"
    default_content_type: str = ""
    default_content_encoding: str = ""
    default_version: str = ""
    retry: RetryPolicy | None = None
    rate_limit_bytes_per_sec: int = 0


@dataclass(frozen=True)
class PushConfig:
    """One push: external labels, ordered relabel rules, the push clock and batch limits.

    ``tenant`` is whom the requests are for (the push key, if null), ``headers`` are sent along with each of them.
    """

    external_labels: dict[str, str] = field(default_factory=dict)
    rules: tuple = ()
    name_scheme: str = "legacy"
    now_ms: int | None = None
    max_series: int = 0
    max_bytes: int = 0
    tenant: str | None = None
    headers: dict[str, tuple[str, ...]] = field(default_factory=dict)
