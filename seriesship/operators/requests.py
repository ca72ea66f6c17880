"""Preparing requests: defaults, target URL, headers, body checks and spool size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.config import VERSION_HEADER, ClientConfig
from seriesship.functions.text import framed_len, header_name, let, path_escape, varint_len

SLOT = "{tenant}"
HEADERS = "map<string,array<string>>"
# Headers that only the client itself sets.
PROTOCOL_HEADERS = ("Content-Encoding", "Content-Type", "User-Agent", VERSION_HEADER)


def _filled(c: Column, default: str) -> Column:
    return F.coalesce(
        F.nullif(c, F.lit("")), F.lit(default) if default else F.lit(None).cast("string")
    )


def with_defaults(df: DataFrame, cfg: ClientConfig) -> DataFrame:
    """Content type, encoding and version: the request's own, else the default, else null."""
    return df.withColumns(
        {
            "content_type": _filled(F.col("content_type"), cfg.default_content_type),
            "content_encoding": _filled(F.col("content_encoding"), cfg.default_content_encoding),
            "protocol_version": _filled(F.col("protocol_version"), cfg.default_version),
        }
    )


def url_problem(url: Column) -> Column:
    """Why an upstream URL is unusable, or null.

    Authority is what follows ``//``; the path ends at the first ``?`` or ``#``.
    """
    form = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
    slots = lambda c: F.regexp_count(c, F.lit(r"\{tenant\}"))
    parts = F.struct(
        url.alias("url"),
        F.regexp_extract(url, form, 1).alias("scheme"),
        F.regexp_replace(F.regexp_extract(url, form, 2), r"^.*@", "").alias("host"),
        F.regexp_extract(url, form, 3).alias("path"),
        slots(url).alias("slots"),
        slots(F.regexp_extract(url, form, 3)).alias("path_slots"),
    )

    def judge(p: Column) -> Column:
        return (
            F.when(F.coalesce(p["url"], F.lit("")) == "", "empty")
            .when(p["url"].rlike(r"[\x00-\x1f\x7f]"), "control character")
            .when((p["scheme"] == "") | (p["host"] == ""), "no scheme or host")
            .when(p["host"].rlike(r"\s|:[^\]:]*[^\]:0-9][^\]:]*$"), "bad host or port")
            .when(F.concat(p["host"], p["path"]).rlike(r"%(?![0-9A-Fa-f]{2})"), "bad escape")
            .when((p["slots"] > 0) & (p["path_slots"] != 1), "tenant slot not once in path")
            .when(p["slots"] > p["path_slots"], "tenant slot outside path")
        )

    return let(parts, judge)


#: Why a request whose queue no route names is refused.
NO_ROUTE = "no route"


def validate_routes(df: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """Usable routes, and the others with a ``reason``."""
    checked = df.withColumn("reason", url_problem(F.col(url)))
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")


def route_url(template: Column, tenant: Column) -> Column:
    """Put the escaped tenant into the slot; without a slot the URL is constant."""
    return F.replace(template, F.lit(SLOT), path_escape(F.coalesce(tenant, F.lit(""))))


def route(df: DataFrame, template: str | DataFrame, key: str = "queue") -> DataFrame:
    """Add ``url`` from one template, or from a table of templates by key.

    Every row stays: one whose key has no template, or is null, has a null ``url``. :func:`split_routed` parts them.
    """
    if isinstance(template, str):
        return df.withColumn("url", route_url(F.lit(template), F.col("tenant_id")))
    # Spark broadcasts the routes if their size allows and joins by shuffle otherwise.
    joined = df.join(template.withColumnRenamed("url", "template"), key, "left")
    return joined.withColumn("url", route_url(F.col("template"), F.col("tenant_id"))).drop("template")


def split_routed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with a ``url``, and the others without that column but with a ``reason``."""
    lost = df.where("url is null").drop("url").withColumn("reason", F.lit(NO_ROUTE))
    return df.where("url is not null"), lost


def reserved_names(cfg: ClientConfig) -> list[str]:
    """Lower-case names of the headers the client sets itself."""
    names = list(PROTOCOL_HEADERS)
    if cfg.bearer_token:
        names.append("Authorization")
    if cfg.tenant_header:
        names.append(cfg.tenant_header)
    return [n.lower() for n in names]


def reserved_header(headers: Column, cfg: ClientConfig) -> Column:
    """Whether any header is one the client sets itself, in any spelling."""
    lowered = reserved_names(cfg)
    return F.coalesce(
        F.exists(F.map_keys(headers), lambda k: F.lower(k).isin(lowered)), F.lit(False)
    )


def split_reserved(df: DataFrame, cfg: ClientConfig) -> tuple[DataFrame, DataFrame]:
    """Requests whose extra headers are allowed, and the others. Runs before a request is queued."""
    bad = reserved_header(F.col("headers"), cfg)
    return df.where(~bad), df.where(bad)


def _one_value(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), F.array(value).alias("value"))


def request_headers(df: DataFrame, cfg: ClientConfig) -> DataFrame:
    """Add ``send_headers``, the full header map of a request whose extras passed ``split_reserved``."""
    optional = {
        "Content-Type": F.col("content_type"),
        "Content-Encoding": F.col("content_encoding"),
        VERSION_HEADER: F.col("protocol_version"),
    }
    if cfg.tenant_header:
        optional[cfg.tenant_header] = F.nullif(F.col("tenant_id"), F.lit(""))
    if cfg.bearer_token:
        optional["Authorization"] = F.lit("Bearer " + cfg.bearer_token)
    own = F.array(
        _one_value("User-Agent", F.lit(cfg.user_agent)),
        *[_one_value(k, v) for k, v in optional.items()],
    )
    own = F.filter(own, lambda e: F.get(e["value"], F.lit(0)).isNotNull())
    extra = F.filter(F.map_entries("headers"), lambda e: F.size(e["value"]) > 0)
    entries = F.concat(own, F.coalesce(extra, F.array().cast(_entries())))
    return df.withColumn("send_headers", F.map_from_entries(entries))


def _entries() -> str:
    return "array<struct<key:string,value:array<string>>>"


def header_list(headers: Column) -> Column:
    """Canonical header entries: (key, values) in order of (canonical, raw) spelling.

    Keys without values are dropped; values of keys that differ in spelling only are joined. A header map
    belongs to one request and is small, so this stays inside the row.
    """
    raw = F.filter(F.map_entries(headers), lambda e: F.size(e["value"]) > 0)
    keyed = F.sort_array(
        F.transform(
            raw,
            lambda e: F.struct(
                header_name(e["key"]).alias("key"), e["key"].alias("raw"), e["value"].alias("values")
            ),
        )
    )
    joined = F.aggregate(
        keyed,
        F.array().cast("array<struct<key:string,values:array<string>>>"),
        lambda acc, e: F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["key"] == e["key"]),
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        e["key"].alias("key"),
                        F.concat(F.get(acc, F.size(acc) - 1)["values"], e["values"]).alias("values"),
                    )
                ),
            ),
        ).otherwise(
            F.concat(acc, F.array(F.struct(e["key"].alias("key"), e["values"].alias("values"))))
        ),
    )
    return F.coalesce(joined, F.array().cast("array<struct<key:string,values:array<string>>>"))


def canonical_headers(df: DataFrame) -> DataFrame:
    """Replace ``headers`` by the canonical, merged map."""
    entries = F.transform(
        header_list(F.col("headers")),
        lambda e: F.struct(e["key"].alias("key"), e["values"].alias("value")),
    )
    return df.withColumn("headers", F.map_from_entries(entries))


def body_mode(df: DataFrame) -> DataFrame:
    """How the body is sent, by precedence, and its length (-1: unknown).

    Input: ``body``, ``replayable`` and ``stream`` flags and the declared ``content_length``.
    """
    size = F.octet_length("body")
    has_bytes = F.coalesce(size > 0, F.lit(False))
    mode = (
        F.when(has_bytes, "bytes")
        .when(F.col("replayable"), "replayable")
        .when(F.col("stream"), "stream")
        .otherwise("none")
    )
    length = (
        F.when(has_bytes, size)
        .when((mode == "stream") & (F.col("content_length") == 0), -1)
        .otherwise(F.col("content_length"))
    )
    return df.withColumns({"mode": mode, "length": length.cast("bigint")})


def too_large(cfg: ClientConfig) -> Column:
    """Stream bodies over the buffer limit; only retries need the buffer."""
    if cfg.retry is None:
        return F.lit(False)
    limit = cfg.retry.for_requests().max_body
    if limit < 0:
        return F.lit(False)
    real = F.coalesce(F.col("stream_bytes"), F.lit(0))
    return (F.col("mode") == "stream") & ((F.col("length") > limit) | (real > limit))


def split_too_large(df: DataFrame, cfg: ClientConfig) -> tuple[DataFrame, DataFrame]:
    """Requests that can be buffered, and the others. Needs ``body_mode`` and ``stream_bytes``."""
    bad = too_large(cfg)
    return df.where(~bad), df.where(bad)


def record_bytes() -> Column:
    """Framed size of a record: all fields, the canonical headers and the body."""
    entries = header_list(F.col("headers"))
    header_bytes = F.aggregate(
        entries,
        varint_len(F.size(entries).cast("bigint")).cast("bigint"),
        lambda a, e: a
        + framed_len(e["key"])
        + varint_len(F.size(e["values"]).cast("bigint"))
        + F.aggregate(e["values"], F.lit(0).cast("bigint"), lambda b, v: b + framed_len(v)),
    )
    fixed = [framed_len(F.col(c)) for c in (
        "tenant_id", "content_type", "content_encoding", "protocol_version", "body"
    )]
    total = F.lit(5).cast("bigint")
    for c in fixed:
        total = total + c
    return total + header_bytes


def record_size(df: DataFrame) -> DataFrame:
    """Add ``size_bytes``, what the record takes in the spool."""
    return df.withColumn("size_bytes", record_bytes())


