"""One query per operator, over whole tables. The matching SQL is in ``workload.oracle``."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesship.config import VERSION_HEADER, ClientConfig, PushConfig, RetryPolicy
from seriesship.functions import labels as L
from seriesship.functions import wire
from seriesship.functions.text import format_bound
from seriesship.operators import batching, encode, outbox, outcome, rate, requests
from seriesship.operators.deliver import deliver
from seriesship.operators.flatten import flatten
from seriesship.operators.ordered import ensure_checkpoint_dir
from seriesship.operators.relabel import Rule, relabel
from seriesship.plans.push import push, push_batches, push_series
from seriesship.schema import ATTEMPTS, REQUESTS
from seriesship.sources.committed import register
from seriesship.sources.tables import (
    read_families,
    read_families_stream,
    read_requests,
    read_series,
    read_series_stream,
    recover_records,
)
from seriesship.streaming.intake import drain, stream_push, stream_push_series
from seriesship.streaming.timers import DUE, due_records, use_timers
from workload import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps it apart from what it calls."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def long_form(flat: DataFrame, *keys: str) -> DataFrame:
    return flat.select(
        *keys,
        L.render(F.col("labels")).alias("series"),
        "value",
        F.col("timestamp").alias("timestamp_ms"),
    )


# --- scans -------------------------------------------------------------------------------------------


def committed(spark: SparkSession, rows: DataFrame, fmt: str) -> str:
    """A new folder to which the rows are committed."""
    register(spark)
    path = scratch(spark, fmt)
    rows.write.format(fmt).mode("append").save(path)
    return path


def order_families(spark: SparkSession, sf: str) -> DataFrame:
    """One family per (push, customer); its orders are a bounded, ordered list."""
    metric = F.struct("labels", "timestamp_ms", "value", "histogram", "summary")
    rows = T.order_gauges(spark, sf).withColumn("chunk", F.expr("metric_ord div 1000"))
    families = rows.groupBy("push_key", "family_ord", "chunk", "name", "type").agg(
        F.array_sort(F.collect_list(F.struct("metric_ord", metric.alias("m")))).alias("ordered")
    )
    return families.select("push_key", "family_ord", "name", "type", F.col("ordered.m").alias("metrics"))


@query
def scan_metric_families(spark, sf):
    path = committed(spark, order_families(spark, sf), "metric_families")
    return read_families(spark, path, "metric_families").select(
        "push_key",
        "family_ord",
        "metric_ord",
        "name",
        "type",
        L.render(F.col("labels")).alias("series"),
        "timestamp_ms",
        "value",
    )


@query
def scan_series(spark, sf):
    path = committed(spark, T.event_series(spark, sf), "metric_series")
    return read_series(spark, path, "metric_series").select(
        "push_key",
        "ord",
        L.render(F.col("labels")).alias("series"),
        F.inline("samples").alias("value", "timestamp_ms"),
    )


@query
def scan_requests(spark, sf):
    columns = [c.split()[0] for c in REQUESTS.split(", ")]
    path = committed(spark, T.requests(spark, sf).select(*columns), "write_requests")
    return read_requests(spark, path, "write_requests").select(
        "request_id",
        "queue",
        "tenant_id",
        F.hex("body").alias("body_hex"),
        "content_type",
        F.to_json("headers").alias("headers_json"),
        "arrival_ms",
        "size_bytes",
    )


def record_files(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.when(key % 7 == 0, F.hex(key)).otherwise(F.lower(F.lpad(F.hex(key), 16, "0")))
    name = F.when(key % 10 == 4, F.concat(F.lit("ffffffff"), F.lpad(F.hex(key), 8, "0"))).otherwise(name)
    ending = (
        F.when(key % 10 == 1, ".tmp")
        .when(key % 10 == 2, ".record.tmp")
        .when(key % 10 == 3, "g.record")
        .otherwise(".record")
    )
    return T.table(spark, sf, "orders").select(
        F.concat(F.lit("/spool/records/"), name, ending).alias("path"),
        F.floor("o_totalprice").cast("bigint").alias("length"),
        (key % 50 == 0).alias("is_dir"),
    )


@query
def spool_recovery_scan(spark, sf):
    records, _ = recover_records(record_files(spark, sf))
    return records.select(F.col("record_id").cast("string").alias("record_id"), "path", "size_bytes")


@query
def spool_recovery_totals(spark, sf):
    _, stats = recover_records(record_files(spark, sf))
    return stats.select("records", F.col("max_id").cast("string").alias("max_id"), "total_bytes")


@query
def decode_payloads(spark, sf):
    series = T.event_series(spark, sf)
    batched = batching.assign_batches(series, order="ord", max_series=20, atomic="series")
    decoded = encode.decode_payloads(encode.encode_batches(batched, order="ord"))
    return decoded.select(
        "push_key",
        "batch_no",
        "series_ord",
        L.render(F.col("labels")).alias("series"),
        F.inline("samples").alias("value", "timestamp_ms"),
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the storage all executors share."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir()
    return posixpath.join(base, f"{name}-{uuid.uuid4().hex}")


def orders_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.table(spark, sf, "orders").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)


@query
def stream_scan(spark, sf):
    out, marks = scratch(spark, "scan"), scratch(spark, "marks")
    families = committed(spark, order_families(spark, sf), "metric_families")
    flat = flatten(read_families_stream(spark, families, "metric_families"), None, T.NOW_MS)
    run = (
        long_form(flat, "push_key")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", marks)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(out)


# --- flatten -----------------------------------------------------------------------------------------


@query
def flatten_counter(spark, sf):
    return long_form(flatten(T.counters(spark, sf), None, T.NOW_MS))


@query
def flatten_gauge(spark, sf):
    return long_form(flatten(T.gauges(spark, sf), None, T.NOW_MS), "push_key")


@query
def flatten_untyped(spark, sf):
    return long_form(flatten(T.untyped(spark, sf), None, T.NOW_MS))


@query
def flatten_histogram(spark, sf):
    return long_form(flatten(T.histograms(spark, sf), None, T.NOW_MS), "push_key", "point_ord")


@query
def histogram_inf_bucket(spark, sf):
    flat = flatten(T.histograms(spark, sf), None, T.NOW_MS)
    bound = L.label_value(F.col("labels"), "le")
    rows = flat.where(bound == "+Inf").groupBy("push_key", "family_ord")
    return rows.agg(F.count("*").alias("inf_buckets"), F.max("value").alias("inf_count"))


@query
def flatten_summary(spark, sf):
    return long_form(flatten(T.summaries(spark, sf), None, T.NOW_MS), "point_ord")


@query
def timestamp_default(spark, sf):
    flat = flatten(T.counters(spark, sf), None, T.NOW_MS)
    return flat.groupBy((F.col("timestamp") == T.NOW_MS).alias("defaulted")).agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms")
    )


@query
def format_bound_(spark, sf):
    price = F.col("o_totalprice")
    scaled = F.array(price, price / 1e9, price * 1e3, -price / 7.0, price * 1e20, price / 3e7)
    orders = T.table(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.posexplode(scaled).alias("form", "bound"))
    return rows.select("o_orderkey", "form", format_bound("bound").alias("bound_text"))


# --- labels ------------------------------------------------------------------------------------------


def raw_labels(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.array(
            L.pair("segment", F.col("c_mktsegment")),
            L.pair("dup", T.text(F.col("c_custkey") % 9)),
            L.pair("Zone", F.when(F.col("c_custkey") % 4 != 0, T.text("c_nationkey"))),
            L.pair("dup", F.lit("a")),
            L.pair("empty", F.lit("")),
        ).alias("raw"),
    )


@query
def build_labels(spark, sf):
    extra = F.array(L.pair("le", T.text("c_nationkey")))
    built = L.build_labels(F.lit("m"), extra, F.col("raw"))
    return raw_labels(spark, sf).select("c_custkey", L.render(built).alias("series"))


@query
def sort_labels(spark, sf):
    built = L.sort_labels(L.build_labels(F.lit("m"), None, F.col("raw")))
    return raw_labels(spark, sf).select("c_custkey", L.render(built).alias("series"))


EXTERNAL = {"env": "prod", "dup": "never", "Zone": "ext", "__name__": "never", "zz": "last"}


@query
def merge_external_labels(spark, sf):
    built = L.build_labels(F.lit("m"), None, F.col("raw"))
    merged = L.merge_external(built, L.literal_labels(EXTERNAL))
    return raw_labels(spark, sf).select("c_custkey", L.render(merged).alias("series"))


@query
def external_labels_by_tenant(spark, sf):
    nation, region = T.table(spark, sf, "nation"), T.table(spark, sf, "region")
    per_tenant = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("tenant"),
        L.external_from_map(
            F.create_map(
                F.lit("region"), "r_name", F.lit("country"), "n_name", F.lit("segment"), F.lit("never")
            )
        ).alias("ext"),
    )
    metrics = T.gauges(spark, sf)
    joined = metrics.join(per_tenant, metrics.push_key == per_tenant.tenant)
    return long_form(flatten(joined, F.col("ext"), T.NOW_MS), "push_key")


# --- relabel -----------------------------------------------------------------------------------------


def ruled(spark: SparkSession, sf: str, *rules: Rule) -> DataFrame:
    flat = flatten(T.counters(spark, sf), None, T.NOW_MS)
    return long_form(relabel(flat, rules))


@query
def relabel_keep(spark, sf):
    rule = Rule("keep", ("event", "user"), regex="(click|view);[0-9]*[02468]")
    return ruled(spark, sf, rule)


@query
def relabel_drop(spark, sf):
    return ruled(spark, sf, Rule("drop", ("zone",), regex="z[12]|"))


@query
def relabel_replace(spark, sf):
    return ruled(
        spark,
        sf,
        Rule(source_labels=("event",), regex="([a-z])(?P<rest>[a-z]*)", target_label="kind",
             replacement="${1}_${rest}$$$1x"),
        Rule(source_labels=("zone",), regex="z3", target_label="zone", replacement=""),
        Rule(source_labels=("user",), regex="([0-9])", target_label="digit_${1}", replacement="yes"),
    )


HASH_RULE = Rule("hashmod", ("user",), target_label="__tmp_hashmod", modulus=8)


@query
def relabel_hashmod(spark, sf):
    return ruled(spark, sf, HASH_RULE, Rule("keep", ("__tmp_hashmod",), regex="[0-5]"))


@query
def relabel_labelmap(spark, sf):
    return ruled(spark, sf, Rule("labelmap", regex="(user|event)", replacement="by_$1"))


@query
def relabel_labeldrop(spark, sf):
    return ruled(spark, sf, Rule("labeldrop", regex="zone|use.*"))


@query
def relabel_labelkeep(spark, sf):
    return ruled(spark, sf, Rule("labelkeep", regex="__name__|event|zone"))


@query
def relabel_lowercase(spark, sf):
    flat = flatten(T.gauges(spark, sf), None, T.NOW_MS)
    rule = Rule("lowercase", ("segment", "nation"), target_label="segment", separator="-")
    return long_form(relabel(flat, [rule]), "push_key")


@query
def relabel_uppercase(spark, sf):
    return ruled(spark, sf, Rule("uppercase", ("event",), target_label="EVENT"))


DIGITS = (
    Rule(source_labels=("user",), regex=".*([0-9])", target_label="digit"),
    Rule(source_labels=("zone",), regex="z([0-9])", target_label="zdigit"),
)


@query
def relabel_keepequal(spark, sf):
    return ruled(spark, sf, *DIGITS, Rule("keepequal", ("digit",), target_label="zdigit"))


@query
def relabel_dropequal(spark, sf):
    return ruled(spark, sf, *DIGITS, Rule("dropequal", ("digit",), target_label="zdigit"))


CHAIN = (
    Rule("drop", ("event",), regex="error"),
    Rule(source_labels=("event", "zone"), separator="/", regex="(.*)/(.*)", target_label="where",
         replacement="$2.$1"),
    HASH_RULE,
    Rule("drop", ("__tmp_hashmod",), regex="7"),
    Rule("labeldrop", regex="__tmp_.*|zone"),
)


@query
def relabel_chain(spark, sf):
    return ruled(spark, sf, *CHAIN)


@query
def relabel_all_dropped(spark, sf):
    return ruled(spark, sf, Rule("drop", ("__name__",), regex=".*"))


@query
def drop_empty_labels(spark, sf):
    customers = raw_labels(spark, sf).select(
        "c_custkey", L.sort_labels(L.build_labels(F.lit("m"), None, F.col("raw"))).alias("labels")
    )
    kept = relabel(customers, [Rule("keep", ("__name__",), regex="m")])
    return kept.select("c_custkey", L.render(F.col("labels")).alias("series"))


# --- sizes and batches -------------------------------------------------------------------------------


@query
def series_bytes_push(spark, sf):
    return T.document_series(spark, sf).select(
        "ord", batching.series_bytes(F.col("labels")).alias("est_bytes")
    )


@query
def series_bytes_prebuilt(spark, sf):
    return T.event_series(spark, sf).select(
        "push_key", "ord", batching.series_bytes(F.col("labels"), F.col("samples")).alias("est_bytes")
    )


FAMILY_LIMITS = {"max_series": 12, "max_bytes": 700}


def family_batches(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten(T.order_gauges(spark, sf), None, T.NOW_MS)
    return batching.assign_batches(flat, order="family_ord", **FAMILY_LIMITS)


@query
def batch_by_family(spark, sf):
    return family_batches(spark, sf).select("push_key", "family_ord", "metric_ord", "batch_no")


SERIES_LIMITS = {"max_series": 8, "max_bytes": 20_000}


def series_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.assign_batches(
        T.document_series(spark, sf), order="ord", atomic="series", **SERIES_LIMITS
    )


@query
def batch_by_series(spark, sf):
    return series_batches(spark, sf).select("push_key", "ord", "batch_no")


@query
def batch_by_count(spark, sf):
    numbered = batching.batch_numbers_by_count(T.event_series(spark, sf), "push_key", ["ord"], 7)
    return numbered.select("push_key", "ord", "batch_no")


@query
def batch_profile(spark, sf):
    return batching.batch_stats(series_batches(spark, sf), order="ord")


# --- encode and sinks --------------------------------------------------------------------------------


@query
def encode_batches(spark, sf):
    encoded = encode.encode_batches(series_batches(spark, sf), order="ord")
    return encoded.select(
        "push_key", "batch_no", "n_series", "raw_bytes", "content_type", "content_encoding",
        "protocol_version",
    )


BUDGET = 20_000_000


@query
def outbox_append(spark, sf):
    box = outbox.Outbox(spark, scratch(spark, "outbox"))
    for _ in range(2):  # a repeated epoch changes nothing
        box.append(T.requests(spark, sf), 0, BUDGET)
    request = F.split(F.col("body").cast("string"), "/")[1].cast("bigint").alias("request_id")
    kept = box.records().select("queue", request, "record_id", F.lit(None).cast("string").alias("reason"))
    none = F.lit(None).cast("bigint").alias("record_id")
    return kept.union(box.rejected().select("queue", request, none, "reason"))


def fake_transport(url: str, headers: dict, body: bytes) -> dict:
    """Answers by the body's text, so that results do not depend on the run."""
    number = int(body.decode().rsplit("/", 1)[1])
    if number % 101 == 0:
        return {"error_class": "timeout", "error_text": "timeout"}
    if number % 97 == 0:
        return {"status": 503, "retry_after": "7"}
    if number % 13 == 0:
        return {"status": 400, "body": b"bad"}
    return {"status": 204}


@query
def http_deliver(spark, sf):
    line = T.requests(spark, sf).withColumn("record_id", F.col("request_id"))
    cfg = ClientConfig("http://host:8428/{tenant}/write", tenant_header="X-Tenant")
    sent = deliver(line, cfg, fake_transport, T.NOW_MS, concurrency=2)
    return sent.select("queue", "record_id", "attempt", "status", "error_class", "retry_after")


PUSH = PushConfig(
    external_labels={"env": "prod", "status": "never"},
    rules=(
        Rule("drop", ("status",), regex="P"),
        Rule(source_labels=("__name__",), regex="order_total_(.*)", target_label="customer"),
    ),
    now_ms=T.NOW_MS,
    max_series=10,
    max_bytes=900,
)


@query
def push_to_batches(spark, sf):
    return push(T.order_gauges(spark, sf), PUSH).select(
        "push_key", "batch_no", "n_series", "raw_bytes"
    )


@query
def push_series_to_batches(spark, sf):
    cfg = PushConfig(max_series=8, max_bytes=3000)
    return push_series(T.event_series(spark, sf), cfg).select(
        "push_key", "batch_no", "n_series", "raw_bytes"
    )


@query
def stream_push_(spark, sf):
    box = outbox.Outbox(spark, scratch(spark, "outbox"))
    metrics = T.order_gauges_of(orders_stream(spark, sf))
    run = (
        stream_push(metrics, box, PUSH)
        .option("checkpointLocation", scratch(spark, "marks"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    decoded = encode.decode_payloads(box.records())
    return decoded.groupBy("queue", "record_id").agg(F.count("*").alias("n_series"))


def pushed_events(spark: SparkSession, sf: str) -> outbox.Outbox:
    """An outbox filled from a stream of ready-made series."""
    box = outbox.Outbox(spark, scratch(spark, "outbox"))
    series = read_series_stream(spark, committed(spark, T.event_series(spark, sf), "metric_series"), "metric_series")
    run = stream_push_series(series, box, PushConfig(max_series=8, max_bytes=3000))
    run = run.option("checkpointLocation", scratch(spark, "marks")).trigger(availableNow=True).start()
    run.awaitTermination()
    return box


@query
def stream_push_series_(spark, sf):
    decoded = encode.decode_payloads(pushed_events(spark, sf).records())
    return decoded.groupBy("queue", "record_id").agg(F.count("*").alias("n_series"))


def answer_by_size(url: str, headers: dict, body: bytes) -> dict:
    """Answers by the number of samples in a body."""
    n = sum(len(samples) for _, samples in wire.decode_body(body))
    return {"status": 503, "retry_after": "9"} if n % 10 == 9 else {"status": 400 if n % 7 == 3 else 204}


@query
def drain_pass(spark, sf):
    """One drain of the outbox: what left each queue, and what waits until when."""
    box = pushed_events(spark, sf)
    drain(box, CLIENT, answer_by_size, 0, 1_000)
    left = box.finished().select("queue", "record_id", F.col("why").alias("state"), F.lit(0).cast("bigint").alias("due_ms"))
    waits = box.waiting().select("queue", "record_id", F.lit("waits").alias("state"), F.col("next_due_ms").alias("due_ms"))
    return left.unionByName(waits)


# --- requests ----------------------------------------------------------------------------------------

CLIENT = ClientConfig(
    upstream_url="http://host:8428/insert/{tenant}/write",
    tenant_header="X-Scope-OrgID",
    bearer_token="secret",
    user_agent="shipper",
    default_content_type="application/x-protobuf",
    default_content_encoding="snappy",
    retry=RetryPolicy(max_retries=3, max_body=1000),
)


@query
def request_defaults(spark, sf):
    return requests.with_defaults(T.requests(spark, sf), CLIENT).select(
        "request_id", "content_type", "content_encoding", "protocol_version"
    )


def hostile(spark: SparkSession, sf: str) -> DataFrame:
    pages = T.table(spark, sf, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("tenant_id")
    )
    talk = T.table(spark, sf, "conversations").select(
        F.lit("turn").alias("kind"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("text").alias("tenant_id"),
    )
    return pages.unionByName(talk)


@query
def route_tenant_url(spark, sf):
    return requests.route(hostile(spark, sf), CLIENT.upstream_url).select("kind", "id", "url")


@query
def route_by_table(spark, sf):
    routes = T.table(spark, sf, "nation").select(
        T.text("n_nationkey").alias("queue"),
        F.concat(F.lit("https://"), F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))),
                 F.lit(".example.com/{tenant}/push")).alias("url"),
    )
    customers = T.table(spark, sf, "customer").select(
        "c_custkey", T.text("c_nationkey").alias("queue"), F.col("c_name").alias("tenant_id")
    )
    return requests.route(customers, routes).select("c_custkey", "url")


def candidate_urls(spark: SparkSession, sf: str) -> DataFrame:
    bare = F.regexp_replace("url", "^[a-z]+://", "")
    host, path = F.regexp_extract(bare, "^[^/]*", 0), F.regexp_extract(bare, "^[^/]*([^?#]*)", 1)
    slot = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    case = F.col("page_id") % 10
    url = (
        F.when(case == 0, "")
        .when(case == 1, bare)
        .when(case == 2, slot("http://", host, "/{tenant}", path))
        .when(case == 3, slot("http://{tenant}.", host, path))
        .when(case == 4, slot("http://", host, path, "?t={tenant}"))
        .when(case == 5, slot("http://", host, "/{tenant}/{tenant}"))
        .when(case == 6, path)
        .when(case == 7, slot("http://", path))
        .when(case == 8, slot("http://", host, "/{tenant}?t={tenant}"))
        .otherwise(F.col("url"))
    )
    return T.table(spark, sf, "pages").select("page_id", url.alias("url"))


@query
def validate_routes(spark, sf):
    ok, rejects = requests.validate_routes(candidate_urls(spark, sf))
    good = ok.select("page_id", F.lit(True).alias("ok"), F.lit("").alias("reason"))
    return good.unionByName(rejects.select("page_id", F.lit(False).alias("ok"), "reason"))


def render_headers(headers: Column) -> Column:
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))),
        ";",
    )


@query
def tenant_header(spark, sf):
    line = T.requests(spark, sf).withColumn(
        "tenant_id", F.when(F.col("request_id") % 6 != 0, F.col("tenant_id")).otherwise("")
    )
    ready = requests.request_headers(requests.with_defaults(line, CLIENT), CLIENT)
    return ready.select("request_id", render_headers(F.col("send_headers")).alias("headers"))


@query
def reject_reserved_headers(spark, sf):
    names = ["content-TYPE", "X-Fine", "AUTHORIZATION", "x-scope-orgid", "user-agent", "Accept"]
    names.append(VERSION_HEADER.swapcase())
    picked = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("request_id") % 7 + 1).cast("int"))
    line = T.requests(spark, sf).withColumn(
        "headers", F.create_map(picked, F.array("queue"), F.lit("x-more"), F.array("queue"))
    )
    ok, bad = requests.split_reserved(line, CLIENT)
    good = ok.select("request_id", F.lit(True).alias("allowed"))
    return good.unionByName(bad.select("request_id", F.lit(False).alias("allowed")))


def spelled_headers(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda *c: F.array(*c)
    return T.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.create_map(
            F.lit("z-last"), one("role", "text"),
            F.concat(F.lit("x-"), "role"), one("text"),
            F.concat(F.lit("X-"), F.upper("role")), one(F.lit("up"), T.text("turn")),
            F.lit("A b"), one(F.lit("spaced")),
            F.lit("x-none"), F.array().cast("array<string>"),
        ).alias("headers"),
    )


@query
def canonical_headers(spark, sf):
    done = requests.canonical_headers(spelled_headers(spark, sf))
    return done.select("id", render_headers(F.col("headers")).alias("headers"))


@query
def body_mode(spark, sf):
    key = F.col("request_id")
    line = T.requests(spark, sf).select(
        "request_id",
        F.when(key % 3 == 0, F.col("body")).alias("body"),
        (key % 4 == 0).alias("replayable"),
        (key % 5 < 3).alias("stream"),
        F.when(key % 7 == 0, 0).otherwise(F.col("size_bytes")).cast("bigint").alias("content_length"),
    )
    return requests.body_mode(line).select("request_id", "mode", "length")


@query
def body_too_large(spark, sf):
    docs = T.table(spark, sf, "documents").select(
        "doc_id",
        F.lit(None).cast("binary").alias("body"),
        (F.col("doc_id") % 5 == 0).alias("replayable"),
        F.lit(True).alias("stream"),
        F.when(F.col("doc_id") % 2 == 0, F.octet_length("text")).otherwise(0).alias("content_length"),
        F.octet_length("text").alias("stream_bytes"),
    )
    ok, bad = requests.split_too_large(requests.body_mode(docs), CLIENT)
    good = ok.select("doc_id", F.lit(False).alias("too_large"))
    return good.unionByName(bad.select("doc_id", F.lit(True).alias("too_large")))


@query
def record_size(spark, sf):
    docs = T.table(spark, sf, "documents").select(
        "doc_id",
        F.col("source").alias("tenant_id"),
        F.lit("application/x-protobuf").alias("content_type"),
        F.when(F.col("doc_id") % 2 == 0, "snappy").alias("content_encoding"),
        F.lit("0.1.0").alias("protocol_version"),
        F.encode("text", "utf-8").alias("body"),
        F.create_map(F.lit("x-lang"), F.array("lang", "source"), F.lit("x-none"),
                     F.array().cast("array<string>")).alias("headers"),
    )
    return requests.record_size(docs).select("doc_id", "size_bytes")


# --- outcomes ----------------------------------------------------------------------------------------

RETRY = RetryPolicy(max_retries=2, min_wait_ms=1000, max_wait_ms=5000)


@query
def classify_status(spark, sf):
    rows = T.table(spark, sf, "lineitem").select((F.col("l_partkey") % 700 + 100).alias("status"))
    counted = rows.groupBy("status").agg(F.count("*").alias("n"))
    return counted.select("status", "n", outcome.classify_status(F.col("status")).alias("outcome"))


@query
def classify_error(spark, sf):
    return outcome.classify(T.attempts(spark, sf)).select("event_id", "outcome")


@query
def parse_retry_after(spark, sf):
    wait = outcome.retry_after_ms(F.col("retry_after"), F.col("at_ms"))
    return T.attempts(spark, sf).select("event_id", wait.alias("retry_after_ms"))


@query
def backoff_schedule(spark, sf):
    suppliers = T.table(spark, sf, "supplier").select("s_suppkey")
    return outcome.backoff_schedule(suppliers, RetryPolicy(6, 1500, 20_000))


@query
def retry_wait(spark, sf):
    wait = outcome.wait_ms(F.col("attempt"), F.col("retry_after"), F.col("at_ms"), RETRY)
    return T.attempts(spark, sf).select("event_id", "attempt", wait.alias("wait_ms"))


@query
def jitter(spark, sf):
    base = (F.floor("o_totalprice") + 1).cast("bigint")
    rows = T.table(spark, sf, "orders").select(
        "o_orderkey", base.alias("wait"), outcome.with_jitter(base, 7).alias("jittered")
    )
    room = F.least(F.col("wait") / 10, F.lit(10000.0))
    inside = (F.col("jittered") >= F.col("wait")) & (F.col("jittered") < F.col("wait") + room)
    return rows.select("o_orderkey", inside.alias("inside"))


@query
def retry_outcome(spark, sf):
    return outcome.sync_outcome(T.attempts(spark, sf), RETRY)


@query
def eof_replay(spark, sf):
    return outcome.eof_replays(T.attempts(spark, sf))


@query
def failure_message(spark, sf):
    case = F.col("doc_id") % 4
    docs = T.table(spark, sf, "documents").select(
        "doc_id",
        F.when(case.isin(0, 1), F.concat(F.lit("refused: "), "source")).alias("error_text"),
        F.when(case.isin(0, 2), F.lit("503 Service Unavailable")).alias("status_text"),
        F.encode("text", "utf-8").alias("body"),
    )
    message = F.hex(F.col("message").cast("binary"))
    return outcome.failure_text(docs).select("doc_id", F.md5(message.cast("binary")).alias("message_md5"))


# --- outbox ------------------------------------------------------------------------------------------


@query
def budget_admission(spark, sf):
    return outbox.admit(T.requests(spark, sf), "queue", ["arrival_ms", "request_id"], BUDGET).select(
        "queue", "request_id", "accepted", "accept_no"
    )


@query
def fifo_drain_slice(spark, sf):
    key = F.col("request_id")
    line = T.requests(spark, sf).select(
        key.alias("record_id"),
        "queue",
        F.when(key % 89 == 13, T.NOW_MS + 1).otherwise(key).cast("bigint").alias("next_due_ms"),
    )
    return outbox.drain_slice(line, T.NOW_MS, 3).select("queue", "record_id")


@query
def drain_outcome(spark, sf):
    left = outbox.apply_outcomes(T.outbox(spark, sf), T.attempts(spark, sf), RETRY)
    return left.select("record_id", "queue", "next_due_ms")


@query
def retry_timers(spark, sf):
    """Records that come up to be sent again, from the ledger as a stream."""
    ledger, out = scratch(spark, "ledger"), scratch(spark, "due")
    columns = [c.split()[0] for c in ATTEMPTS.split(", ")]
    T.attempts(spark, sf).select(*columns).write.parquet(ledger)
    used = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_timers(spark)
    try:
        due = due_records(spark.readStream.schema(ATTEMPTS).parquet(ledger), RETRY)
        run = due.writeStream.option("checkpointLocation", scratch(spark, "marks")).trigger(availableNow=True)
        run.start(out, format="parquet").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", used)
    return spark.read.schema(DUE).parquet(out)


@query
def quarantine_corrupt(spark, sf):
    encoded = encode.encode_batches(series_batches(spark, sf), order="ord")
    body = (
        F.when(F.col("batch_no") % 4 == 1, F.encode(F.lit("not a request"), "utf-8"))
        .when(F.col("batch_no") % 4 == 2, F.substring("body", 1, 3))
        .otherwise(F.col("body"))
    )
    ok, bad = encode.split_corrupt(encoded.select("push_key", "batch_no", body.alias("body")))
    good = ok.select("push_key", "batch_no", F.lit("kept").alias("state"))
    return good.unionByName(bad.select("push_key", "batch_no", F.lit("corrupt").alias("state")))


@query
def next_due_at(spark, sf):
    return outcome.with_due(T.attempts(spark, sf), RETRY).select("event_id", "next_due_ms")


@query
def pending_bytes(spark, sf):
    return outbox.pending(T.outbox(spark, sf))


@query
def spool_counters(spark, sf):
    records = T.outbox(spark, sf)
    return outbox.counters(records, T.attempts(spark, sf), records.where("state = 'corrupt'"))


@query
def spool_gauges(spark, sf):
    return outbox.gauges(T.outbox(spark, sf), 1_000_000).select(
        "queue", "pending_bytes", "inflight", "blocked"
    )


@query
def recovery_reseed(spark, sf):
    return outbox.recover(T.outbox(spark, sf)).select("record_id", "queue", "state", "next_due_ms")


# --- rate limits -------------------------------------------------------------------------------------

LIMIT = 120_000


@query
def token_bucket_schedule(spark, sf):
    timed = rate.rate_schedule(T.requests(spark, sf), "queue", LIMIT)
    return timed.select("queue", "request_id", "admit_ms", "wait_ms")


@query
def rate_limit_bypass(spark, sf):
    key = F.col("request_id")
    sized = T.requests(spark, sf).withColumn(
        "size_bytes",
        F.when(key % 10 == 0, 0).when(key % 10 != 3, F.col("size_bytes")).cast("bigint"),
    )
    timed = rate.rate_schedule(sized, "queue", LIMIT)
    return timed.groupBy("queue").agg(
        F.count("*").alias("n"), F.count_if(F.col("wait_ms") == 0).alias("at_once"),
        F.max("admit_ms").alias("last_ms"),
    )


@query
def deadline_cut(spark, sf):
    patience = F.element_at(
        F.array(F.lit(500), F.lit(2500), F.lit(30_000)), (F.col("request_id") % 3 + 1).cast("int")
    )
    line = T.requests(spark, sf).withColumn("deadline_ms", F.col("arrival_ms") + patience)
    return rate.with_deadline(line, "queue", LIMIT).select("queue", "request_id", "admit_ms")


@query
def push_profile(spark, sf):
    return batching.batch_stats(push_batches(T.order_gauges(spark, sf), PUSH))
