"""Metric, series, request and attempt tables derived from the driver's tables.

Groups are bounded or combine before the shuffle, and ordinals come from ids, so nothing here sorts or
collects a whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesship.functions.labels import pair
from seriesship.schema import HISTOGRAM, LABELS, SUMMARY

NOW_MS = 1_700_000_000_000
BLOCK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(c: str | Column) -> Column:
    """Milliseconds of a zone-less timestamp, read as UTC."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_millis(c.cast("timestamp"))


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _labels(*pairs: Column) -> Column:
    return F.array(*pairs).cast(LABELS)


def _metric(df: DataFrame, **given: Column) -> DataFrame:
    """Complete a metric table with the columns that are not given."""
    empty = {
        "push_key": F.lit("p").cast("string"),
        "family_ord": F.lit(0),
        "metric_ord": F.lit(0),
        "timestamp_ms": F.lit(None),
        "value": F.lit(None),
        "histogram": F.lit(None),
        "summary": F.lit(None),
    }
    types = {
        "push_key": "string",
        "family_ord": "bigint",
        "metric_ord": "bigint",
        "name": "string",
        "type": "string",
        "labels": LABELS,
        "timestamp_ms": "bigint",
        "value": "double",
        "histogram": HISTOGRAM,
        "summary": SUMMARY,
    }
    cols = {**empty, **given}
    return df.select(*[cols[c].cast(t).alias(c) for c, t in types.items()])


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and user. Some values, timestamps and label values are missing."""
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", "user_id")
        .agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    )
    user = F.col("user_id")
    return _metric(
        grouped,
        metric_ord=user,
        name=F.lit("events_total"),
        type=F.lit("COUNTER"),
        labels=_labels(
            pair("user", text("user_id")),
            pair("event", F.col("event_type")),
            pair("zone", F.when(user % 5 != 0, F.concat(F.lit("z"), text(user % 5)))),
        ),
        timestamp_ms=F.when(user % 2 == 0, millis("last")),
        value=F.when(user % 7 != 0, F.col("n")),
    )


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return _metric(
        customer,
        push_key=text("c_nationkey"),
        metric_ord=F.col("c_custkey"),
        name=F.lit("customer_acctbal"),
        type=F.lit("GAUGE"),
        labels=_labels(
            pair("segment", F.col("c_mktsegment")),
            pair("customer", text("c_custkey")),
            pair("nation", text("c_nationkey")),
        ),
        value=F.col("c_acctbal"),
    )


def untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").groupBy("p_brand", "p_type")
    return _metric(
        part.agg(F.max("p_retailprice").alias("price"), F.max("p_size").alias("size")),
        name=F.lit("part_price"),
        type=F.lit("UNTYPED"),
        labels=_labels(pair("type", F.col("p_type")), pair("brand", F.col("p_brand"))),
        timestamp_ms=F.col("size") * 1000,
        value=F.col("price"),
    )


BOUNDS = (1.0, 2.5, 10.0, 25.0, 50.0)


def _bucket(bound: float, count: Column) -> Column:
    return F.struct(F.lit(bound).alias("upper_bound"), count.alias("cumulative_count"))


def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities per supplier and return flag; even suppliers carry an explicit +Inf bucket."""
    quantity = F.col("l_quantity")
    grouped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(
            *[F.count_if(quantity <= b).alias(f"le{i}") for i, b in enumerate(BOUNDS)],
            F.sum(quantity).alias("total"),
            F.count("*").alias("n"),
            F.max("l_shipdate").alias("last"),
        )
    )
    finite = F.array(*[_bucket(b, F.col(f"le{i}")) for i, b in enumerate(BOUNDS)])
    closed = F.concat(finite, F.array(_bucket(float("inf"), F.col("n"))))
    return _metric(
        grouped,
        push_key=F.col("l_returnflag"),
        family_ord=F.col("l_suppkey"),
        name=F.lit("quantity"),
        type=F.lit("HISTOGRAM"),
        labels=_labels(
            pair("supplier", text("l_suppkey")), pair("flag", F.col("l_returnflag"))
        ),
        timestamp_ms=millis("last"),
        histogram=F.struct(
            F.when(F.col("l_suppkey") % 2 == 0, closed).otherwise(finite).alias("buckets"),
            F.col("total").alias("sample_sum"),
            F.col("n").alias("sample_count"),
        ),
    )


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest and highest value per event type and user, as the quantiles 0 and 1."""
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", "user_id")
        .agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
            F.count("*").alias("n"),
        )
    )
    quantile = lambda q, c: F.struct(
        F.lit(q).alias("quantile"), F.col(c).alias("value")
    )
    return _metric(
        grouped,
        metric_ord=F.col("user_id"),
        name=F.lit("event_value"),
        type=F.lit("SUMMARY"),
        labels=_labels(pair("user", text("user_id")), pair("event", F.col("event_type"))),
        summary=F.struct(
            F.array(quantile(0.0, "low"), quantile(1.0, "high")).alias("quantiles"),
            F.col("total").alias("sample_sum"),
            F.col("n").alias("sample_count"),
        ),
    )


def order_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One push per priority, one family per customer, one metric per order."""
    return order_gauges_of(table(spark, sf_dir, "orders"))


def order_gauges_of(orders: DataFrame) -> DataFrame:
    return _metric(
        orders,
        push_key=F.col("o_orderpriority"),
        family_ord=F.col("o_custkey"),
        metric_ord=F.col("o_orderkey"),
        name=F.concat(F.lit("order_total_"), text("o_custkey")),
        type=F.lit("GAUGE"),
        labels=_labels(
            pair("status", F.col("o_orderstatus")), pair("order", text("o_orderkey"))
        ),
        timestamp_ms=millis("o_orderdate"),
        value=F.col("o_totalprice"),
    )


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-made series: samples of a user inside a block of 256 events."""
    block = F.expr(f"event_id div {BLOCK}")
    sample = F.struct(F.col("ts"), F.col("event_id"), F.col("value"))
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", block.alias("block"))
        .agg(F.array_sort(F.collect_list(sample)).alias("s"))
    )
    return grouped.select(
        F.concat(F.lit("p"), text(F.col("user_id") % 16)).alias("push_key"),
        (F.col("block") * 1_000_000_000 + F.col("user_id")).alias("ord"),
        _labels(
            pair("__name__", F.lit("user_events")),
            pair("block", text("block")),
            pair("user", text("user_id")),
        ).alias("labels"),
        F.transform(
            "s", lambda x: F.struct(x["value"].alias("value"), millis(x["ts"]).alias("timestamp"))
        ).alias("samples"),
    )


def document_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series whose labels carry whole texts with multi-byte characters."""
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("push_key"),
        F.col("doc_id").alias("ord"),
        _labels(
            pair("__name__", F.lit("document")),
            pair("source", F.col("source")),
            pair("text", F.col("text")),
        ).alias("labels"),
        F.array(
            F.struct(
                F.col("n_chars").cast("double").alias("value"), F.col("doc_id").alias("timestamp")
            )
        ).alias("samples"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order, in lines of twenty tenants."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.concat(F.lit("tenant-"), text(cust % 20)).alias("queue"),
        F.concat(F.lit("tenant-"), text(cust % 20)).alias("tenant_id"),
        F.encode(F.concat("o_orderpriority", F.lit("/"), text("o_orderkey")), "utf-8").alias("body"),
        F.when(key % 3 == 0, "text/plain").when(key % 3 == 1, "").alias("content_type"),
        F.when(key % 4 == 0, "gzip").alias("content_encoding"),
        F.when(key % 5 == 0, "9.9").otherwise("").alias("protocol_version"),
        F.create_map(
            F.lit("x-priority"),
            F.array("o_orderpriority"),
            F.lit("x-none"),
            F.array().cast("array<string>"),
        ).alias("headers"),
        (key * 100).alias("arrival_ms"),
        F.floor("o_totalprice").cast("bigint").alias("size_bytes"),
        "o_orderkey",
        "o_orderstatus",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four attempts per request; every third request starts with a stale connection and its replay."""
    event, user = F.col("event_id"), F.col("user_id")
    request = F.expr("event_id div 4")
    slot = event % 4
    replayed = request % 3 == 0
    case = user % 11
    k = F.get_json_object("props", "$.k").cast("int")
    stale = replayed & (slot == 0)
    error_class = (
        F.when(stale, "eof")
        .when(case == 0, "cancelled")
        .when(case == 1, "deadline")
        .when(case == 2, "client_timeout")
        .when(case == 3, "timeout")
        .when(case.isin(4, 5, 6), "other")
    )
    error_text = (
        F.when(stale, "EOF")
        .when(case == 0, "context canceled")
        .when(case == 4, "x509: unknown authority")
        .when(case == 5, "remote error: tls: bad record")
        .when(case.isin(1, 2, 3, 6), "no answer")
    )
    status = (
        F.when(F.col("event_type") == "click", 200)
        .when(F.col("event_type") == "view", 204)
        .when(F.col("event_type") == "error", 503)
        .when(F.col("event_type") == "signup", 429)
        .otherwise(400)
    )
    date = F.date_format(
        (F.col("ts") + F.make_dt_interval(secs=k)).cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss"
    )
    header = (
        F.when(k % 4 == 0, text(k - 8))
        .when(k % 4 == 1, "not-a-number")
        .when(k % 4 == 2, F.concat(date, F.lit(" GMT")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        request.alias("request_id"),
        record_of(request).alias("record_id"),
        F.concat(F.lit("q"), text(request % 8)).alias("queue"),
        (F.when(replayed & (slot > 0), slot).otherwise(slot + 1)).cast("int").alias("attempt"),
        millis("ts").alias("at_ms"),
        F.when(replayed & (slot == 1), "eof_replay").otherwise("send").alias("kind"),
        F.when(error_class.isNull(), status).alias("status"),
        error_class.alias("error_class"),
        error_text.alias("error_text"),
        header.alias("retry_after"),
        F.encode("event_type", "utf-8").alias("body"),
    )


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per request of ``attempts``, as large as its four events together."""
    size = F.sum(F.round(F.col("value") * 100).cast("bigint")) + 20
    requests = table(spark, sf_dir, "events").groupBy(F.expr("event_id div 4").alias("request")).agg(size.alias("size_bytes"))
    request = F.col("request")
    case = request % 9
    return requests.select(
        record_of(request).alias("record_id"),
        F.concat(F.lit("q"), text(request % 8)).alias("queue"),
        "size_bytes",
        F.when(case == 0, "sending").when(case == 1, "corrupt").otherwise("pending").alias("state"),
        F.when(case == 2, NOW_MS + 1).otherwise(request).cast("bigint").alias("next_due_ms"),
    )


def record_of(request: Column) -> Column:
    """The record of a request in one of eight queues; each queue counts its own."""
    return F.floor(request / 8).cast("bigint")
