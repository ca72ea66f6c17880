"""Table shapes, as DDL strings that ``spark.read.schema`` takes."""

LABELS = "array<struct<name:string,value:string>>"
SAMPLES = "array<struct<value:double,timestamp:bigint>>"
HISTOGRAM = (
    "struct<buckets:array<struct<upper_bound:double,cumulative_count:bigint>>,"
    "sample_sum:double,sample_count:bigint>"
)
SUMMARY = (
    "struct<quantiles:array<struct<quantile:double,value:double>>,"
    "sample_sum:double,sample_count:bigint>"
)
# One row per metric; the ordinals keep the order of families and of metrics inside a family.
FAMILY_METRICS = (
    "push_key string, family_ord bigint, metric_ord bigint, name string, type string, "
    f"labels {LABELS}, timestamp_ms bigint, value double, histogram {HISTOGRAM}, summary {SUMMARY}"
)
# One row per family with its metrics nested, the shape snapshots arrive in.
FAMILIES = (
    "push_key string, family_ord bigint, name string, type string, "
    f"metrics array<struct<labels:{LABELS},timestamp_ms:bigint,value:double,"
    f"histogram:{HISTOGRAM},summary:{SUMMARY}>>"
)
SERIES = f"push_key string, ord bigint, labels {LABELS}, samples {SAMPLES}"
REQUESTS = (
    "request_id bigint, queue string, tenant_id string, body binary, content_type string, "
    "content_encoding string, protocol_version string, headers map<string,array<string>>, "
    "arrival_ms bigint, size_bytes bigint"
)
ATTEMPTS = (
    "record_id bigint, queue string, attempt int, at_ms bigint, kind string, status int, "
    "error_class string, error_text string, retry_after string, body binary"
)
