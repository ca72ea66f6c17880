"""SQL for DuckDB that gives the same rows as each query, from the tables alone.

Sequential recurrences are recursive common table expressions that step all keys side by side. Queries
without an entry here are covered by tests against brute force.
"""

from __future__ import annotations

from seriesship.config import VERSION_HEADER
from seriesship.operators.outcome import FAILED

NOW = 1_700_000_000_000
ORACLE: dict[str, str] = {}


def vlen(x: str) -> str:
    steps = " ".join(f"WHEN {x} < {1 << (7 * i)} THEN {i}" for i in range(1, 9))
    return f"(CASE {steps} ELSE 9 END)"


def framed(x: str) -> str:
    """Bytes of a length prefix and its content."""
    return f"({vlen(x)} + {x})"


# --- shared tables -----------------------------------------------------------------------------------

COUNTERS = f"""
counters AS (
  SELECT event_type AS event, user_id AS u, user_id::VARCHAR AS usr, count(*)::DOUBLE AS value,
         CASE WHEN user_id % 5 <> 0 THEN 'z' || (user_id % 5) END AS zone,
         CASE WHEN user_id % 2 = 0 THEN (epoch_us(max(ts)) // 1000) ELSE {NOW} END AS timestamp_ms
  FROM events WHERE user_id % 7 <> 0 GROUP BY event_type, user_id)"""


def counter_series(series: str, where: str = "true", more: str = "") -> str:
    return f"""WITH {COUNTERS}{more}
SELECT {series} AS series, value, timestamp_ms FROM counters WHERE {where}"""


NAME = "'__name__=events_total'"
EVENT, USER = "'|event=' || event", "'|user=' || usr"
ZONE = "coalesce('|zone=' || zone, '')"
PLAIN = f"{NAME} || {EVENT} || {USER} || {ZONE}"
HASH = "(concat('0x', substr(md5(usr), 17, 16))::UBIGINT % 8)::VARCHAR"

REQUESTS = """
line AS (
  SELECT o_orderkey AS request_id, 'tenant-' || (o_custkey % 20) AS queue, o_orderkey * 100 AS arrival_ms,
         floor(o_totalprice)::BIGINT AS size_bytes, o_orderpriority || '/' || o_orderkey AS body,
         o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN 'text/plain' WHEN o_orderkey % 3 = 1 THEN '' END
           AS content_type
  FROM orders)"""

ATTEMPTS = """
raw AS (
  SELECT *, event_id // 4 AS rid, event_id % 4 AS slot, user_id % 11 AS c,
         regexp_extract(props, '[0-9]+')::INTEGER AS k
  FROM events),
typed AS (
  SELECT *, rid % 3 = 0 AND slot = 0 AS stale,
    CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 204 WHEN 'error' THEN 503
      WHEN 'signup' THEN 429 ELSE 400 END AS code
  FROM raw),
att AS (
  SELECT event_id, rid AS request_id, 'q' || (rid % 8) AS queue, (epoch_us(ts) // 1000) AS at_ms,
    CASE WHEN rid % 3 = 0 AND slot > 0 THEN slot ELSE slot + 1 END AS attempt,
    rid % 3 = 0 AND slot = 1 AS replay,
    CASE WHEN stale THEN 'eof' WHEN c = 0 THEN 'cancelled' WHEN c = 1 THEN 'deadline'
      WHEN c = 2 THEN 'client_timeout' WHEN c = 3 THEN 'timeout' WHEN c IN (4, 5, 6) THEN 'other' END
      AS error_class,
    CASE WHEN stale OR c < 7 THEN NULL ELSE code END AS status,
    CASE WHEN stale THEN 'retryable' WHEN c IN (0, 1, 4, 5) THEN 'permanent'
      WHEN c IN (2, 3, 6) THEN 'retryable' WHEN code IN (200, 204) THEN 'success'
      WHEN code IN (503, 429) THEN 'retryable' ELSE 'permanent' END AS outcome,
    CASE WHEN k % 4 = 0 THEN greatest(k - 8, 0) * 1000
      WHEN k % 4 = 2 THEN greatest(
        (epoch_us(date_trunc('second', ts + k * INTERVAL 1 SECOND)) // 1000) - (epoch_us(ts) // 1000), 0)
      ELSE 0 END::BIGINT AS retry_after_ms
  FROM typed),
waits AS (
  SELECT *, CASE WHEN retry_after_ms > 0 THEN retry_after_ms
      ELSE least(1000 * power(2, attempt - 1), 5000)::BIGINT END AS wait_ms
  FROM att)"""

OUTBOX = f"""
box AS (
  SELECT rid // 8 AS record_id, 'q' || (rid % 8) AS queue, size_bytes,
    CASE rid % 9 WHEN 0 THEN 'sending' WHEN 1 THEN 'corrupt' ELSE 'pending' END AS state,
    CASE WHEN rid % 9 = 2 THEN {NOW + 1} ELSE rid END::BIGINT AS next_due_ms
  FROM (SELECT event_id // 4 AS rid, (sum(round(value * 100)::BIGINT) + 20)::BIGINT AS size_bytes
        FROM events GROUP BY 1))"""

EVENT_SERIES = """
es AS (
  SELECT 'p' || (user_id % 16) AS push_key, event_id // 256 * 1000000000 + user_id AS ord,
    (event_id // 256)::VARCHAR AS block, user_id::VARCHAR AS usr, count(*) AS n,
    sum(CASE WHEN value = 0 THEN 0 ELSE 9 END + 1 + """ + vlen("(epoch_us(ts) // 1000)") + """ + 2) AS sample_wire
  FROM events GROUP BY user_id, event_id // 256),
es_sized AS (
  SELECT *, 16 + (8 + 11 + 2) + (5 + strlen(block) + 2) + (4 + strlen(usr) + 2) + 16 * n AS b FROM es)"""

DOC_SERIES = """
ds AS (
  SELECT lang AS push_key, doc_id AS ord,
    16 + (8 + 8 + 2) + (6 + strlen(source) + 2) + (4 + strlen(text) + 2) AS label_bytes,
    strlen(source) AS ls, strlen(text) AS lt, n_chars
  FROM documents),
ds_sized AS (SELECT *, label_bytes + 16 AS b FROM ds)"""

ORDER_SERIES = """
os AS (
  SELECT o_orderpriority AS push_key, o_custkey AS family_ord, o_orderkey AS metric_ord, o_totalprice,
    o_orderstatus, (epoch_us(o_orderdate) // 1000) AS ts, strlen(o_custkey::VARCHAR) AS lc,
    strlen(o_orderkey::VARCHAR) AS lo
  FROM orders)"""


def greedy(units: str, max_n: int, max_b: int) -> str:
    """Batches of ``units`` (push_key, ord, n, b) as the table ``numbered``."""
    full = f"(s.cn >= {max_n} OR s.cb >= {max_b})"
    return f"""
g AS (SELECT *, row_number() OVER (PARTITION BY push_key ORDER BY ord) AS i FROM {units}),
numbered AS (
  SELECT push_key, i, ord, n::BIGINT AS cn, b::BIGINT AS cb, 0::BIGINT AS batch_no FROM g WHERE i = 1
  UNION ALL
  SELECT g.push_key, g.i, g.ord, CASE WHEN {full} THEN g.n ELSE s.cn + g.n END,
    CASE WHEN {full} THEN g.b ELSE s.cb + g.b END,
    s.batch_no + CASE WHEN {full} THEN 1 ELSE 0 END
  FROM numbered s JOIN g ON g.push_key = s.push_key AND g.i = s.i + 1)"""


# --- scans -------------------------------------------------------------------------------------------

ORDER_LABELS = "'|order=' || o_orderkey || '|status=' || o_orderstatus"

ORACLE["scan_metric_families"] = """
SELECT o_orderpriority AS push_key, o_custkey AS family_ord,
  row_number() OVER (PARTITION BY o_orderpriority, o_custkey, o_orderkey // 1000 ORDER BY o_orderkey) - 1
    AS metric_ord,
  'order_total_' || o_custkey AS name, 'GAUGE' AS type,
  'status=' || o_orderstatus || '|order=' || o_orderkey AS series,
  (epoch_us(o_orderdate) // 1000) AS timestamp_ms, o_totalprice AS value
FROM orders"""

ORACLE["scan_series"] = """
SELECT 'p' || (user_id % 16) AS push_key, event_id // 256 * 1000000000 + user_id AS ord,
  '__name__=user_events|block=' || (event_id // 256) || '|user=' || user_id AS series,
  value, (epoch_us(ts) // 1000) AS timestamp_ms
FROM events"""

ORACLE["scan_requests"] = f"""WITH {REQUESTS}
SELECT request_id, queue, queue AS tenant_id, hex(encode(body)) AS body_hex, content_type,
  '{{"x-priority":["' || o_orderpriority || '"],"x-none":[]}}' AS headers_json, arrival_ms, size_bytes
FROM line"""

FILES = """
files AS (
  SELECT o_orderkey AS k, floor(o_totalprice)::BIGINT AS size_bytes,
    CASE WHEN o_orderkey % 10 = 4 THEN 'ffffffff' || lpad(hex(o_orderkey), 8, '0')
      WHEN o_orderkey % 7 = 0 THEN CASE WHEN o_orderkey = 0 THEN '0' ELSE ltrim(hex(o_orderkey), '0') END
      ELSE lower(lpad(hex(o_orderkey), 16, '0')) END AS name,
    CASE WHEN o_orderkey % 10 = 4 THEN 18446744069414584320 + o_orderkey ELSE o_orderkey END::HUGEINT AS id
  FROM orders
  WHERE o_orderkey % 10 NOT IN (1, 2, 3) AND o_orderkey % 50 <> 0)"""

ORACLE["spool_recovery_scan"] = f"""WITH {FILES}
SELECT id::VARCHAR AS record_id, '/spool/records/' || name || '.record' AS path, size_bytes FROM files"""

ORACLE["spool_recovery_totals"] = f"""WITH {FILES}
SELECT count(*) AS records, max(id)::VARCHAR AS max_id, sum(size_bytes)::BIGINT AS total_bytes FROM files"""

ORACLE["decode_payloads"] = f"""WITH RECURSIVE {EVENT_SERIES},
units AS (SELECT push_key, ord, 1 AS n, b FROM es_sized), {greedy("units", 20, 3 << 20)},
placed AS (
  SELECT push_key, ord, batch_no,
    row_number() OVER (PARTITION BY push_key, batch_no ORDER BY ord) - 1 AS series_ord FROM numbered)
SELECT p.push_key, p.batch_no, p.series_ord,
  '__name__=user_events|block=' || (event_id // 256) || '|user=' || user_id AS series,
  value, (epoch_us(ts) // 1000) AS timestamp_ms
FROM events JOIN placed p
  ON p.push_key = 'p' || (user_id % 16) AND p.ord = event_id // 256 * 1000000000 + user_id"""

ORACLE["stream_scan"] = f"""
SELECT o_orderpriority AS push_key, '__name__=order_total_' || o_custkey || {ORDER_LABELS} AS series,
  o_totalprice AS value, (epoch_us(o_orderdate) // 1000) AS timestamp_ms
FROM orders"""

# --- flatten -----------------------------------------------------------------------------------------

ORACLE["flatten_counter"] = counter_series(PLAIN)

GAUGE = "'__name__=customer_acctbal|customer=' || c_custkey || '|nation=' || c_nationkey || '|segment='"
ORACLE["flatten_gauge"] = f"""
SELECT c_nationkey::VARCHAR AS push_key, {GAUGE} || c_mktsegment AS series, c_acctbal AS value,
  {NOW} AS timestamp_ms
FROM customer"""

ORACLE["flatten_untyped"] = """
SELECT '__name__=part_price|brand=' || p_brand || '|type=' || p_type AS series,
  max(p_retailprice) AS value, max(p_size)::BIGINT * 1000 AS timestamp_ms
FROM part GROUP BY p_brand, p_type"""

HIST = """
h AS (
  SELECT l_returnflag AS flag, l_suppkey AS sup, count(*) AS n, sum(l_quantity) AS total,
    (epoch_us(max(l_shipdate)) // 1000) AS ts,
    count(*) FILTER (l_quantity <= 1) AS c0, count(*) FILTER (l_quantity <= 2.5) AS c1,
    count(*) FILTER (l_quantity <= 10) AS c2, count(*) FILTER (l_quantity <= 25) AS c3,
    count(*) FILTER (l_quantity <= 50) AS c4
  FROM lineitem GROUP BY ALL)"""
HIST_POINTS = [("bucket", le, f"c{i}") for i, le in enumerate(("1", "2.5", "10", "25", "50"))]
HIST_POINTS += [("bucket", "+Inf", "n"), ("sum", None, "total"), ("count", None, "n")]
ORACLE["flatten_histogram"] = f"WITH {HIST}\n" + "\nUNION ALL\n".join(
    f"SELECT flag AS push_key, {i}::INTEGER AS point_ord, '__name__=quantity_{suffix}|flag=' || flag || "
    f"'{'|le=' + le if le else ''}|supplier=' || sup AS series, {c}::DOUBLE AS value, ts AS timestamp_ms "
    "FROM h"
    for i, (suffix, le, c) in enumerate(HIST_POINTS)
)

ORACLE["histogram_inf_bucket"] = """
SELECT l_returnflag AS push_key, l_suppkey AS family_ord, 1::BIGINT AS inf_buckets,
  count(*)::DOUBLE AS inf_count
FROM lineitem GROUP BY ALL"""

SUMMARY_POINTS = [("", "0", "low"), ("", "1", "high"), ("_sum", None, "total"), ("_count", None, "n")]
ORACLE["flatten_summary"] = """WITH s AS (
  SELECT event_type, user_id, min(value) AS low, max(value) AS high, count(*) AS n,
    sum(value::DECIMAL(18,2))::DOUBLE AS total
  FROM events GROUP BY ALL)
""" + "\nUNION ALL\n".join(
    f"SELECT {i}::INTEGER AS point_ord, '__name__=event_value{suffix}|event=' || event_type || "
    f"'{'|quantile=' + q if q else ''}|user=' || user_id AS series, {c}::DOUBLE AS value, "
    f"{NOW} AS timestamp_ms FROM s"
    for i, (suffix, q, c) in enumerate(SUMMARY_POINTS)
)

ORACLE["timestamp_default"] = f"""WITH {COUNTERS}
SELECT timestamp_ms = {NOW} AS defaulted, count(*) AS n, min(timestamp_ms) AS first_ms,
  max(timestamp_ms) AS last_ms
FROM counters GROUP BY 1"""

SCALED = ("o_totalprice", "o_totalprice / 1e9", "o_totalprice * 1e3", "-o_totalprice / 7.0::DOUBLE",
          "o_totalprice * 1e20", "o_totalprice / 3e7")
ORACLE["format_bound"] = "WITH b AS (\n" + "\nUNION ALL\n".join(
    f"SELECT o_orderkey, {i}::INTEGER AS form, ({c})::DOUBLE AS x FROM orders" for i, c in enumerate(SCALED)
) + r"""),
t AS (
  SELECT o_orderkey, form, CASE WHEN x < 0 THEN '-' ELSE '' END AS sign, abs(x)::VARCHAR AS s FROM b),
p AS (
  SELECT *, regexp_extract(s, '^([0-9]+)', 1) AS i, regexp_extract(s, '\.([0-9]+)', 1) AS f,
    CASE WHEN contains(s, 'e') THEN split_part(s, 'e', 2)::INTEGER ELSE 0 END AS e
  FROM t),
d AS (
  SELECT *, rtrim(ltrim(i || f, '0'), '0') AS digits,
    CASE WHEN i <> '0' THEN length(i) - 1 + e ELSE e - 1 - (length(f) - length(ltrim(f, '0'))) END AS x10
  FROM p)
SELECT o_orderkey, form, sign || CASE
  WHEN x10 < -4 OR x10 >= 6 THEN substr(digits, 1, 1)
    || CASE WHEN length(digits) > 1 THEN '.' || substr(digits, 2) ELSE '' END
    || CASE WHEN x10 < 0 THEN 'e-' ELSE 'e+' END || lpad(abs(x10)::VARCHAR, 2, '0')
  WHEN x10 < 0 THEN '0.' || repeat('0', (-x10 - 1)::INTEGER) || digits
  WHEN length(digits) <= x10 + 1 THEN rpad(digits, (x10 + 1)::INTEGER, '0')
  ELSE substr(digits, 1, x10 + 1) || '.' || substr(digits, x10 + 2) END AS bound_text
FROM d"""

# --- labels ------------------------------------------------------------------------------------------

DUP = "(c_custkey % 9)::VARCHAR"
ZONED = "c_custkey % 4 <> 0"
ORACLE["build_labels"] = f"""
SELECT c_custkey, '__name__=m|le=' || c_nationkey || '|segment=' || c_mktsegment || '|dup=' || {DUP}
  || CASE WHEN {ZONED} THEN '|Zone=' || c_nationkey ELSE '' END || '|dup=a|empty=' AS series
FROM customer"""

ORACLE["sort_labels"] = f"""
SELECT c_custkey, CASE WHEN {ZONED} THEN 'Zone=' || c_nationkey || '|' ELSE '' END
  || '__name__=m|dup=' || {DUP} || '|dup=a|empty=|segment=' || c_mktsegment AS series
FROM customer"""

ORACLE["merge_external_labels"] = f"""
SELECT c_custkey, 'Zone=' || CASE WHEN {ZONED} THEN c_nationkey::VARCHAR ELSE 'ext' END
  || '|__name__=m|dup=' || {DUP} || '|dup=a|empty=|env=prod|segment=' || c_mktsegment || '|zz=last' AS series
FROM customer"""

ORACLE["external_labels_by_tenant"] = f"""
SELECT c_nationkey::VARCHAR AS push_key, '__name__=customer_acctbal|country=' || n_name || '|customer='
  || c_custkey || '|nation=' || c_nationkey || '|region=' || r_name || '|segment=' || c_mktsegment AS series,
  c_acctbal AS value, {NOW} AS timestamp_ms
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# --- relabel -----------------------------------------------------------------------------------------

ORACLE["relabel_keep"] = counter_series(PLAIN, "event IN ('click', 'view') AND u % 2 = 0")
ORACLE["relabel_drop"] = counter_series(PLAIN, "u % 5 NOT IN (0, 1, 2)")
ORACLE["relabel_replace"] = counter_series(
    f"{NAME} || CASE WHEN u < 10 THEN '|digit_' || usr || '=yes' ELSE '' END || {EVENT} || '|kind='"
    f" || substr(event, 1, 1) || '_' || substr(event, 2) || '$' || {USER}"
    f" || CASE WHEN u % 5 = 3 THEN '' ELSE {ZONE} END"
)
ORACLE["relabel_hashmod"] = counter_series(
    f"{NAME} || '|__tmp_hashmod=' || {HASH} || {EVENT} || {USER} || {ZONE}", f"{HASH} < '6'"
)
ORACLE["relabel_labelmap"] = counter_series(
    f"{NAME} || '|by_event=' || event || '|by_user=' || usr || {EVENT} || {USER} || {ZONE}"
)
ORACLE["relabel_labeldrop"] = counter_series(f"{NAME} || {EVENT}")
ORACLE["relabel_labelkeep"] = counter_series(f"{NAME} || {EVENT} || {ZONE}")
ORACLE["relabel_lowercase"] = f"""
SELECT c_nationkey::VARCHAR AS push_key, {GAUGE} || lower(c_mktsegment) || '-' || c_nationkey AS series,
  c_acctbal AS value, {NOW} AS timestamp_ms
FROM customer"""
ORACLE["relabel_uppercase"] = counter_series(
    f"'EVENT=' || upper(event) || '|' || {NAME} || {EVENT} || {USER} || {ZONE}"
)
EQUAL = (
    f"{NAME} || '|digit=' || (u % 10) || {EVENT} || {USER}"
    f" || CASE WHEN u % 5 <> 0 THEN '|zdigit=' || (u % 5) ELSE '' END || {ZONE}"
)
ORACLE["relabel_keepequal"] = counter_series(EQUAL, "u % 10 BETWEEN 1 AND 4")
ORACLE["relabel_dropequal"] = counter_series(EQUAL, "u % 10 NOT BETWEEN 1 AND 4")
ORACLE["relabel_chain"] = counter_series(
    f"{NAME} || {EVENT} || {USER} || '|where=' || coalesce(zone, '') || '.' || event",
    f"event <> 'error' AND {HASH} <> '7'",
)
ORACLE["relabel_all_dropped"] = counter_series(PLAIN, "false")
ORACLE["drop_empty_labels"] = f"""
SELECT c_custkey, CASE WHEN {ZONED} THEN 'Zone=' || c_nationkey || '|' ELSE '' END
  || '__name__=m|dup=' || {DUP} || '|dup=a|segment=' || c_mktsegment AS series
FROM customer"""

# --- sizes and batches -------------------------------------------------------------------------------

ORACLE["series_bytes_push"] = f"WITH {DOC_SERIES} SELECT ord, label_bytes AS est_bytes FROM ds"
ORACLE["series_bytes_prebuilt"] = f"""WITH {EVENT_SERIES}
SELECT push_key, ord, b::BIGINT AS est_bytes FROM es_sized"""

ORACLE["batch_by_family"] = f"""WITH RECURSIVE {ORDER_SERIES},
units AS (
  SELECT push_key, family_ord AS ord, count(*) AS n,
    sum(16 + (8 + 12 + lc + 2) + (5 + lo + 2) + (6 + 1 + 2)) AS b
  FROM os GROUP BY ALL), {greedy("units", 12, 700)}
SELECT os.push_key, family_ord, metric_ord, batch_no
FROM os JOIN numbered s ON s.push_key = os.push_key AND s.ord = os.family_ord"""

DOC_BATCHES = f"""WITH RECURSIVE {DOC_SERIES},
units AS (SELECT push_key, ord, 1 AS n, b FROM ds_sized), {greedy("units", 8, 20_000)}"""
ORACLE["batch_by_series"] = f"{DOC_BATCHES} SELECT push_key, ord, batch_no FROM numbered"

ORACLE["batch_by_count"] = f"""WITH {EVENT_SERIES}
SELECT push_key, ord, (row_number() OVER (PARTITION BY push_key ORDER BY ord) - 1) // 7 AS batch_no
FROM es"""

ORACLE["batch_profile"] = f"""{DOC_BATCHES}
SELECT s.push_key, batch_no, count(*) AS n_series, sum(d.b)::BIGINT AS est_bytes, min(s.ord) AS first_ord,
  max(s.ord) AS last_ord
FROM numbered s JOIN ds_sized d ON d.push_key = s.push_key AND d.ord = s.ord GROUP BY ALL"""


def label_wire(name: int, value: str) -> str:
    """Bytes of one label field, from the lengths of name and (non-empty) value."""
    return f"(1 + {framed(f'(1 + {framed(str(name))} + 1 + {framed(value)})')})"


def series_wire(labels: list[str], samples: str) -> str:
    body = f"({' + '.join(labels)} + {samples})"
    return f"1 + {framed(body)}"


# The clock field of a sample is left out for zero.
DOC_SAMPLE = f"(2 + 9 + CASE WHEN ord = 0 THEN 0 ELSE 1 + {vlen('ord')} END)"
DOC_WIRE = series_wire(
    [label_wire(8, "8"), label_wire(6, "ls"), f"CASE WHEN lt = 0 THEN 8 ELSE {label_wire(4, 'lt')} END"],
    DOC_SAMPLE,
)
ORACLE["encode_batches"] = f"""{DOC_BATCHES}
SELECT s.push_key, batch_no, count(*) AS n_series, sum({DOC_WIRE.replace('ord', 'd.ord')})::BIGINT
    AS raw_bytes, 'application/x-protobuf' AS content_type, 'snappy' AS content_encoding,
  '0.1.0' AS protocol_version
FROM numbered s JOIN ds_sized d ON d.push_key = s.push_key AND d.ord = s.ord
GROUP BY s.push_key, batch_no"""

PUSHED = f"""WITH RECURSIVE {ORDER_SERIES},
kept AS (
  SELECT *, 16 + (8 + 12 + lc + 2) + (8 + lc + 2) + (3 + 4 + 2) + (5 + lo + 2) + (6 + 1 + 2) AS b
  FROM os WHERE o_orderstatus <> 'P'),
units AS (
  SELECT push_key, family_ord AS ord, count(*) AS n, sum(b) AS b FROM kept GROUP BY ALL),
{greedy("units", 10, 900)}"""
ORDER_WIRE = series_wire(
    [label_wire(8, "(12 + lc)"), label_wire(8, "lc"), label_wire(3, "4"), label_wire(5, "lo"),
     label_wire(6, "1")],
    f"(2 + 9 + 1 + {vlen('ts')})",
)
ORACLE["push_to_batches"] = f"""{PUSHED}
SELECT k.push_key, batch_no, count(*) AS n_series, sum({ORDER_WIRE})::BIGINT AS raw_bytes
FROM kept k JOIN numbered s ON s.push_key = k.push_key AND s.ord = k.family_ord
GROUP BY k.push_key, batch_no"""
ORACLE["push_profile"] = f"""{PUSHED}
SELECT k.push_key, batch_no, count(*) AS n_series, sum(k.b)::BIGINT AS est_bytes,
  min(family_ord) AS first_ord, max(family_ord) AS last_ord
FROM kept k JOIN numbered s ON s.push_key = k.push_key AND s.ord = k.family_ord
GROUP BY k.push_key, batch_no"""
ORACLE["stream_push"] = f"""{PUSHED}
SELECT k.push_key AS queue, batch_no + 1 AS record_id, count(*) AS n_series
FROM kept k JOIN numbered s ON s.push_key = k.push_key AND s.ord = k.family_ord
GROUP BY k.push_key, batch_no"""

EVENT_WIRE = series_wire(
    [label_wire(8, "11"), label_wire(5, "strlen(block)"), label_wire(4, "strlen(usr)")], "sample_wire"
)
ORACLE["push_series_to_batches"] = f"""WITH RECURSIVE {EVENT_SERIES},
units AS (SELECT push_key, ord, 1 AS n, b FROM es_sized), {greedy("units", 8, 3000)}
SELECT s.push_key, batch_no, count(*) AS n_series, sum({EVENT_WIRE})::BIGINT AS raw_bytes
FROM numbered s JOIN es_sized d ON d.push_key = s.push_key AND d.ord = s.ord
GROUP BY s.push_key, batch_no"""

EVENT_BATCHES = f"""{EVENT_SERIES},
units AS (SELECT push_key, ord, 1 AS n, b FROM es_sized), {greedy("units", 8, 3000)},
batches AS (
  SELECT s.push_key AS queue, batch_no + 1 AS record_id, count(*) AS n_series, sum(d.n) AS n_samples
  FROM numbered s JOIN es_sized d ON d.push_key = s.push_key AND d.ord = s.ord
  GROUP BY s.push_key, batch_no)"""
ORACLE["stream_push_series"] = f"""WITH RECURSIVE {EVENT_BATCHES}
SELECT queue, record_id, n_series FROM batches"""

# A drain goes along each queue until it meets a body that is refused for now.
ORACLE["drain_pass"] = f"""WITH RECURSIVE {EVENT_BATCHES},
stops AS (SELECT queue, min(record_id) AS stop FROM batches WHERE n_samples % 10 = 9 GROUP BY queue)
SELECT queue, record_id,
  CASE WHEN stop <= record_id THEN 'waits' WHEN n_samples % 7 = 3 THEN 'dropped' ELSE 'sent' END AS state,
  CASE WHEN stop = record_id THEN 10000 ELSE 0 END::BIGINT AS due_ms
FROM batches LEFT JOIN stops USING (queue)"""

# --- outbox ------------------------------------------------------------------------------------------

BUDGET = 20_000_000
ADMITTED = f"""WITH RECURSIVE {REQUESTS},
q AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY arrival_ms, request_id) AS i FROM line),
run AS (
  SELECT queue, i, request_id, size_bytes <= {BUDGET} AS accepted,
    CASE WHEN size_bytes <= {BUDGET} THEN size_bytes ELSE 0 END AS used
  FROM q WHERE i = 1
  UNION ALL
  SELECT q.queue, q.i, q.request_id, run.used < {BUDGET} AND run.used + q.size_bytes <= {BUDGET},
    run.used + CASE WHEN run.used < {BUDGET} AND run.used + q.size_bytes <= {BUDGET}
      THEN q.size_bytes ELSE 0 END
  FROM run JOIN q ON q.queue = run.queue AND q.i = run.i + 1),
flags AS (
  SELECT *, count(*) FILTER (accepted) OVER (PARTITION BY queue ORDER BY i) AS place FROM run)"""
ORACLE["budget_admission"] = f"""{ADMITTED}
SELECT queue, request_id, accepted, CASE WHEN accepted THEN place END AS accept_no FROM flags"""
ORACLE["outbox_append"] = f"""{ADMITTED}
SELECT queue, request_id, CASE WHEN accepted THEN place END AS record_id,
  CASE WHEN NOT accepted THEN 'over budget' END AS reason FROM flags"""

ORACLE["http_deliver"] = f"""WITH {REQUESTS},
judged AS (
  SELECT *, coalesce(sum(CASE WHEN request_id % 101 = 0 OR request_id % 97 = 0 THEN 1 ELSE 0 END) OVER (
    PARTITION BY queue ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM line)
SELECT queue, request_id AS record_id, 1::INTEGER AS attempt,
  CASE WHEN request_id % 101 = 0 THEN NULL WHEN request_id % 97 = 0 THEN 503
    WHEN request_id % 13 = 0 THEN 400 ELSE 204 END::INTEGER AS status,
  CASE WHEN request_id % 101 = 0 THEN 'timeout' END AS error_class,
  CASE WHEN request_id % 101 <> 0 AND request_id % 97 = 0 THEN '7' END AS retry_after
FROM judged WHERE ahead < 2"""

ORACLE["fifo_drain_slice"] = f"""WITH {REQUESTS},
ranked AS (
  SELECT queue, request_id AS record_id, request_id % 89 <> 13 AS due,
    coalesce(sum(CASE WHEN request_id % 89 = 13 THEN 1 ELSE 0 END) OVER (
      PARTITION BY queue ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM line)
SELECT queue, record_id FROM ranked WHERE due AND ahead < 3"""

ORACLE["drain_outcome"] = f"""WITH {ATTEMPTS}, {OUTBOX},
latest AS (
  SELECT * FROM waits QUALIFY row_number() OVER (
    PARTITION BY request_id ORDER BY attempt DESC, at_ms DESC) = 1)
SELECT record_id, b.queue,
  CASE WHEN outcome = 'retryable' THEN at_ms + wait_ms ELSE next_due_ms END AS next_due_ms
FROM box b LEFT JOIN latest l ON l.queue = b.queue AND l.request_id // 8 = b.record_id
WHERE l.request_id IS NULL OR outcome = 'retryable'
  OR (outcome = 'permanent' AND coalesce(error_class, '') IN ('cancelled', 'deadline'))"""

ORACLE["retry_timers"] = f"""WITH {ATTEMPTS},
latest AS (
  SELECT * FROM waits QUALIFY row_number() OVER (
    PARTITION BY request_id ORDER BY attempt DESC, at_ms DESC) = 1),
due AS (
  SELECT queue, request_id // 8 AS record_id, attempt::INTEGER AS tries,
    CASE WHEN outcome = 'retryable' THEN at_ms + wait_ms ELSE at_ms END AS due_ms
  FROM latest
  WHERE outcome = 'retryable' OR (outcome = 'permanent' AND coalesce(error_class, '') IN ('cancelled', 'deadline')))
SELECT * FROM due WHERE due_ms <= (SELECT max(at_ms) FROM waits)"""

ORACLE["quarantine_corrupt"] = f"""{DOC_BATCHES}
SELECT DISTINCT push_key, batch_no,
  CASE WHEN batch_no % 4 IN (1, 2) THEN 'corrupt' ELSE 'kept' END AS state
FROM numbered"""

ORACLE["next_due_at"] = f"WITH {ATTEMPTS} SELECT event_id, at_ms + wait_ms AS next_due_ms FROM waits"
ORACLE["pending_bytes"] = f"""WITH {OUTBOX}
SELECT queue, sum(size_bytes)::BIGINT AS pending_bytes FROM box GROUP BY queue"""

ORACLE["spool_counters"] = f"""WITH {ATTEMPTS}, {OUTBOX},
b AS (
  SELECT queue, count(*) AS enqueued, count(*) FILTER (state = 'corrupt') AS corrupt FROM box GROUP BY ALL),
a AS (
  SELECT queue, count(*) FILTER (outcome = 'success') AS sent,
    count(*) FILTER (outcome <> 'success' AND coalesce(error_class, '') <> 'cancelled') AS send_failures,
    count(*) FILTER (outcome = 'retryable') AS retryable_failures,
    count(*) FILTER (outcome = 'permanent'
      AND coalesce(error_class, '') NOT IN ('cancelled', 'deadline')) AS permanent_failures
  FROM att GROUP BY ALL)
SELECT queue, enqueued, sent, send_failures, retryable_failures, permanent_failures,
  permanent_failures + corrupt AS dropped, corrupt
FROM b JOIN a USING (queue)"""

ORACLE["spool_gauges"] = f"""WITH {OUTBOX}
SELECT queue, sum(size_bytes)::BIGINT AS pending_bytes, count(*) FILTER (state = 'sending') AS inflight,
  CASE WHEN sum(size_bytes) >= 1000000 THEN 1 ELSE 0 END AS blocked
FROM box GROUP BY queue"""

ORACLE["recovery_reseed"] = f"""WITH {OUTBOX}
SELECT record_id, queue, 'pending' AS state, 0::BIGINT AS next_due_ms FROM box WHERE state <> 'corrupt'"""

# --- requests ----------------------------------------------------------------------------------------

ORACLE["request_defaults"] = """
SELECT o_orderkey AS request_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'text/plain' ELSE 'application/x-protobuf' END AS content_type,
  CASE WHEN o_orderkey % 4 = 0 THEN 'gzip' ELSE 'snappy' END AS content_encoding,
  CASE WHEN o_orderkey % 5 = 0 THEN '9.9' END AS protocol_version
FROM orders"""

KEPT = {"%24": "$", "%26": "&", "%2B": "+", "%3D": "=", "%3A": ":", "%40": "@"}


def escaped(c: str) -> str:
    out = f"url_encode({c})"
    for code, char in KEPT.items():
        out = f"replace({out}, '{code}', '{char}')"
    return out


ORACLE["route_tenant_url"] = f"""WITH t AS (
  SELECT 'page' AS kind, page_id AS id, url AS x FROM pages
  UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations)
SELECT kind, id, 'http://host:8428/insert/' || {escaped('x')} || '/write' AS url FROM t"""

ORACLE["route_by_table"] = f"""
SELECT c_custkey, 'https://' || lower(replace(n_name, ' ', '-')) || '.example.com/'
  || {escaped('c_name')} || '/push' AS url
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

ORACLE["validate_routes"] = """WITH c AS (SELECT page_id, page_id % 10 AS c FROM pages)
SELECT page_id, c IN (2, 9) AS ok, CASE WHEN c = 0 THEN 'empty'
  WHEN c IN (1, 6, 7) THEN 'no scheme or host' WHEN c IN (3, 4, 5) THEN 'tenant slot not once in path'
  WHEN c = 8 THEN 'tenant slot outside path' ELSE '' END AS reason
FROM c"""

ORACLE["tenant_header"] = f"""WITH {REQUESTS}
SELECT request_id, 'Authorization=Bearer secret;Content-Encoding='
  || CASE WHEN request_id % 4 = 0 THEN 'gzip' ELSE 'snappy' END || ';Content-Type='
  || CASE WHEN request_id % 3 = 0 THEN 'text/plain' ELSE 'application/x-protobuf' END
  || ';User-Agent=shipper'
  || CASE WHEN request_id % 5 = 0 THEN ';{VERSION_HEADER}=9.9' ELSE '' END
  || CASE WHEN request_id % 6 <> 0 THEN ';X-Scope-OrgID=' || queue ELSE '' END
  || ';x-priority=' || o_orderpriority AS headers
FROM line"""

ORACLE["reject_reserved_headers"] = """
SELECT o_orderkey AS request_id, o_orderkey % 7 IN (1, 5) AS allowed FROM orders"""

ORACLE["canonical_headers"] = """
SELECT conv_id * 1000 + turn AS id, 'A b=spaced;X-' || upper(role[1]) || role[2:] || '=up,' || turn || ','
  || text || ';Z-Last=' || role || ',' || text AS headers
FROM conversations"""

ORACLE["body_mode"] = f"""WITH {REQUESTS},
m AS (
  SELECT *, CASE WHEN request_id % 7 = 0 THEN 0 ELSE size_bytes END AS declared,
    CASE WHEN request_id % 3 = 0 THEN 'bytes' WHEN request_id % 4 = 0 THEN 'replayable'
      WHEN request_id % 5 < 3 THEN 'stream' ELSE 'none' END AS mode
  FROM line)
SELECT request_id, mode, CASE WHEN mode = 'bytes' THEN strlen(body)
  WHEN mode = 'stream' AND declared = 0 THEN -1 ELSE declared END::BIGINT AS length
FROM m"""

ORACLE["body_too_large"] = """
SELECT doc_id, doc_id % 5 <> 0 AND strlen(text) > 1000 AS too_large FROM documents"""

ORACLE["record_size"] = f"""WITH d AS (
  SELECT doc_id, strlen(source) AS ls, strlen(lang) AS ll, strlen(text) AS lt FROM documents)
SELECT doc_id, (5 + {framed('ls')} + {framed('22')} + CASE WHEN doc_id % 2 = 0 THEN 7 ELSE 1 END + 6
  + 1 + 7 + 1 + {framed('ll')} + {framed('ls')} + {framed('lt')})::BIGINT AS size_bytes
FROM d"""

# --- outcomes ----------------------------------------------------------------------------------------

ORACLE["classify_status"] = """
SELECT l_partkey % 700 + 100 AS status, count(*) AS n,
  CASE WHEN status // 100 = 2 THEN 'success' WHEN status = 429 OR status // 100 = 5 THEN 'retryable'
    ELSE 'permanent' END AS outcome
FROM lineitem GROUP BY ALL"""
ORACLE["classify_error"] = f"WITH {ATTEMPTS} SELECT event_id, outcome FROM att"
ORACLE["parse_retry_after"] = f"WITH {ATTEMPTS} SELECT event_id, retry_after_ms FROM att"
ORACLE["backoff_schedule"] = """
SELECT s_suppkey, retry, wait_ms FROM supplier, (VALUES (1, 1500::BIGINT), (2, 3000::BIGINT),
  (3, 6000::BIGINT), (4, 12000::BIGINT), (5, 20000::BIGINT), (6, 20000::BIGINT)) AS v(retry, wait_ms)"""
ORACLE["retry_wait"] = f"WITH {ATTEMPTS} SELECT event_id, attempt::INTEGER AS attempt, wait_ms FROM waits"
ORACLE["jitter"] = "SELECT o_orderkey, true AS inside FROM orders"
ORACLE["retry_outcome"] = f"""WITH {ATTEMPTS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY outcome = 'retryable',
      CASE WHEN outcome = 'retryable' THEN -(attempt * 2 + replay::INTEGER)
        ELSE attempt * 2 + replay::INTEGER END) AS r
  FROM att WHERE attempt <= 3)
SELECT request_id, attempt::INTEGER AS attempts, (attempt - 1)::INTEGER AS retries, status, error_class,
  CASE WHEN outcome = 'retryable' THEN 'exhausted' ELSE outcome END AS outcome
FROM ranked WHERE r = 1"""
ORACLE["eof_replay"] = f"""WITH {ATTEMPTS}
SELECT request_id, count(*) FILTER (replay) AS replays, count(*) FILTER (NOT replay) AS counted_attempts
FROM att GROUP BY request_id"""

PAIRS = "regexp_replace(substr(hex(encode(text)), 1, 8192), '(..)', '\\1 ', 'g')"
ESCAPED = PAIRS
for code, text in (("5C", "5C 5C"), ("22", "5C 22"), ("0A", "5C 6E"), ("0D", "5C 72"), ("09", "5C 74")):
    ESCAPED = f"replace({ESCAPED}, '{code} ', '{text} ')"
# Two-byte letters that the cut leaves half of.
ESCAPED = f"regexp_replace({ESCAPED}, 'C3 $', '5C 78 63 33 ')"
ORACLE["failure_message"] = f"""WITH m AS (
  SELECT doc_id, hex(encode('{FAILED}')) || CASE doc_id % 4
    WHEN 0 THEN hex(encode(': status=503 Service Unavailable err=refused: ' || source))
    WHEN 1 THEN hex(encode(': refused: ' || source))
    WHEN 2 THEN hex(encode(': status=503 Service Unavailable body="')) || replace({ESCAPED}, ' ', '') || '22'
    ELSE '' END AS message
  FROM documents)
SELECT doc_id, md5(message) AS message_md5 FROM m"""

# --- rate limits -------------------------------------------------------------------------------------

LIMIT = 120_000


def served(requests: str, deadline: str | None) -> str:
    """Walk each queue's requests (columns a, s and d) through a token bucket; table ``run``."""
    # Fills needed, the time of the first, and how many come in time.
    need = f"CASE WHEN x.budget >= x.s THEN 0 ELSE ceil(x.s / {LIMIT}.0)::BIGINT END"
    late = "false" if deadline is None else "x.now > x.d"
    can = "y.need" if deadline is None else (
        "CASE WHEN y.need = 0 OR y.first > y.d THEN 0"
        " ELSE least(y.need, (y.d - y.first) // 1000 + 1) END"
    )
    step = f"""SELECT queue, i, request_id,
    CASE WHEN late OR can < need THEN NULL WHEN need = 0 THEN now ELSE first + (can - 1) * 1000 END AS admit,
    CASE WHEN late THEN budget WHEN need = 0 THEN budget - s WHEN can = need THEN need * {LIMIT} - s
      WHEN can > 0 THEN 0 ELSE budget END AS budget,
    CASE WHEN late OR can = 0 THEN fill ELSE first + can * 1000 END AS fill,
    CASE WHEN late THEN line_free WHEN can < need THEN d WHEN need = 0 THEN now
      ELSE first + (can - 1) * 1000 END AS line_free"""

    def one(source: str) -> str:
        return f"""{step} FROM (
    SELECT *, {can} AS can FROM (
      SELECT *, {need} AS need, greatest(x.now, x.fill) AS first, {late} AS late FROM ({source}) x) y) z"""

    start = (
        "SELECT queue, i, request_id, s, d, 0::BIGINT AS budget, -1::BIGINT AS fill, -1::BIGINT AS line_free,"
        " a AS now FROM q WHERE i = 1"
    )
    following = (
        "SELECT q.queue, q.i, q.request_id, q.s, q.d, run.budget, run.fill, run.line_free,"
        " greatest(q.a, run.line_free) AS now"
        " FROM run JOIN q ON q.queue = run.queue AND q.i = run.i + 1"
    )
    return f"""
q AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY a, request_id) AS i FROM {requests}),
run AS ({one(start)} UNION ALL {one(following)})"""


ORACLE["token_bucket_schedule"] = f"""WITH RECURSIVE {REQUESTS},
r AS (SELECT queue, request_id, arrival_ms AS a, size_bytes AS s, 0 AS d FROM line), {served("r", None)}
SELECT queue, request_id, admit AS admit_ms, admit - a AS wait_ms FROM run JOIN r USING (queue, request_id)"""

ORACLE["rate_limit_bypass"] = f"""WITH RECURSIVE {REQUESTS},
r AS (
  SELECT queue, request_id, arrival_ms AS a, size_bytes AS s, 0 AS d FROM line
  WHERE request_id % 10 NOT IN (0, 3)), {served("r", None)},
every AS (
  SELECT queue, admit, admit - a AS w FROM run JOIN r USING (queue, request_id)
  UNION ALL SELECT queue, arrival_ms, 0 FROM line WHERE request_id % 10 IN (0, 3))
SELECT queue, count(*) AS n, count(*) FILTER (w = 0) AS at_once, max(admit) AS last_ms
FROM every GROUP BY queue"""

ORACLE["deadline_cut"] = f"""WITH RECURSIVE {REQUESTS},
r AS (
  SELECT queue, request_id, arrival_ms AS a, size_bytes AS s,
    arrival_ms + CASE request_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 2500 ELSE 30000 END AS d
  FROM line), {served("r", "d")}
SELECT queue, request_id, admit AS admit_ms FROM run"""
