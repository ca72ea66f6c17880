from pyspark.sql import functions as F

from seriesship import ClientConfig, RetryPolicy
from seriesship.config import VERSION_HEADER
from seriesship.functions.text import header_name, path_escape
from seriesship.operators import requests as Q

MAP = "map<string,array<string>>"


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_path_escape(spark):
    got = column(spark, ["team/a b%2F..?#x", "a~b*c", "é$&+=:@-_.", ""], path_escape)
    assert got == ["team%2Fa%20b%252F..%3F%23x", "a~b%2Ac", "%C3%A9$&+=:@-_.", ""]


def test_tenant_route(spark):
    url = lambda t: Q.route_url(F.lit("http://h/{tenant}/w"), t)
    assert column(spark, ["a/b", None], url) == ["http://h/a%2Fb/w", "http://h//w"]
    fixed = lambda t: Q.route_url(F.lit("http://h/w"), t)
    assert column(spark, ["a"], fixed) == ["http://h/w"]


def test_urls(spark):
    bad = [
        "", None, "localhost:8428/write", "/api/v1/write", "http:///api/v1/write", "http://{tenant}.h/w",
        "http://h/w?t={tenant}", "http://h/{tenant}/w?t={tenant}", "http://h/{tenant}/{tenant}",
        "http://h/w#{tenant}", "http://{tenant}@h/w", "http://u@/w", "http://h:port/w", "http://h/%zz",
        "http://h/\n",
    ]
    good = ["http://h/w", "https://u:p@h:8428/{tenant}/w?x=1", "http://[::1]:80/w", "http://h"]
    assert all(column(spark, bad, Q.url_problem))
    assert column(spark, good, Q.url_problem) == [None] * len(good)


def test_header_names(spark):
    got = column(spark, ["x-scope-orgid", "CONTENT-type", "a b", "x--y"], header_name)
    assert got == ["X-Scope-Orgid", "Content-Type", "a b", "X--Y"]


def test_canonical_headers_do_not_depend_on_spelling(spark):
    maps = [
        {"z-last": ["9"], "x-header": ["1", "2"], "A-First": ["0"], "none": []},
        {"Z-LAST": ["9"], "X-Header": ["1", "2"], "a-first": ["0"]},
    ]
    got = column(spark, maps, Q.header_list, MAP)
    assert [[(e.key, e["values"]) for e in x] for x in got] == [
        [("A-First", ["0"]), ("X-Header", ["1", "2"]), ("Z-Last", ["9"])]
    ] * 2
    merged = column(spark, [{"x-a": ["1"], "X-A": ["2"]}], Q.header_list, MAP)[0]
    assert [(e.key, e["values"]) for e in merged] == [("X-A", ["2", "1"])]


def test_reserved_headers(spark):
    cfg = ClientConfig(tenant_header="X-Scope-OrgID", bearer_token="t")
    names = ["CONTENT-TYPE", "content-encoding", "User-agent", VERSION_HEADER.lower(),
             "authorization", "x-scope-ORGID"]
    maps = [{n: ["v"]} for n in names]
    assert column(spark, maps, lambda c: Q.reserved_header(c, cfg), MAP) == [True] * 6
    plain = lambda c: Q.reserved_header(c, ClientConfig())
    assert column(spark, [*maps[4:], None, {}], plain, MAP) == [False] * 4


def test_send_headers(spark):
    cfg = ClientConfig(tenant_header="X-Tenant", bearer_token="s", user_agent="ua", default_content_type="ct")
    df = spark.createDataFrame(
        [("t", "", None, "1", {"x": ["1", "2"], "y": []}), ("", "own", "gz", None, None)],
        f"tenant_id string, content_type string, content_encoding string, protocol_version string, headers {MAP}",
    )
    a, b = [r.send_headers for r in Q.request_headers(Q.with_defaults(df, cfg), cfg).collect()]
    assert a == {
        "User-Agent": ["ua"], "Content-Type": ["ct"], VERSION_HEADER: ["1"],
        "X-Tenant": ["t"], "Authorization": ["Bearer s"], "x": ["1", "2"],
    }
    assert b == {"User-Agent": ["ua"], "Content-Type": ["own"], "Content-Encoding": ["gz"],
                 "Authorization": ["Bearer s"]}


def test_body_mode_and_limit(spark):
    rows = [
        (b"xy", True, True, 9, None), (b"", True, True, 9, None), (None, False, True, 0, 64),
        (None, False, True, 64, 64), (None, False, False, 0, None), (None, False, True, 8, 8),
    ]
    df = Q.body_mode(spark.createDataFrame(
        rows, "body binary, replayable boolean, stream boolean, content_length bigint, stream_bytes bigint"
    ))
    assert [(r.mode, r.length) for r in df.collect()] == [
        ("bytes", 2), ("replayable", 9), ("stream", -1), ("stream", 64), ("none", 0), ("stream", 8)
    ]
    ok, bad = Q.split_too_large(df, ClientConfig(retry=RetryPolicy(max_body=8)))
    assert (ok.count(), bad.count()) == (4, 2)
    assert Q.split_too_large(df, ClientConfig())[1].count() == 0


def varint(n):
    return max(1, -(-n.bit_length() // 7))


def framed(s):
    n = len(s.encode() if isinstance(s, str) else s or b"")
    return varint(n) + n


def test_record_size(spark):
    rows = [
        ("t", "ct", "snappy", "0.1.0", b"x" * 300, {"x-b": ["1", "é" * 70], "A": [], "X-B": ["z"]}),
        (None, None, None, None, None, None),
        ("é", "", "", "", b"x" * 20_000, {}),
    ]
    df = spark.createDataFrame(
        rows, "tenant_id string, content_type string, content_encoding string, protocol_version string, "
        f"body binary, headers {MAP}",
    )
    got = [r.size_bytes for r in Q.record_size(df).collect()]
    fixed = lambda r: 5 + sum(framed(f or "") for f in r[:5]) + 1
    header = framed("X-B") + 1 + framed("z") + framed("1") + framed("é" * 70)
    assert got == [fixed(rows[0]) + header, fixed(rows[1]), fixed(rows[2])]


def test_requests_whose_queue_has_no_route_stay(spark):
    rows = spark.createDataFrame([(1, "a", "x y"), (2, "b", "x"), (3, None, "x")], "id int, queue string, tenant_id string")
    routes = spark.createDataFrame([("a", "http://a/{tenant}/w"), ("c", "http://c/")], "queue string, url string")
    routed, lost = Q.split_routed(Q.route(rows, routes))
    assert [(r.id, r.url) for r in routed.collect()] == [(1, "http://a/x%20y/w")]
    assert sorted((r.id, r.reason) for r in lost.collect()) == [(2, Q.NO_ROUTE), (3, Q.NO_ROUTE)]
    assert "url" not in lost.columns
