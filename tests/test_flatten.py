import math
import random
import struct

import pytest

from seriesship import flatten
from seriesship.functions.text import format_bound
from seriesship.schema import FAMILY_METRICS


def metric(name, kind, labels=(), ts=None, value=None, histogram=None, summary=None, ord=0):
    return ("p", ord, 0, name, kind, [{"name": k, "value": v} for k, v in labels], ts, value, histogram, summary)


def run(spark, rows, external=None, now=1000):
    flat = flatten(spark.createDataFrame(rows, FAMILY_METRICS), external, now)
    return [
        ([(x.name, x.value) for x in r.labels], r.value, r.timestamp)
        for r in flat.orderBy("family_ord", "metric_ord", "point_ord").collect()
    ]


def test_counter_with_external_label(spark):
    rows = [metric("test_counter", "COUNTER", [("const", "label")], value=1.0)]
    assert run(spark, rows, {"env": "testing"}, 1_000_000) == [
        ([("__name__", "test_counter"), ("const", "label"), ("env", "testing")], 1.0, 1_000_000)
    ]


def test_histogram_order_and_closing_bucket(spark):
    hist = {
        "buckets": [
            {"upper_bound": 0.1, "cumulative_count": 0},
            {"upper_bound": 0.5, "cumulative_count": 1},
        ],
        "sample_sum": 0.2,
        "sample_count": 1,
    }
    got = run(spark, [metric("http_req_dur", "HISTOGRAM", histogram=hist)], {"cluster": "A"}, 1234)
    assert [(dict(labels)["__name__"], dict(labels).get("le"), v) for labels, v, _ in got] == [
        ("http_req_dur_bucket", "0.1", 0.0),
        ("http_req_dur_bucket", "0.5", 1.0),
        ("http_req_dur_bucket", "+Inf", 1.0),
        ("http_req_dur_sum", None, 0.2),
        ("http_req_dur_count", None, 1.0),
    ]
    assert [n for n, _ in got[0][0]] == ["__name__", "cluster", "le"]
    assert {t for _, _, t in got} == {1234}


def test_explicit_inf_is_not_added_twice(spark):
    hist = {
        "buckets": [{"upper_bound": math.inf, "cumulative_count": 7}],
        "sample_sum": 1.0,
        "sample_count": 9,
    }
    got = run(spark, [metric("h", "HISTOGRAM", histogram=hist)])
    assert [v for labels, v, _ in got if dict(labels).get("le") == "+Inf"] == [7.0]


def test_summary_and_missing_values(spark):
    summary = {
        "quantiles": [{"quantile": 0.99, "value": 3.0}],
        "sample_sum": 4.0,
        "sample_count": 2,
    }
    rows = [
        metric("s", "SUMMARY", summary=summary, ts=5, ord=0),
        metric("none", "COUNTER", ord=1),
        metric("none", "HISTOGRAM", ord=2),
        metric("odd", "GAUGE_HISTOGRAM", value=1.0, ord=3),
        metric("g", "GAUGE", [("a", None), (None, "b"), ("c", "")], value=0.0, ord=4),
        metric("u", "UNTYPED", value=-1.5, ord=5),
    ]
    assert run(spark, rows) == [
        ([("__name__", "s"), ("quantile", "0.99")], 3.0, 5),
        ([("__name__", "s_sum")], 4.0, 5),
        ([("__name__", "s_count")], 2.0, 5),
        ([("__name__", "g"), ("c", "")], 0.0, 1000),
        ([("__name__", "u")], -1.5, 1000),
    ]


def test_external_le_and_name_yield_to_the_series(spark):
    hist = {"buckets": [], "sample_sum": 0.0, "sample_count": 0}
    got = run(spark, [metric("h", "HISTOGRAM", histogram=hist)], {"le": "x", "__name__": "n", "B": "b"})
    assert [labels for labels, _, _ in got] == [
        [("B", "b"), ("__name__", "h_bucket"), ("le", "+Inf")],
        [("B", "b"), ("__name__", "h_sum"), ("le", "x")],
        [("B", "b"), ("__name__", "h_count"), ("le", "x")],
    ]


GOLDEN = {
    1.0: "1", 2.5: "2.5", 0.0001: "0.0001", 0.00001: "1e-05", 100000.0: "100000", 123456.0: "123456",
    1000000.0: "1e+06", 1048576.0: "1.048576e+06", math.inf: "+Inf", -math.inf: "-Inf", 0.1: "0.1",
    -0.0: "-0", 2e23: "2e+23", 1e100: "1e+100", -2.5e-7: "-2.5e-07",
}


def by_rule(x):
    mantissa, _, power = repr(abs(x)).partition("e")
    whole, _, frac = mantissa.partition(".")
    digits, point = whole + frac, len(whole) + int(power or 0)
    point -= len(digits) - len(digits.lstrip("0"))
    digits = digits.strip("0")
    sign, exp10 = "-" if x < 0 else "", point - 1
    if exp10 < -4 or exp10 >= 6:
        tail = "." + digits[1:] if len(digits) > 1 else ""
        return f"{sign}{digits[0]}{tail}e{'-' if exp10 < 0 else '+'}{abs(exp10):02d}"
    if exp10 < 0:
        return f"{sign}0.{'0' * (-exp10 - 1)}{digits}"
    if len(digits) <= point:
        return sign + digits + "0" * (point - len(digits))
    return f"{sign}{digits[:point]}.{digits[point:]}"


def test_bound_text(spark):
    rng = random.Random(3)
    xs = list(GOLDEN) + [math.nan]
    while len(xs) < 3000:
        x = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        if math.isfinite(x) and abs(x) > 1e-300:
            xs.append(x)
        xs.append(rng.randint(1, 10**9) / 10 ** rng.randint(0, 12))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    for r in df.select("x", format_bound("x").alias("t")).collect():
        if math.isnan(r.x):
            want = "NaN"
        elif r.x in GOLDEN:
            want = GOLDEN[r.x] if r.x else "-0"
        else:
            want = by_rule(r.x)
        assert r.t == want, r


def test_no_families_is_no_error(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [3, 20])
def test_many_labels_sorted_in_byte_order(spark, n):
    labels = [(chr(0x41 + (7 * i) % n) + "é" * (i % 2), str(i)) for i in range(n)]
    got = run(spark, [metric("g", "GAUGE", labels, value=1.0)])[0][0]
    names = [k for k, _ in got]
    assert names == sorted(names, key=str.encode) and len(got) == n + 1
