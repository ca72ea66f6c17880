import hashlib

import pytest

from seriesship import Rule, relabel
from seriesship.schema import LABELS


def run(spark, series, *rules, **kw):
    rows = [(i, [{"name": k, "value": v} for k, v in s.items()]) for i, s in enumerate(series)]
    got = relabel(spark.createDataFrame(rows, f"i int, labels {LABELS}"), rules, **kw)
    return [{x.name: x.value for x in r.labels} for r in got.orderBy("i").collect()]


def named(*names):
    return [{"__name__": n} for n in names]


def test_keep_and_drop(spark):
    series = named("test_counter", "http_request_total")
    assert run(spark, series, Rule("drop", ("__name__",), regex="test_counter")) == series[1:]
    assert run(spark, series, Rule("keep", ("__name__",), regex="http_.*")) == series[1:]
    # Full match only.
    assert run(spark, series, Rule("keep", ("__name__",), regex="http_")) == []
    assert run(spark, [{"a": "x\n"}], Rule("keep", ("a",), regex="x")) == []
    assert run(spark, [{"a": "x\ny"}], Rule("keep", ("a",), regex="x.y")) == [{"a": "x\ny"}]


def test_label_filter(spark):
    series = [{"__name__": "requests_total", "service": s} for s in ("api", "web")]
    assert run(spark, series, Rule("keep", ("service",), regex="api")) == series[:1]


def test_replace_with_group(spark):
    rule = Rule(source_labels=("__name__",), regex="http_([^_]+)_total", replacement="${1}", target_label="service")
    got = run(spark, named("http_request_total", "other"), rule)
    assert got == [{"__name__": "http_request_total", "service": "request"}, {"__name__": "other"}]


def test_templates(spark):
    def one(replacement, regex="(?P<first>[a-z]+)-(.*)", target="t"):
        rule = Rule(source_labels=("s",), regex=regex, replacement=replacement, target_label=target)
        return run(spark, [{"s": "ab-cd", "t": "old"}], rule)[0]

    assert one("$2$1")["t"] == "cdab"
    assert one("${first}_x")["t"] == "ab_x"
    assert one("$1x$$2")["t"] == "$2"
    assert "t" not in one("$9")
    assert one("new", target="n_${1}") == {"s": "ab-cd", "t": "old", "n_ab": "new"}
    # A target that turns out invalid changes nothing.
    assert one("new", target="n_${2}", regex="(a)(.*)") == {"s": "ab-cd", "t": "old"}
    assert one("keep", regex="nomatch")["t"] == "old"


def test_chain_stops_at_drop(spark):
    rules = [Rule("drop", ("__name__",), regex=r) for r in ("test_counter", "debug_.*")]
    got = run(spark, named("test_counter", "debug_x", "http_request_total"), *rules)
    assert got == named("http_request_total")


def test_hashmod(spark):
    series = named(*[f"metric_{i}" for i in range(10)])
    rule = Rule("hashmod", ("__name__",), target_label="__tmp_hashmod", modulus=2)
    got = run(spark, series, rule)
    for s in got:
        digest = hashlib.md5(s["__name__"].encode()).digest()
        assert s["__tmp_hashmod"] == str(int.from_bytes(digest[8:], "big") % 2)
    kept = run(spark, series, rule, Rule("keep", ("__tmp_hashmod",), regex="0"))
    assert kept == [s for s in got if s["__tmp_hashmod"] == "0"] and kept


def test_labelmap_last_wins_and_labeldrop(spark):
    got = run(spark, [{"a_x": "1", "b_x": "2", "x": "3"}], Rule("labelmap", regex="[ab]_(.*)", replacement="$1"))
    assert got == [{"a_x": "1", "b_x": "2", "x": "2"}]
    assert run(spark, got, Rule("labeldrop", regex="[ab]_.*")) == [{"x": "2"}]
    assert run(spark, got, Rule("labelkeep", regex="a_.*")) == [{"a_x": "1"}]


def test_equal_rules_and_case(spark):
    series = [{"a": "1", "b": "1"}, {"a": "1", "b": "2"}, {"b": ""}]
    assert run(spark, series, Rule("keepequal", ("a",), target_label="b")) == [{"a": "1", "b": "1"}, {}]
    assert run(spark, series, Rule("dropequal", ("a",), target_label="b")) == [{"a": "1", "b": "2"}]
    assert run(spark, [{"a": "Né"}], Rule("uppercase", ("a",), target_label="u")) == [{"a": "Né", "u": "NÉ"}]
    assert run(spark, [{"a": "Né"}], Rule("lowercase", ("a",), target_label="a")) == [{"a": "né"}]


def test_empty_values_leave_only_with_rules(spark):
    series = [{"a": "1", "e": ""}]
    assert run(spark, series) == series
    assert run(spark, series, Rule("keep", ("a",))) == [{"a": "1"}]
    assert run(spark, named("x"), Rule("drop", ("__name__",), regex=".*")) == []


@pytest.mark.parametrize(
    "rule",
    [
        Rule(source_labels=("a",), target_label="invalid-label!"),
        Rule(source_labels=("a",)),
        Rule("hashmod", ("a",), target_label="t"),
        Rule("keep", ("a",), regex="("),
        Rule("keep", ("a",), regex="(?=x)"),
        Rule("nothing"),
        Rule("labelmap", replacement="a-b"),
        Rule("lowercase", ("a",), target_label="t", replacement="x"),
        Rule("labeldrop", ("a",), regex="x"),
        Rule("keepequal", ("a",), target_label="t", regex="x"),
    ],
)
def test_invalid_rules_are_rejected_before_reading(spark, rule):
    with pytest.raises(ValueError):
        relabel(spark.createDataFrame([], f"labels {LABELS}"), [rule])


def test_utf8_names_allow_more(spark):
    rule = Rule(source_labels=("a",), target_label="invalid-label!")
    assert run(spark, [{"a": "1"}], rule, name_scheme="utf8") == [{"a": "1", "invalid-label!": "1"}]


def test_rules_stay_in_the_jvm_and_are_not_repeated(spark):
    series = spark.createDataFrame([], f"labels {LABELS}")
    rules = [Rule(source_labels=("a",), target_label=f"t{i}", replacement=f"r{i}_$1") for i in range(6)]
    rules.append(Rule("drop", ("t1",), regex="x"))
    plan = relabel(series, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
    assert plan.count("r0_") == 1, "a rule's expression is evaluated in one place"
