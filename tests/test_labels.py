from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesship.functions import labels as L
from seriesship.schema import LABELS

NAME = st.sampled_from(["__name__", "A", "a", "b", "le", "é", "z"])
PAIRS = st.lists(st.tuples(NAME, st.sampled_from(["", "1", "2"])), max_size=6)
EXT = st.dictionaries(NAME, st.sampled_from(["x", "y"]), max_size=4)


def merged(own, ext):
    own = sorted(own, key=lambda p: p[0].encode())
    names = {n for n, _ in own}
    extra = [(n, v) for n, v in ext.items() if n not in names]
    return sorted(own + extra, key=lambda p: p[0].encode())


def test_merge_matches_plain_python(spark):
    cases = []

    @settings(max_examples=150, deadline=None)
    @given(PAIRS, EXT)
    def collect(own, ext):
        cases.append((own, ext))

    collect()
    struct = lambda ps: [{"name": n, "value": v} for n, v in ps]
    df = spark.createDataFrame(
        [(i, struct(a), b) for i, (a, b) in enumerate(cases)], f"i int, own {LABELS}, ext map<string,string>"
    )
    got = df.select("i", L.merge_external(F.col("own"), L.external_from_map(F.col("ext"))).alias("m"))
    for r in got.collect():
        assert [(x.name, x.value) for x in r.m] == merged(*cases[r.i]), cases[r.i]


def test_sort_is_stable_for_duplicates(spark):
    df = spark.createDataFrame([([("d", "2"), ("c", "0"), ("d", "1")],)], f"own {LABELS}")
    got = df.select(L.sort_labels(F.col("own")).alias("m")).first().m
    assert [(x.name, x.value) for x in got] == [("c", "0"), ("d", "2"), ("d", "1")]


def test_bytes_are_bytes_not_characters(spark):
    df = spark.createDataFrame([([("né", "é")],)], f"own {LABELS}")
    assert df.select(L.label_bytes(F.col("own")).alias("n")).first().n == 3 + 2 + 2
