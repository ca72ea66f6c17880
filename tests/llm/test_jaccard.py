import random

import pytest
from pyspark.sql import functions as F

from seriesship.llm import jaccard
from tests.llm import cases


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=lambda r: (r[0] is None, r))


def compare(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in cases.CLASHES})
    rows = jaccard.similarity_components(df).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=lambda r: (r[0] is None, r))
    assert got == brute(docs)


@pytest.mark.parametrize("hot", [32, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    """Families of near copies with chains of links, shared lines, sizes around the limit; few and many hot tokens."""
    monkeypatch.setattr(jaccard, "HOT_FROM", hot)
    monkeypatch.setattr(jaccard, "MEMBERS", 4)
    monkeypatch.setattr(jaccard, "QUERIES", 3)
    rng = random.Random(hot)
    line = " ".join(f"l{i}" for i in range(12))
    docs = []
    for family in range(12):
        base = [f"f{family}w{rng.randint(0, 60)}" for _ in range(rng.choice([3, 5, 6, 20, 45, 90]))]
        for _ in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 999)}"
            own = own[: len(own) - rng.randint(0, 2)] or base
            text = " ".join(own)
            docs.append((len(docs) * 3 % 1009, f"{line}\n{text}" if family % 3 == 0 else text.upper() if rng.random() < 0.2 else text))
    compare(spark, docs)


def test_exactly_at_the_limit(spark):
    words = [f"w{i}" for i in range(40)]
    # 36 shingles; with 4 more at the end 36 / 40 = 0.9; with 9 more 36 / 45 = 0.8 links; with 10 more it does not.
    docs = [(10, " ".join(words)), (11, " ".join(words + [f"a{i}" for i in range(9)])), (12, " ".join(words + [f"b{i}" for i in range(10)]))]
    assert brute(docs) == [(10, 36, 10), (11, 45, 10), (12, 46, 12)]
    compare(spark, docs)


def test_odd_rows(spark):
    docs = [(d, t) for d, t, *_ in cases.ODD] + [(20, "one two"), (21, "ONE  two"), (22, "two one"), (23, cases.PROSE.upper())]
    compare(spark, docs)


def test_empty(spark):
    assert jaccard.similarity_components(cases.empty(spark)).count() == 0


def test_bound_never_hides_a_link():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(3000):
        a, b = rng.integers(1, 40, 2)
        shared = int(rng.integers(0, min(a, b) + 1))
        if 9 * shared >= 4 * (a + b):
            assert jaccard._may_link(shared + int(rng.integers(0, 3)), a, a, shared, b, b)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    rows = jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in rows} == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}}
