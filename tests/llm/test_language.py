import pyarrow as pa
import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesship.llm import language, queries
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def model(k=3, seed=1):
    rng = np.random.default_rng(seed)
    return language.Model([f"l{i}" for i in range(k)], moves=rng.normal(size=(k, k)), first=rng.normal(size=k))


def test_forward_backward_equals_enumeration():
    m, rng = model(), np.random.default_rng(2)
    sizes = np.array([4, 0, 1, 3])
    scores = rng.normal(size=(8, 3))
    got, moved = language.forward_backward(m, scores, sizes)
    want, want_moved, at = np.zeros((8, 3)), np.zeros((3, 3)), 0
    for size in sizes:
        if not size:
            continue
        paths = list(itertools.product(range(3), repeat=int(size)))
        weight = np.array([
            np.exp(m.first[p[0]] + sum(scores[at + i, y] for i, y in enumerate(p)) + sum(m.moves[a, b] for a, b in zip(p, p[1:])))
            for p in paths
        ])
        weight /= weight.sum()
        for p, w in zip(paths, weight):
            for i, y in enumerate(p):
                want[at + i, y] += w
            for a, b in zip(p, p[1:]):
                want_moved[a, b] += w
        at += size
    assert np.allclose(got, want) and np.allclose(moved, want_moved)


@pytest.fixture(scope="module")
def told(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return queries.op5_identify_language(spark, SF).cache()


def test_held_out_accuracy(spark, told):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = told.join(docs.where(F.col("lang").isNotNull()), "doc_id").where("held_out and lang_pred <> 'und'")
    right, all_ = seen.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 200 and right / all_ > 0.97


def test_switches_are_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if os.path.isdir(SF) else pytest.skip("no test tables")
    m = language.train(docs.select("text", "lang"))
    import pyarrow as pa

    by = {r["lang"]: r["text"] for r in docs.where(F.length("text").between(800, 2000)).orderBy("doc_id").collect()}
    mixed = " ".join(by["en"].split()[:40] + by["de"].split()[:40])
    found, share, switches = language.label(m, pa.array([mixed]))
    assert 0.35 < share[0] < 0.65 and 1 <= switches[0] <= 5


def test_odd_rows(spark):
    df = cases.odd(spark)
    rows = language.identify(df, F.lit(True)).collect()
    assert cases.ids(rows) == cases.EXPECTED_IDS
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 6):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1


def test_nothing_to_learn_from_and_empty(spark):
    df = cases.odd(spark)
    rows = language.identify(df, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)} and len(rows) == len(cases.ODD)
    assert language.identify(cases.empty(spark), F.lit(True)).count() == 0


def test_predictions_see_text_only(spark):
    df = spark.createDataFrame([(i, "der hund und die katze", "de") for i in range(9)] + [(i, "the dog and the cat", "en") for i in range(9, 18)], "doc_id long, text string, lang string")
    m = spark.sparkContext.broadcast(language.train(df))
    swapped = df.withColumns({"lang": F.lit("en"), "source": F.lit("x"), "doc_id": F.lit(0)})
    rows = language.annotate(swapped, m).collect()
    assert {r["lang_pred"] for r in rows if r["text"].startswith("der")} == {"de"}


def test_blocks_of_lines_give_what_all_at_once_gives(monkeypatch):
    m = language.fit(["the old man and the sea"] * 5 + ["der alte mann und das meer"] * 5, ["en"] * 5 + ["de"] * 5, ["de", "en"])
    texts = pa.array(["the old man\nund das meer\n" * 20, None, "", "der mann the sea " * 30, "sea"])
    whole = language.label(m, texts)
    monkeypatch.setattr(language, "CELLS", 16)
    for a, b in zip(whole, language.label(m, texts)):
        np.testing.assert_allclose(a, b)


def test_long_lines_are_cut(monkeypatch):
    monkeypatch.setattr(language, "LINE", 8)
    m = language.fit(["the old man and the sea"] * 5 + ["der alte mann und das meer"] * 5, ["en"] * 5 + ["de"] * 5, ["de", "en"])
    seen = []
    run = language.forward_backward
    monkeypatch.setattr(language, "forward_backward", lambda m, s, sizes: seen.append(sizes.max()) or run(m, s, sizes))
    found, share, _ = language.label(m, pa.array(["the old man and the sea " * 50]))
    assert found[0] == 1 and share[0] > 0.9 and max(seen) == 8


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    df = spark.createDataFrame([("a b", "x"), ("c d", "y"), ("e f", "z")], "text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        language.train(df)
