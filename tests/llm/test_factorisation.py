import math
import random

import numpy as np
import pytest

from seriesship.llm import factorisation as fm
from seriesship.llm import queries
from tests.llm.cases import EXPECTED_IDS, empty, ids, odd


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = fm.Machine(0.3, rng.normal(size=fm.SIZE), rng.normal(size=(fm.SIZE, fm.RANK)))
    text, feature, x = fm.vectors([b"one two two three", None, b"UP 12 $$"], [["a"], [None], ["b"]])
    got, _ = m.parts(text, feature, x, 3)
    for t in range(3):
        f, v = feature[text == t], x[text == t]
        pairs = sum(m.factors[f[i]] @ m.factors[f[j]] * v[i] * v[j] for i in range(len(f)) for j in range(i))
        assert got[t] == pytest.approx(0.3 + (m.linear[f] * v).sum() + pairs, abs=1e-4)


def test_words_and_statistics_of_a_text():
    """The vector of a text does not depend on its neighbours, and equal words meet in one bucket."""
    alone = fm.vectors([b"b a b c"], [[]])
    among = fm.vectors([b"zz zz", b" b a b c", b"", b"q"], [[], [], [], []])
    mine = among[0] == 1
    words = alone[1] < fm.WORDS
    assert sorted(alone[2][words]) == pytest.approx([0.5, 0.5, math.sqrt(0.5)])
    assert np.array_equal(alone[1][words], among[1][mine][among[1][mine] < fm.WORDS])
    assert [int((among[0] == t).sum()) for t in range(4)] == [len(fm.STATS) + k for k in (1, 3, 0, 1)]

    def bins(text):
        _, feature, _ = fm.vectors([text], [[]])
        return [int(f - fm.WORDS) % fm.BINS for f in feature if f >= fm.WORDS]

    assert bins(b"a a a b")[6] == fm.BINS - 1 and bins(b"a b c d")[6] == 0  # like the one before
    assert bins(b"a b c d")[7] == fm.BINS - 1 and bins(b"AB CD")[2] == fm.BINS - 1
    assert fm.vectors([], [])[0].size == 0


def corpus(n):
    rng = random.Random(n)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(["river", "stone", "harbour", "letter", "old", "man"]) for _ in range(rng.randrange(5, 60))]
        if not good:
            words = [w.upper() + "!!" if i % 2 else "buy" for w in words]
        rows.append((i, " ".join(words), len(words)))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    known = spark.createDataFrame(labels[:600], "doc_id long, label int")
    out = {r["doc_id"]: r for r in fm.grade(docs, known, ("n",)).collect()}
    assert sum(out[i]["predicted"] == y for i, y in labels[600:]) >= 0.97 * 300
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())


def test_interactions_are_learned():
    """Labels that no linear score can tell: two features, good if just one is set."""
    texts = []
    for i in range(400):
        a, b = i & 1, (i >> 1) & 1
        texts.append((a ^ b, np.array([a, 2 + b, fm.WORDS], np.int32), np.ones(3, np.float32)))
    m = fm.fit(texts, 0.0)
    for a in (0, 1):
        for b in (0, 1):
            odds, _ = m.parts(np.zeros(3, np.int64), np.array([a, 2 + b, fm.WORDS]), np.ones(3), 1)
            assert (odds[0] > 0) == bool(a ^ b)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (6, 0), (7, 1), (7, 0), (None, 1), (9, None)], "doc_id long, label int")
    rows = fm.grade(odd(spark), labels, ("n_chars", "source")).collect()
    assert ids(rows) == EXPECTED_IDS and all(0 <= r["score"] <= 1 for r in rows)
    one = [r["score"] for r in rows if r["doc_id"] == 1]
    assert one[0] == one[1]
    assert fm.grade(empty(spark), labels).count() == 0
    nothing = fm.grade(odd(spark), labels.where("false")).collect()
    assert {r["score"] for r in nothing} == {0.5} and ids(nothing) == EXPECTED_IDS


def test_query_does_not_see_labels_of_held_out_rows(spark, tmp_path):
    rows, labels = corpus(400)
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    import zlib

    def scores(flip):
        name = tmp_path / f"labels{flip}"
        (name).mkdir()
        (name / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        held = [(i, 1 - y if flip and zlib.crc32(str(i).encode()) % 3 == 1 else y, 0) for i, y in labels]
        spark.createDataFrame(held, "doc_id long, quality int, toxic int").write.parquet(str(name / "labels.parquet"))
        return {r["doc_id"]: (r["score"], r["held_out"]) for r in queries.QUERIES["op13_factorisation_quality"](spark, str(name)).collect()}

    assert scores(False) == scores(True)
