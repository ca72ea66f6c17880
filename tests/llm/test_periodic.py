import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesship.llm import periodic, queries
from tests.llm.cases import EXPECTED_IDS, LONG, empty, ids, odd


def brute(words):
    """Every run by comparing each lag along the whole text."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[start : i + q]
            if len(stretch) >= max(24, 3 * q) and not any(stretch[e:] == stretch[:-e] for e in range(1, q)):
                out.append((start, len(stretch), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    words = [w for t in texts for w in t]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    out = periodic.find_runs(np.array([number[w] for w in words], np.int64), np.array([len(t) for t in texts], np.int64))
    return [[tuple(r) for r in runs] for runs in out]


def test_against_brute_force():
    rng, texts = random.Random(1), []
    for k in range(300):
        t = [rng.choice("ab") if k % 3 else rng.choice("abcdefgh") for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            block = [rng.choice("abc") for _ in range(rng.randrange(1, 45))]
            t += (block * rng.randrange(2, 7))[: rng.randrange(10, 200)]
            t += [rng.choice("abcd") for _ in range(rng.randrange(4))]
        texts.append(t)
    got = found(texts)
    assert sum(map(len, got)) > 150
    for t, runs in zip(texts, got):
        assert runs == brute(t), t


def test_nested_periods():
    inner = list("ab" * 15 + "c")
    t = inner * 4 + ["x"] + inner * 2
    assert found([t]) == [brute(t)]
    assert {q for _, _, q in found([t])[0]} == {2, 31}


@pytest.mark.parametrize("n, runs", [(0, []), (23, []), (24, [(0, 24, 1)]), (200_000, [(0, 200_000, 1)])])
def test_one_word(n, runs):
    assert found([["x"] * n]) == [runs]


def test_text_ends_do_not_join():
    assert found([["x"] * 20, ["x"] * 20]) == [[], []]


def test_rows_at_once(spark):
    rows = periodic.collapse_runs(odd(spark)).collect()
    assert ids(rows) == EXPECTED_IDS
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert [by[i]["n_words"] for i in (3, 4, 5, 6)] == [0, 0, 0, 3] and by[3]["collapsed"] == ""
    assert by[7]["n_words"] == 30_000 and [tuple(r) for r in by[7]["runs"]] == [(0, 30_000, 977)]
    assert by[7]["collapsed"].split(" ") == LONG.split(" ")[:977]
    assert by[9]["collapsed"] == "Élan 🙂 naïve\x00\x1f▁ café Next line"
    assert periodic.collapse_runs(empty(spark)).count() == 0


def expected(doc_id, text):
    """A row of the query, straight from its definition."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, words = h // 10, [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (
        len(runs), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_query_on_a_fixture(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " \t".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(220)))) for i in range(150)]
    rows += [(200 + i, "a b a b c " * i) for i in range(40)] + [(None, None), (5, None), (7, "é " * 50), (7, "é " * 50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    cols = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = sorted((str(r["doc_id"]), *(str(r[c]) for c in cols)) for r in out)
    assert got == sorted((str(i), *map(str, expected(i, t))) for i, t in rows)
    assert sum(r["n_runs"] for r in out) > 20


def test_rewriting_is_the_only_change(spark):
    df = spark.createDataFrame([(i, f"w{i} " * 3) for i in range(60)], "doc_id long, text string")
    same = queries.rewritten(df).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    assert all(r["text"] == f"w{r['doc_id']} " * 3 for r in same.collect())
