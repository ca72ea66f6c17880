import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesship.llm import backoff
from tests.llm import cases

END = "\n"


class Naive:
    """The same model by dictionaries, from counts of all texts, scored by recursion."""

    def __init__(self, texts, word_share, gram_share):
        tokens = [["<s>", *t.lower().split(), END] for t in texts]
        self.c = Counter(w for t in tokens for w in t[1:])
        self.N, self.V, self.texts = sum(self.c.values()), len(self.c), len(texts)
        self.often = {w for w, n in self.c.items() if n >= max(1.0, word_share * self.N)} | {"<s>"}
        least = max(2, math.ceil(gram_share * self.N))
        grams = Counter()
        for t in tokens:
            for k in (2, 3):
                grams.update(g for g in zip(*(t[i:] for i in range(k))) if all(w in self.often for w in g))
        self.grams = {g: n for g, n in grams.items() if n >= least}

    def total(self, h):
        if len(h) == 1:
            return self.texts if h[0] == "<s>" else self.c[h[0]]
        return self.grams[h]

    def p(self, w, h):
        if not h:
            return (self.c[w] + 0.1) / (self.N + 0.1 * (self.V + 1))
        if (*h, w) in self.grams:
            return (self.grams[(*h, w)] - 0.75) / self.total(h)
        kept = [g[-1] for g in self.grams if g[:-1] == h]
        if not kept:
            return self.p(w, h[1:])
        back = (1 - sum(self.p(v, h) for v in kept)) / (1 - sum(self.p(v, h[1:]) for v in kept))
        return back * self.p(w, h[1:])

    def score(self, text):
        words, total = ["<s>", *text.lower().split(), END], 0.0
        for i in range(1, len(words)):
            h = tuple(words[max(0, i - 2) : i])
            while h and not (all(w in self.often for w in h) and (len(h) == 1 or h in self.grams)):
                h = h[1:]
            total += math.log10(self.p(words[i], h))
        return total


def corpus(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice("aabbbcdefg") * rng.choice([1, 1, 2]) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def scored(spark):
    texts = corpus(1, 60)
    docs = [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = backoff.score(df, F.col("doc_id") % 5 == 0, word_share=0.02, gram_share=1e-6, block_bytes=600).collect()
    return texts, {r["doc_id"]: r for r in rows}


def test_scores_against_the_naive_model(scored):
    texts, rows = scored
    naive = Naive([t for i, t in enumerate(texts) if i % 5], 0.02, 1e-6)
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r, words = rows[i], [*t.lower().split(), END]
        assert r["held_out"] == (i % 5 == 0) and r["n_tokens"] == len(words) and r["train_tokens"] == naive.N
        assert r["n_known"] == sum(naive.c[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10(naive.p(w, ())) for w in words))
        assert r["score"] == pytest.approx(naive.score(t))


def test_every_distribution_sums_to_one():
    naive = Naive(corpus(2, 40), 0.02, 1e-6)
    words = [*naive.c, "unseen"]
    for h in [(), ("a",), ("<s>",), ("b", "b"), ("a", "b")]:
        if len(h) < 2 or h in naive.grams:
            assert sum(naive.p(w, h) for w in words) == pytest.approx(1)


def test_odd_rows(spark):
    rows = backoff.score(cases.odd(spark), F.coalesce(F.col("doc_id") == 2, F.lit(False))).collect()
    assert cases.ids(rows) == cases.EXPECTED_IDS
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by[3]["n_tokens"] == by[4]["n_tokens"] == by[5]["n_tokens"] == 1
    assert by[7]["n_tokens"] == 30_001 and all(math.isfinite(r["score"]) for r in rows)
    assert by[2]["held_out"] and by[1]["score"] == by[2]["score"]


def test_nothing_to_learn_from_and_empty(spark):
    rows = backoff.score(cases.odd(spark), F.lit(True)).collect()
    assert len(rows) == len(cases.ODD) and {r["n_known"] for r in rows} == {0}
    assert all(r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert backoff.score(cases.empty(spark), F.lit(False)).count() == 0


def test_pieces_of_a_text_are_read_as_the_whole():
    """Arcs over one, two and three words, failures from each; a text in pieces of any size has the same sum."""
    width, rng = 4, np.random.default_rng(5)  # words 0 to 2, and the start
    heads = [(0, 1), (1, 0), (3, 0)]
    pair_state = {h: 1 + width + i for i, h in enumerate(heads)}
    arcs, nxt = [], []
    for u, v in [(0, 1), (1, 0), (3, 0), (2, 2), (1, 1)]:
        arcs.append((1 + u) * width + v)
        nxt.append(pair_state.get((u, v), 1 + v))
    for u, v, w in [(0, 1, 0), (1, 0, 1), (1, 0, 0), (3, 0, 1)]:
        arcs.append(pair_state[u, v] * width + w)
        nxt.append(pair_state.get((v, w), 1 + w))
    order = np.argsort(arcs)
    fail = np.array([0] * (1 + width) + [1 + v for _, v in heads])
    a = backoff.Automaton(width, np.array(arcs)[order], -rng.random(len(arcs)), np.array(nxt)[order], fail, -rng.random(len(fail)))
    word, sizes = rng.integers(0, 3, 400), np.array([1, 250, 0, 3, 146])
    base, first = -rng.random(400), np.cumsum(sizes) - sizes

    def one(f, n):
        s, total = a.start, 0.0
        for t in range(f, f + n):
            while (key := s * width + word[t]) not in a.arcs and s:
                total, s = total + a.back[s], int(a.fail[s])
            at = np.flatnonzero(a.arcs == key)
            total += a.log_p[at[0]] if len(at) else base[t]
            s = int(a.next[at[0]]) if len(at) else 1 + int(word[t])
        return total

    want = [one(f, n) for f, n in zip(first, sizes)]
    for most in (2, 3, 7, 512):
        assert a.traverse(word, base, first, sizes, most) == pytest.approx(want)


def test_the_whole_model_by_default(spark):
    """Rare words stand in n-grams, and an n-gram seen twice is kept, however many tokens there are."""
    rare = "one rare phrase here"
    texts = [*corpus(3, 40), rare, f"{rare} too", *["filler words again"] * 5000, f"so {rare} stands"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    naive = Naive(texts[:-1], 0, 0)
    assert 2 < 1e-4 * naive.N
    for bucket_tokens in (1 << 20, 400):
        rows = backoff.score(df, F.col("doc_id") == len(texts) - 1, block_bytes=4000, bucket_tokens=bucket_tokens).collect()
        by = {r["doc_id"]: r["score"] for r in rows}
        assert len(rows) == len(texts)
        for i in (*range(42), 100, len(texts) - 1):
            assert by[i] == pytest.approx(naive.score(texts[i])), (bucket_tokens, i)


def test_words_are_cut_as_by_bytes():
    odd = [" a\tB ", "", None, "   ", "Ä b\x85c \x1cd\x1f", "x\n\ny\x0b\x0cz\r", "one", "İ É ퟿  Q"]
    rng = random.Random(8)
    odd += ["".join(rng.choice(" \t\n\x0b\x0c\r\x1c\x85  aBÉ") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    texts = pa.array([None if t is None else t.encode() for t in ["before", *odd, "after"]], pa.binary())[1:-1]
    want = [t.lower().split() if t else [] for t in texts.to_pylist()]
    sizes, found = backoff.words(texts)
    assert sizes.tolist() == list(map(len, want)) and found.to_pylist() == [w for ws in want for w in ws]


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 60, (1 << 63) - 1])
def test_distinct_numbers_and_places(top):
    for n in (0, 1, 2, 500):
        key = np.random.default_rng(n).integers(0, top, n)
        want, got = np.unique(key, return_inverse=True), backoff.distinct(key)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_long_texts_are_read_in_few_steps_through_a_table_of_arcs(monkeypatch):
    """Each step goes over all pieces side by side; arcs are found by hash."""
    width, rng = 50, np.random.default_rng(9)
    arcs = np.unique(rng.integers(width, (1 + width) * width, 900))
    a = backoff.Automaton(width, arcs, -rng.random(len(arcs)), 1 + arcs % width, np.zeros(1 + width, np.int64), -rng.random(1 + width))
    every = np.arange((1 + width) * width)
    assert a._arc(every).tolist() == [int(np.searchsorted(arcs, k)) if k in arcs else -1 for k in every.tolist()]
    steps, follow = [], a._follow
    monkeypatch.setattr(a, "_follow", lambda *x: steps.append(1) or follow(*x))
    a.traverse(rng.integers(0, width - 1, 5000), -rng.random(5000), np.array([0]), np.array([5000]))
    assert len(steps) < 100


def test_what_a_block_holds_a_token():
    """Under half of what it held with ids, contexts and sums of every n-gram in 64 bits."""
    rng = np.random.default_rng(4)
    n = 300_000
    tokens, sizes = rng.zipf(1.3, n) % 40_000, np.full(n // 100, 100)
    base = backoff.Base(np.array([0]), np.array([50]), n, 40_000, len(sizes), 40_000, 2, 3, 1 << 18)
    block = backoff.Block(np.arange(40_001), tokens, sizes, np.ones(len(sizes)))
    tracemalloc.start()
    two, at = block.pairs(base)
    held, most = (x / n for x in tracemalloc.get_traced_memory())
    tracemalloc.stop()
    assert len(two.head) > n / 4 and len(at) == n
    assert held < 20 and most < 50
