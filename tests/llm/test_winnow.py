import hashlib
import random
import re

import pytest

from seriesship.llm import winnow
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item_id, item in items:
        own = words(item)
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(doc) - n + 1) if own else ():
            if tuple(doc[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found |= {str(item_id)} if item_id is not None else set()
    ids = ",".join(sorted(found))
    return len(doc), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(doc)


def compare(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = winnow.contamination(d, b).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows), key=key)
    assert got == sorted(((i, *brute(t, items)) for i, t in docs), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    """Few different words, so that windows repeat, overlap and tie; items shorter and longer than a window."""
    rng = random.Random(seed)
    text = lambda n, k: " ".join(rng.choice("aBcdÉ"[:k]) + rng.choice(["", "x"]) for _ in range(n))
    items = [(i, text(n, 3)) for i, n in enumerate([1, 5, 8, 12, 13, 14, 30, 60])]
    docs = [(i, text(rng.randint(0, 80), 4)) for i in range(30)]
    for i in range(30, 50):
        part = words(rng.choice(items)[1])
        cut = rng.randint(0, max(0, len(part) - 13))
        docs.append((i, f"{text(20, 5)}. {' '.join(part[cut : cut + rng.randint(11, 25)]).upper()}, {text(20, 5)}"))
    compare(spark, docs, items)


def test_odd_rows_and_items(spark):
    docs = [(d, t) for d, t, *_ in cases.ODD]
    items = [(5, cases.PROSE), (5, cases.PROSE), (10, cases.PROSE[:40]), (7, None), (8, ""), (None, "a text without an id with a few words"), (9, "word1")]
    compare(spark, docs, items)
    out = winnow.contamination(cases.odd(spark), spark.createDataFrame(items, "item_id long, text string"))
    assert cases.ids(out.collect()) == cases.EXPECTED_IDS


def test_words_fold_by_themselves(spark):
    """Lower case of a sigma depends on what follows the word; the words are the same all the same."""
    greek = [("ΟΔΟΣ", ".", "ΑΣ"), ("ΟΔΟΣ", " ", "ΑΣ"), ("οδος", "-", "ΑΣ")]
    tail = " Α Β Γ Δ Ε Ζ Η Θ Ι Κ Λ Μ"
    compare(spark, [(i, a + gap + b + tail) for i, (a, gap, b) in enumerate(greek)], [(1, "ΟΔΟΣ ΑΣ" + tail)])


@pytest.mark.parametrize("seed", [5, 6])
def test_mixed_case_of_many_scripts(spark, seed):
    rng = random.Random(seed)
    letters = "aAbBßẞſKkİıΣσςΆάДдǅǆﬁÉéÀà"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(12)]
    docs = []
    for i in range(40):
        part = rng.choice(items)[1].split()
        own = [word() for _ in range(rng.randint(0, 15))]
        docs.append((i, "".join(w + rng.choice([" ", ".", ", ", "-"]) for w in own + part + own)))
    docs += [(100 + i, t.swapcase()) for i, t in docs] + [(200 + i, t.lower()) for i, t in docs]
    compare(spark, docs, items)


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnow.contamination(cases.empty(spark), none).count() == 0
    rows = winnow.contamination(cases.odd(spark), none).collect()
    assert len(rows) == len(cases.ODD) and not any(r["contaminated"] or r["n_hit"] for r in rows)


def test_every_long_shared_span_shares_a_fingerprint(spark):
    """Two texts that share 13 words share a kept hash, wherever the span lies."""
    rng = random.Random(3)
    span = [f"s{i}" for i in range(13)]
    rows = []
    for i in range(40):
        pad = lambda n: [f"w{rng.randint(0, 9)}" for _ in range(n)]
        rows.append((i, " ".join(pad(rng.randint(0, 30)) + span + pad(rng.randint(0, 30)))))
    df = winnow._prepared(spark.createDataFrame(rows, "doc_id long, text string"), [])
    kept = [set(r[0]) for r in df.select(winnow._fingerprints(df, [])).collect()]
    assert all(a & b for a in kept for b in kept)
