import random
import re

import numpy as np
import pytest

from seriesship.llm import outliers
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["a ", "b ", "c ", "\n", "a b\n", "# ", "é|", " \t"]) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_counts_against_brute_force():
    for text in [*texts(1, 150), None, "", "\n\n", "x\nx\n x\nx", "a " * 40]:
        assert outliers.measure(text)[:5] == brute(text)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    """A big and a small source, a language with few rows, and junk in a fifth of the big one."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        lang, source = ("en", "big") if i < 300 else ("en", "small") if i < 340 else ("fr", f"s{i % 3}")
        text = prose(rng, rng.randint(30, 300))
        if i < 300 and i % 5 == 0:
            text = " ".join(w + rng.choice(["##", "||", "$$", ""]) for w in text.split())
        rows.append((i, text, lang, source))
    rows.append((900, prose(rng, 10), "en", "big"))
    rows.append((901, "same words " * 60, "en", "big"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return {r["doc_id"]: r for r in outliers.judge(df).collect()}


def test_masked_junk_goes_and_prose_stays(judged):
    junk = [i for i in range(300) if i % 5 == 0]
    assert not any(judged[i]["kept"] for i in junk)
    kept = [judged[i]["kept"] for i in range(400) if i not in set(junk)]
    assert sum(kept) >= len(kept) - 3


def test_base_rule_and_fallbacks(judged):
    assert judged[900]["base_failed"] and judged[901]["base_failed"] and not judged[900]["kept"]
    assert judged[900]["distance"] is None and judged[320]["distance"] is not None and judged[390]["distance"] is not None


def concentrated(x, near):
    """Exact concentration of one start, and the logarithm of the determinant that cores of full size end at."""
    core, last = int(outliers.SHARE * len(x)), np.inf
    while True:
        place = x[near].mean(axis=0)
        scatter = np.cov(x[near].T, bias=True) * outliers._consistency(outliers.SHARE) + np.diag(outliers.FLOOR)
        log_det = np.linalg.slogdet(scatter)[1]
        if len(near) == core and log_det > last - 1e-9:
            return last, place, scatter
        last, d = log_det if len(near) == core else np.inf, x - place
        near = np.argsort(np.einsum("ni,ij,nj->n", d, np.linalg.inv(scatter), d))[:core]


def least_determinant(x, starts=60):
    """The best of many random starts of a few rows each."""
    rng = np.random.default_rng(1)
    return min((concentrated(x, rng.choice(len(x), 12, replace=False)) for _ in range(starts)), key=lambda f: f[0])


def groups_of_vectors():
    """Clean rows that hang together, with junk at one place, junk all about, and hardly any."""
    rng = np.random.default_rng(2)
    mix = np.eye(6) + 0.5 * np.tri(6, k=-1)
    clean = lambda n: [5, 5, 0, 0, 0, 0.9] + rng.normal(0, [0.8, 0.5, 0.3, 0.1, 0.05, 0.02], (n, 6)) @ mix
    return {
        "heap": (clean(1200), rng.normal([9, 9, 4, 1, 1, 0.2], 0.1, (700, 6))),
        "all about": (clean(1200), rng.normal([5, 5, 3, 1, 0.5, 0.5], [3, 3, 2, 1, 1, 1], (500, 6))),
        "few": (clean(800), rng.normal([9, 1, 4, 1, 1, 0.2], 0.1, (9, 6))),
    }


def test_least_determinant_against_brute_force(spark):
    groups = groups_of_vectors()
    rows = [("en", g, [float(v) for v in x]) for g, parts in groups.items() for x in np.vstack(parts)]
    df = spark.createDataFrame(rows, "lang string, source string, x array<double>").repartition(5)
    found = {r.source_key: r for r in outliers.cores(outliers._levels(df)).where("level = 0").collect()}
    fits = {r.source_key: r for r in outliers.estimates(df).where("level = 0").collect()}
    assert set(found) == set(fits) == set(groups)
    limit = outliers.chi_square_quantile(0.9999, 6)
    for g, (clean, junk) in groups.items():
        log_det, place, scatter = least_determinant(np.vstack([clean, junk]))
        assert found[g].log_det <= log_det + 0.02
        assert np.allclose(found[g].place, place, atol=0.3 * np.sqrt(np.diag(scatter)).min())
        inverse = np.array(fits[g].inverse).reshape(6, 6)
        far = lambda x: np.einsum("ni,ij,nj->n", x - fits[g].place, inverse, x - fits[g].place) > limit  # noqa: E731, B023
        assert far(clean).mean() < 0.01
        assert far(junk).mean() > (0.85 if g == "all about" else 0.999)


def test_estimate_does_not_depend_on_the_partitions(spark):
    (clean, junk) = groups_of_vectors()["heap"]
    rows = [("en", "a", [float(v) for v in x]) for x in np.vstack([clean, junk])]
    df = spark.createDataFrame(rows, "lang string, source string, x array<double>")
    one, many = (outliers.estimates(d).where("level = 0").first() for d in (df.coalesce(1), df.repartition(7)))
    assert np.allclose(one["place"], many["place"]) and np.allclose(one["inverse"], many["inverse"], rtol=1e-4)


def test_few_rows_have_no_estimate(spark):
    df = spark.createDataFrame([("en", "a", [1.0] * 6)] * 9, "lang string, source string, x array<double>")
    assert outliers.estimates(df).count() == 0
    assert outliers.estimates(df.limit(0)).count() == 0


def test_quantiles():
    assert outliers.chi_square_quantile(0.95, 6) == pytest.approx(12.592, rel=0.01)
    assert outliers.chi_square_cdf(12.592, 6) == pytest.approx(0.95, rel=0.01)


def test_odd_rows_and_empty(spark):
    rows = outliers.judge(cases.odd(spark)).collect()
    assert cases.ids(rows) == cases.EXPECTED_IDS
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    for d, t, *_ in cases.ODD:
        if d in (1, 2, 3, 4, 5, 6, 9):
            assert tuple(by[d][n] for n in outliers._NAMES) == brute(t)
    assert by[1]["kept"] and by[1]["distance"] is None  # too few rows for an estimate
    assert outliers.judge(cases.empty(spark)).count() == 0
