"""Quality rules: fixed limits, then robust multivariate outliers.

Each text gives a vector of transformed statistics. For every (language, source) the minimum-covariance-determinant
estimate of place and scatter is looked for from four starts: medians and quartile widths, the correlations of
squashed values, those of directions, and the plain mean and covariance. Each start is concentrated, again and again
estimated from the ``SHARE`` of rows nearest by the estimate before, until its determinant falls no more. The group
keeps the start with the least determinant; its estimate is made once more from all rows that it does not call far
(``REWEIGH``). A row goes if its squared Mahalanobis distance is beyond a chi-square quantile.

``FLOOR`` is added to every scatter, so the determinants compared are regularised ones and never zero.

No step gathers a group's rows. A concentration step is one aggregation of sums by (group, start, bin of distance);
the bins, a few hundred whatever the group's size, are then cut at the share, the last one taken in part. A start that
has settled takes no part in later steps. Groups with under ``FEWEST`` rows use their language's estimate or, if that
is small too, that of all rows; with fewer rows still nothing is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import cut, slices, small

#: The statistics, each with the least standard deviation that counts, so that one odd mark in a text is no outlier.
STATS = {"log_words": 0.3, "word_length": 0.3, "symbols": 0.25, "dup_lines": 0.12, "repeats": 0.08, "variety": 0.03}
P = len(STATS)
FLOOR = np.array(list(STATS.values())) ** 2
#: The core of a group, and the quantile of rows that the last estimate is made from.
SHARE = 0.6
REWEIGH = 0.975
FEWEST = 60
#: A start has settled when a step lowers the logarithm of its determinant by no more than this.
SETTLED = 1e-3
#: Steps per unit when medians are read off a grid, and bins of log distance per unit.
GRID, BINS = 100, 12
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_ODD = np.random.default_rng(8).integers(0, 1 << 62, 8, dtype=np.int64) * 2 + 1


def repeated_words(found: list[bytes], size: int = 8) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the text, the first occurrence included."""
    if len(found) <= size:
        return 0
    word = np.fromiter(map(hash, found), np.int64, len(found))
    windows = len(found) - size + 1
    with np.errstate(over="ignore"):
        mixed = word ^ (word >> 29)
        key = sum(mixed[k : k + windows] * _ODD[k] for k in range(size))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(windows, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(found) + 1, np.int64)
    starts = np.flatnonzero(twice)
    cover[starts] += 1
    cover[starts + size] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The counts of one text and, last, how many different words it has; all 0 for null."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    found = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    twice = 0
    for line in text.split("\n"):
        if line in seen:
            twice += 1
        elif line.strip(_BLANKS):
            seen.add(line)
    chars = len(text) - sum(map(text.count, _BLANKS))
    return len(found), chars, sum(map(text.count, _SYMBOLS)), twice, repeated_words(found), len(set(found))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, and the transformed statistics ``x`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = np.array([measure(t) for t in batch.column("text").to_pylist()], np.int64).reshape(-1, 6)
            n, chars, symbols, dup, repeat, kinds = (c.astype(np.float64) for c in rows.T)
            lines = pa.compute.count_substring(batch.column("text"), "\n").fill_null(0).to_numpy(zero_copy_only=False)
            some = np.maximum(n, 1)
            x = np.column_stack(
                [
                    np.log(some),
                    chars / some,
                    np.log1p(100 * symbols / np.maximum(chars, 1)),
                    dup / (lines + 1),
                    repeat / some,
                    np.log(np.maximum(kinds, 1)) / np.log(np.maximum(n, 2)),
                ]
            )
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, P), pa.int32()), pa.array(x.ravel()))
            counts = [pa.array(c) for c in rows.T[:5]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), batch.column("source"), *counts, values],
                ["doc_id", "lang", "source", *_NAMES, "x"],
            )

    narrow = docs.select(*(docs[c].cast(t).alias(c) for c, t in (("doc_id", "long"), ("lang", "string"), ("source", "string"), ("text", "string"))))
    return narrow.mapInArrow(run, f"doc_id long, lang string, source string, {COUNTS}, x array<double>")


def chi_square_quantile(q: float, k: int) -> float:
    """By Wilson and Hilferty's cube."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(q)
    return k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3


def chi_square_cdf(x: float, k: int) -> float:
    from statistics import NormalDist

    return NormalDist().cdf(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))


def _consistency(share: float) -> float:
    """What makes the scatter of the nearest ``share`` of normal rows that of all of them."""
    return share / chi_square_cdf(chi_square_quantile(share, P), P + 2)


def _distance(x: Column, place: Column, inverse: Column) -> Column:
    d = [x[i] - place[i] for i in range(P)]
    return sum(d[i] * d[j] * inverse[i * P + j] for i in range(P) for j in range(P))


_GROUP = ["level", "lang_key", "source_key"]
_KEYS = "level int, lang_key string, source_key string"
_FIT = f"{_KEYS}, start int, n long, place array<double>, inverse array<double>, log_det double, gain double"
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _levels(rows: DataFrame) -> DataFrame:
    """Each row three times: in its language and source, in its language, in all. Null keys count as empty text."""
    lang, source, none = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")), F.lit("")
    keys = [(0, lang, source), (1, lang, none), (2, none, none)]
    keys = F.array(*(F.struct(F.lit(k).alias("level"), a.alias("lang_key"), b.alias("source_key")) for k, a, b in keys))
    return rows.select(F.inline(keys), "x")


def _sums(x: Column) -> list[Column]:
    """Sums of values and of products of two."""
    return [F.sum(x[i]).alias(f"s{i}") for i in range(P)] + [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i, j in _PAIRS]


def _moments(sums: pd.Series, n: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from :func:`_sums`."""
    mean = np.array([sums[f"s{i}"] for i in range(P)]) / n
    cov = np.zeros((P, P))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = sums[f"q{i}_{j}"] / n - mean[i] * mean[j]
    return mean, cov


def _fitted(place: np.ndarray, scatter: np.ndarray) -> dict[str, list]:
    """Columns of an estimate whose scatter has the floor added."""
    scatter = scatter.copy()
    scatter[np.diag_indices(P)] = np.maximum(scatter[np.diag_indices(P)], 0) + FLOOR
    inverse = np.round(np.linalg.inv(scatter), 8).ravel()
    return {"place": [np.round(place, 8).tolist()], "inverse": [inverse.tolist()], "log_det": [float(np.linalg.slogdet(scatter)[1])]}


def _keyed(key: tuple, start: int, n: int, fit: dict[str, list], gain: float = math.inf) -> pd.DataFrame:
    return pd.DataFrame({"level": [key[0]], "lang_key": [key[1]], "source_key": [key[2]], "start": [start], "n": [n], **fit, "gain": [gain]})


def _medians(rows: DataFrame) -> DataFrame:
    """Medians and quartile widths, read off a grid: one row per (group, statistic, grid step) at most."""
    steps = rows.select(*_GROUP, F.posexplode("x").alias("stat", "value"))
    steps = steps.groupBy(*_GROUP, "stat", F.round(F.col("value") * GRID).cast("long").alias("at")).agg(F.count("*").alias("n"))

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        place, width, n = np.zeros(P), np.sqrt(FLOOR), 0
        for stat, part in pdf.sort_values("at").groupby("stat"):
            n, upto = int(part["n"].sum()), part["n"].cumsum().to_numpy()
            low, mid, high = (part["at"].to_numpy()[np.searchsorted(upto, q * n)] / GRID for q in (0.25, 0.5, 0.75))
            place[stat], width[stat] = mid, max(width[stat], (high - low) / 1.349)
        return pd.DataFrame({"level": [key[0]], "lang_key": [key[1]], "source_key": [key[2]], "n": [n], "place": [place.tolist()], "width": [width.tolist()]})

    return steps.groupBy(*_GROUP).applyInPandas(fit, f"{_KEYS}, n long, place array<double>, width array<double>")


def _starts(rows: DataFrame, medians: DataFrame) -> DataFrame:
    """Four estimates of every group to start from, by one aggregation of standardised, squashed and directed values."""
    z = [(F.col("x")[i] - F.col("place")[i]) / F.col("width")[i] for i in range(P)]
    length = F.sqrt(sum(v * v for v in z))
    directed = F.when(length > 0, F.array(*(v / length for v in z))).otherwise(F.array(*[F.lit(0.0)] * P))
    three = F.posexplode(F.array(F.array(*z), F.array(*map(F.tanh, z)), directed)).alias("kind", "y")
    spread = rows.join(medians, _GROUP).select(*_GROUP, "n", "place", "width", three)
    of = [F.any_value(c).alias(c) for c in ("n", "place", "width")]
    summed = spread.groupBy(*_GROUP, "kind").agg(*of, *_sums(F.col("y")))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                key, n = (row["level"], row["lang_key"], row["source_key"]), int(row["n"])
                place, width = np.array(row["place"]), np.array(row["width"])
                mean, cov = _moments(row, n)
                if row["kind"] == 0:
                    yield _keyed(key, 0, n, _fitted(place, np.diag(width**2)))
                    yield _keyed(key, 3, n, _fitted(place + width * mean, cov * np.outer(width, width)))
                else:
                    scale = width / np.sqrt(np.maximum(np.diag(cov), 1e-9))
                    yield _keyed(key, int(row["kind"]), n, _fitted(place, cov * np.outer(scale, scale)))

    return summed.mapInPandas(fit, _FIT)


def _concentrate(rows: DataFrame, fits: DataFrame, first: bool) -> DataFrame:
    """One concentration step of all ``fits``; where the determinant does not fall, the estimate before stays."""
    d2 = _distance(F.col("x"), F.col("place"), F.col("inverse"))
    far = F.floor(F.log(F.greatest(d2, F.lit(1e-6))) * BINS).cast("long").alias("bin")
    far = rows.join(fits, _GROUP).select(*_GROUP, "start", "x", "place", "inverse", "log_det", far)
    before = [F.any_value(c).alias(c) for c in ("place", "inverse", "log_det")]
    binned = far.groupBy(*_GROUP, "start", "bin").agg(F.count("*").alias("n"), *before, *_sums(F.col("x")))
    factor = _consistency(SHARE)
    sums = [f"s{i}" for i in range(P)] + [f"q{i}_{j}" for i, j in _PAIRS]

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy()
        core = SHARE * n.sum()
        taken = np.clip((core - (np.cumsum(n) - n)) / n, 0, 1)
        mean, cov = _moments(pdf[sums].mul(taken, axis=0).sum(), core)
        new = _fitted(mean, cov * factor)
        old = {c: [pdf[c].iloc[0]] for c in ("place", "inverse", "log_det")}
        gain = math.inf if first else old["log_det"][0] - new["log_det"][0]
        return _keyed(key, key[3], int(n.sum()), new if gain > 0 else old, gain)

    return binned.groupBy(*_GROUP, "start").applyInPandas(fit, _FIT)


def _reweigh(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """The estimate from all rows that ``fits`` does not call far."""
    near = _distance(F.col("x"), F.col("place"), F.col("inverse")) <= chi_square_quantile(REWEIGH, P)
    near = rows.join(fits, _GROUP).where(near)
    of = [F.any_value(c).alias(c) for c in ("start", "n")]
    summed = near.groupBy(*_GROUP).agg(*of, F.count("*").alias("m"), *_sums(F.col("x")))
    factor = _consistency(REWEIGH)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                mean, cov = _moments(row, row["m"])
                yield _keyed((row["level"], row["lang_key"], row["source_key"]), row["start"], int(row["n"]), _fitted(mean, cov * factor), 0.0)

    return summed.mapInPandas(fit, _FIT)


def cores(rows: DataFrame) -> DataFrame:
    """For every group of :func:`_levels` rows with ``FEWEST`` or more: the settled start of least determinant.

    Every step but the first lowers some determinant by over ``SETTLED`` or is the last, so the steps come to an end.
    """
    medians = cut(_medians(rows).where(F.col("n") >= FEWEST))
    groups = medians.count()
    fits = cut(_starts(rows, small(medians, groups, 600)))
    settled = []
    moving, first = 4 * groups, True
    while moving:
        fits = cut(_concentrate(rows, small(fits.where(F.col("gain") > SETTLED), moving, 600), first))
        settled.append(fits.where(F.col("gain") <= SETTLED))
        moving, first = fits.where(F.col("gain") > SETTLED).count(), False
    if not settled:
        return fits
    ended = reduce(DataFrame.unionByName, settled)
    whole = F.struct("start", "n", "place", "inverse", "log_det", "gain")
    return cut(ended.groupBy(*_GROUP).agg(F.min_by(whole, F.struct("log_det", "start")).alias("fit")).select(*_GROUP, "fit.*"))


def estimates(rows: DataFrame) -> DataFrame:
    """Place and inverse scatter of every group of ``rows`` (lang, source, x) with ``FEWEST`` rows or more."""
    rows = _levels(rows)
    best = cores(rows)
    groups = best.count()
    return small(cut(_reweigh(rows, small(best, groups, 600))), groups, 600)


def judge(docs: DataFrame, quantile: float = 0.9999) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang, source): counts, base rule, squared distance, verdict.

    ``base_failed``: under 20 words, or over 30 % of them in repeated windows. The others are kept unless they lie
    beyond the ``quantile`` of the chi-square distribution; with no estimate to go by (too few rows anywhere) they are
    kept and the distance is null. A null text counts as empty. Null language or source is a group of its own, shared
    with the empty text. Repeated rows count and are judged each; no rows give no rows; other columns are ignored.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = cut(statistics(docs).withColumn("base_failed", failed))
    fits = estimates(measured.where(~F.col("base_failed")).select("lang", "source", "x"))
    lang, source = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    out = measured.select("*", lang.alias("_lang"), source.alias("_source"))
    overall = fits.where(F.col("level") == 2).select("place", "inverse").first()
    last = F.lit(None).cast("struct<place:array<double>,inverse:array<double>>")
    if overall:
        last = F.struct(*(F.array(*map(F.lit, overall[k])).alias(k) for k in ("place", "inverse")))
    for level, keys in enumerate((["_lang", "_source"], ["_lang"])):
        own = fits.where(F.col("level") == level).select(F.col("lang_key").alias("_lang"), F.col("source_key").alias("_source"), F.struct("place", "inverse").alias(f"_f{level}"))
        out = out.join(own.select(*keys, f"_f{level}"), keys, "left")
    out = out.withColumn("_fit", F.coalesce("_f0", "_f1", last))
    d2 = F.when(~F.col("base_failed"), _distance(F.col("x"), F.col("_fit.place"), F.col("_fit.inverse")))
    limit = chi_square_quantile(quantile, P)
    return out.select(
        "doc_id", *_NAMES, "base_failed", "lang", "source", d2.alias("distance"),
        (~F.col("base_failed") & ~F.coalesce(d2 > limit, F.lit(False))).alias("kept"),
    )
