"""Runs of words that repeat with a period, found online along diagonals.

A word and an earlier occurrence of it lie on the diagonal of their distance, the lag. While both move on word by word
and stay equal, the match length of that lag grows; when it stops growing, the stretch under it has the lag as a period.
So for every word its earlier occurrence increments the match length of an active lag, a lag that the word does not
increment has ended, and if it was long enough its run is emitted there and then.

What keeps the diagonals few: a run has at least ``TIMES`` periods, so its match is at least twice its period long. Lags
are dealt into bands, ``[1, 16)``, ``[16, 32)``, ``[32, 64)`` and so on, and an occurrence counts in a band only together
with the words before it, as many as the band's end. Two words that far alike have, by the theorem of Fine and Wilf,
their nearest such occurrence exactly at the smallest period of the run around them. So each band follows one lag at a
time, the nearest, and time is in proportion to the words times the number of bands, also for a text of one word
repeated. Texts in which no 16 words occur twice, most texts, are done after the first band.

All is done where the texts are read; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import slices

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 24, 3
#: Words that an occurrence must share in the first band: the shortest match of any run, 24 - 8 words at period 8.
GRAM = 16
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return key ^ (key >> np.uint64(32))


def _doubled(grams: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``2 * size`` words from those of ``size`` words; the last places stay without meaning."""
    out, n = grams.copy(), max(0, len(grams) - size)
    out[:n] = _mix(grams[:n], grams[size:])
    return out


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key has been seen, ascending, and how far back it was seen last."""
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(twice, key)
    places = np.flatnonzero(twice[np.minimum(at, len(twice) - 1)] == key)
    order = places[np.argsort(key[places], kind="stable")]
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    now, before = order[again + 1], order[again]
    by_place = np.argsort(now)
    return now[by_place], (now - before)[by_place]


def follow(places: list[int], lags: list[int], size: int) -> Iterator[tuple[int, int, int]]:
    """The online pass over one band: (first word, words, period) of every run, as soon as its diagonal ends.

    ``places`` are, ascending, the words at which ``size`` words begin that were seen ``lags`` words earlier.
    """
    active, matched, last = 0, 0, -2
    for place, lag in zip(chain(places, (-2,)), chain(lags, (0,))):
        if lag == active and place == last + 1:
            matched += 1
        else:
            if active and matched + active >= max(LEAST, TIMES * active):
                yield last + size - matched - active, matched + active, active
            active, matched = lag, size
        last = place


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """By text, its runs (start, length, period) by start, then period. ``ids`` are the word numbers of all texts."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(ids)) - np.repeat(first, sizes)
    left = np.repeat(sizes, sizes) - place
    grams = _mix(ids.astype(np.uint64), np.uint64(0xD1B54A32D192ED03))
    size, begin = 1, 1
    while size < GRAM:
        grams, size = _doubled(grams, size), 2 * size
    while True:
        fits = np.flatnonzero(left >= size)
        if not len(fits):
            break
        found, lags = _repeated(_mix(grams[fits], text[fits].astype(np.uint64)))
        if not len(found):
            break
        # The texts that repeat so many words; ``fits`` is dense within a text, so lags stay lags.
        again = np.zeros(len(sizes), bool)
        again[text[fits[found]]] = True
        band = (lags >= begin) & (lags < size)
        where = fits[found[band]]
        for start, length, period in follow(where.tolist(), lags[band].tolist(), size):
            t = int(text[start + period])
            if np.array_equal(ids[start : start + length - period], ids[start + period : start + length]):
                out[t].append((int(place[start + period]) - period, length, period))
        begin = size
        open_ = again[text]
        ids, grams, text, place, left = ids[open_], grams[open_], text[open_], place[open_], left[open_]
        grams, size = _doubled(grams, size), 2 * size
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stand in the first period of every run they belong to."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        words = [t.split() if t else [] for t in batch.column(1).to_pylist()]  # bytes split at ASCII blanks alone
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        runs = find_runs(ids, sizes)
        arrays = [
            batch.column(0),
            pa.array(sizes),
            pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], _RUNS),
            pa.array([b" ".join(_kept(w, r)) for w, r in zip(words, runs)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])


def collapse_runs(df: DataFrame) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): ``n_words``, its periodic ``runs`` and the text ``collapsed``.

    Words are what stands between blanks (space, tab to carriage return), numbered from 0. A run is a stretch with
    smallest period ``period`` that no neighbouring word continues, of ``LEAST`` words and ``TIMES`` periods or more;
    runs come by start, then period. ``collapsed`` has the words that no run repeats, joined by one blank: of each run
    its first period stays, unless another run drops that too. Null, empty and blank texts have no words, no runs and
    an empty collapsed text. Repeated rows are answered each, ids may be null (and are cast to long), other columns are
    ignored. A task holds one text, or 4 MB of texts, with about 40 bytes a word.
    """
    own = df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].cast("binary").alias("text"))
    out = own.mapInArrow(_collapse, SCHEMA)
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
