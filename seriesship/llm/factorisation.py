"""Quality scores by a factorisation machine.

A text is a sparse vector: its words, hashed into ``WORDS`` buckets and weighted by their share; statistics of its
structure, each cut into bins of which one is set; and metadata, hashed as name and value. The machine adds to a linear
part the pairwise interaction of all features, with weights of low rank: that of i and j is the product <v_i, v_j> of
two vectors of ``RANK`` numbers. The sum over all pairs is never formed, since

    sum over i < j of <v_i, v_j> x_i x_j  =  1/2 * sum over ranks of ((sum of v x)^2 - sum of v^2 x^2),

so a text costs time in proportion to its features.

The model is fitted on a bounded sample of labelled texts (``SAMPLE`` of each label, those with a small hash). Their
vectors are made where the texts are read; the driver gets vectors of at most ``WORDS`` entries, fits, and sends out a
model of fixed size. Every text is then scored where it is read. The sample has as many good texts as bad ones, so the
bias is put right afterwards by what the labels' whole counts say.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import cut, slices

#: Hash buckets of words, of metadata; bins of a statistic; rank of the interactions.
WORDS, META, BINS, RANK = 1 << 13, 1 << 10, 12, 8
#: Sampled texts of each label.
SAMPLE = 1500
ROUNDS, BATCH, RATE, RIDGE = 12, 64, 0.03, 1e-4
#: Statistics: the value at which the first and the last bin end. Between them bins are equally wide.
STATS = {
    "log2 of the words": (0.0, 13.0),
    "bytes a word": (2.0, 12.0),
    "share of capital letters": (0.0, 0.5),
    "share of digits": (0.0, 0.3),
    "share of ASCII marks": (0.0, 0.3),
    "share of marks that are no punctuation": (0.0, 0.1),
    "share of words like the one before": (0.0, 0.3),
    "share of different words": (0.1, 1.0),
    "words a line (log2)": (0.0, 8.0),
    "share of the most frequent word": (0.0, 0.3),
    "share of bytes that begin or end a line's white space": (0.0, 0.2),
}
_STAT0, _META0 = WORDS, WORDS + BINS * len(STATS)
SIZE = _META0 + META
VECTOR = "label int, at array<int>, x array<float>"


def _classes() -> np.ndarray:
    """By byte: 0 other, 1 blank, 2 capital letter, 3 digit, 4 punctuation, 5 other mark."""
    kind = np.zeros(256, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 1
    kind[65:91] = 2
    kind[48:58] = 3
    for b in range(33, 127):
        if not chr(b).isalnum():
            kind[b] = 4 if chr(b) in ".,;:!?'\"()-" else 5
    return kind


_KIND = _classes()


def _word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of every word; ``data`` are the bytes, words begin at ``starts``."""
    at = np.arange(len(data), dtype=np.uint64)
    with np.errstate(over="ignore"):
        # A byte counts by its place in the word.
        offset = np.zeros(len(data), np.uint64)
        offset[starts] = at[starts] - np.concatenate([at[:1], at[starts[:-1]]])
        inner = at - np.cumsum(offset, dtype=np.uint64)
        mixed = (data.astype(np.uint64) + np.uint64(1)) * ((inner + np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed[_KIND[data] == 1] = 0
        total = np.add.reduceat(mixed, starts) + sizes.astype(np.uint64)
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return total ^ (total >> np.uint64(29))


def vectors(texts: list[bytes | None], metadata: list[list[str | None]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of all features of the texts, by text. ``metadata`` has a list for each text."""
    n = len(texts)
    joined = b"".join([b"\n" + (t or b"") for t in texts])  # a blank in between, so that no word crosses
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, n)
    begins = np.cumsum(lengths) - lengths
    kind = _KIND[data] if n else np.zeros(0, np.uint8)
    inside = kind != 1
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(np.append(inside[1:] < inside[:-1], inside[-1:]))
    sizes = ends - starts + 1
    owner = np.searchsorted(begins, starts, side="right") - 1
    count = np.bincount(owner, minlength=n)
    hashes = _word_hashes(data, starts, sizes) if len(starts) else np.zeros(0, np.uint64)

    # Words of a text by bucket.
    bucket = (hashes % np.uint64(WORDS)).astype(np.int64)
    key, times = np.unique(owner * WORDS + bucket, return_counts=True)
    who, what = key // WORDS, key % WORDS
    weight = np.sqrt(times / np.maximum(count[who], 1))

    def by_text(marks: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return total[begins + lengths] - total[begins]

    words, length = np.maximum(count, 1), np.maximum(lengths - 1, 1)
    like = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])]) if len(hashes) else np.zeros(0, bool)
    # Different words, by their whole hash within the text (buckets are mixed in: 51 bits and the text's number).
    with np.errstate(over="ignore"):
        own = np.sort(hashes ^ ((owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)))
    same = np.append(False, own[1:] == own[:-1])[: len(own)]
    # After sorting a word's text is unknown, so repeats are counted in the order of the words.
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(hashes), bool)
    if len(hashes) and same.any():
        again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    runs = np.flatnonzero(~again)
    run_size, most = np.diff(np.append(runs, len(hashes))), np.zeros(n, np.int64)
    np.maximum.at(most, owner[order][runs], run_size)
    line = data == 10
    edge = line[1:] & (kind[:-1] == 1) | line[:-1] & (kind[1:] == 1) if len(data) else line
    values = [
        np.log2(words),
        np.bincount(owner, sizes, minlength=n) / words,
        by_text(kind == 2) / length,
        by_text(kind == 3) / length,
        by_text(kind >= 4) / length,
        by_text(kind == 5) / length,
        np.bincount(owner[like], minlength=n) / words,
        np.bincount(owner[order][runs], minlength=n) / words,
        np.log2(np.maximum(count / np.maximum(by_text(line), 1), 1)),
        most / words,
        by_text(np.append(edge, False)[: len(data)]) / length,
    ]
    stats = []
    for k, (value, (low, high)) in enumerate(zip(values, STATS.values())):
        bins = np.clip(np.ceil((value - low) / (high - low) * (BINS - 1)), 0, BINS - 1).astype(np.int64)
        stats.append(_STAT0 + k * BINS + bins)
    meta = [[_META0 + zlib.crc32(f"{k}={v}".encode()) % META for k, v in enumerate(row)] for row in metadata]
    sizes_ = np.fromiter(map(len, meta), np.int64, n)
    text = np.concatenate([who, np.tile(np.arange(n), len(stats)), np.repeat(np.arange(n), sizes_)])
    feature = np.concatenate([what, *stats, np.array([f for row in meta for f in row], np.int64)])
    x = np.concatenate([weight, np.ones(n * len(stats) + int(sizes_.sum()))]).astype(np.float32)
    order = np.argsort(text, kind="stable")
    return text[order], feature[order], x[order]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def parts(self, text: np.ndarray, feature: np.ndarray, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The score in log odds of each of ``n`` texts, and its sums of v x by rank."""
        vx = self.factors[feature] * x[:, None]
        first = np.searchsorted(text, np.arange(n))  # every text has statistics, so no stretch is empty
        sums = np.add.reduceat(vx, first, axis=0) if n else np.zeros((0, RANK), np.float32)
        squares = np.add.reduceat((vx * vx).sum(axis=1), first) if n else np.zeros(0)
        linear = np.bincount(text, self.linear[feature] * x, minlength=n)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(texts: Sequence[tuple[int, np.ndarray, np.ndarray]], prior: float) -> Machine:
    """A machine for (label, features, values); ``prior`` is the log odds of label 1 among all labelled texts."""
    rng = np.random.default_rng(13)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, RANK)))
    good = sum(label for label, _, _ in texts)
    if not 0 < good < len(texts):
        m.factors[:] = 0
        m.bias = prior
        return m
    bias_g, linear_g, factor_g = 1e-6, np.full(SIZE, 1e-6), np.full((SIZE, RANK), 1e-6)
    for _ in range(ROUNDS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = [texts[i] for i in order[at : at + BATCH]]
            sizes = [len(f) for _, f, _ in chosen]
            text = np.repeat(np.arange(len(chosen)), sizes)
            feature = np.concatenate([f for _, f, _ in chosen])
            x = np.concatenate([v for _, _, v in chosen])
            score, sums = m.parts(text, feature, x, len(chosen))
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - np.array([label for label, _, _ in chosen])
            error /= len(chosen)
            used, inverse = np.unique(feature, return_inverse=True)
            step = error[text] * x
            linear = np.bincount(inverse, step) + RIDGE * m.linear[used]
            moved = step[:, None] * (sums[text] - m.factors[feature] * x[:, None])
            factor = np.stack([np.bincount(inverse, moved[:, k]) for k in range(RANK)], axis=1) + RIDGE * m.factors[used]
            linear_g[used] += linear * linear
            factor_g[used] += factor * factor
            bias_g += error.sum() ** 2
            m.linear[used] -= RATE * linear / np.sqrt(linear_g[used])
            m.factors[used] -= RATE * factor / np.sqrt(factor_g[used])
            m.bias -= RATE * error.sum() / math.sqrt(bias_g)
    m.bias += prior - math.log(good / (len(texts) - good))
    return m


def _rows(batch: pa.RecordBatch, skip: int) -> tuple[list[bytes | None], list[list[str | None]]]:
    meta = [batch.column(i).to_pylist() for i in range(skip + 1, batch.num_columns)]
    return batch.column(skip).to_pylist(), [list(row) for row in zip(*meta)] if meta else [[] for _ in range(batch.num_rows)]


def _bounded(name: str, kind: str):
    """Metadata as text; of a number the count of binary digits, so that there are few values to learn."""
    c = F.col(f"`{name}`")
    if kind in ("string", "boolean"):
        return c.cast("string").alias(name)
    return F.when(c.isNotNull(), F.floor(F.log2(F.abs(c.cast("double")) + 1)).cast("string")).alias(name)


def train(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = ()) -> Machine:
    """Fits on texts of ``docs`` (doc_id, text, metadata columns) with a ``label`` in ``labels`` (doc_id, label 0 or 1).

    An id whose labels differ or are null is not learned from; of several texts under one id, one is. Without texts of
    both labels the score is the same for all.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("_other")).where("label = _other").select("doc_id", "label")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
    order = F.xxhash64("doc_id")
    sample = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(SAMPLE) for k in (0, 1)]
    chosen = F.broadcast(cut(sample[0].union(sample[1])).withColumnRenamed("doc_id", "_id"))  # 2 * SAMPLE rows of two numbers
    meta = [_bounded(c, docs.schema[c].dataType.simpleString()) for c in metadata]
    own = docs.select("doc_id", F.struct(F.col("text").cast("binary").alias("text"), *meta).alias("own"))
    own = own.join(chosen, own["doc_id"] == chosen["_id"]).groupBy("doc_id", "label")
    own = own.agg(F.min_by("own", F.xxhash64("own")).alias("own")).select("label", "own.*")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            text, feature, x = vectors(*_rows(batch, 1))
            sizes = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(sizes, pa.array(v, t)) for v, t in ((feature, pa.int32()), (x, pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), *lists], ["label", "at", "x"])

    held = own.mapInArrow(made, VECTOR).toArrow()
    rows = zip(*(held.column(c).to_pylist() if c == "label" else held.column(c).combine_chunks() for c in ("label", "at", "x")))
    texts = [(label, f.values.to_numpy(), x.values.to_numpy()) for label, f, x in rows]
    texts.sort(key=lambda t: (t[0], len(t[1]), t[1].tobytes(), t[2].tobytes()))  # tasks may end in any order
    return fit(texts, prior)


def score(docs: DataFrame, machine: Machine, metadata: Sequence[str] = ()) -> DataFrame:
    """(doc_id, score, predicted) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # SIZE * (RANK + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            odds, _ = shared.value.parts(*vectors(*_rows(batch, 1)), batch.num_rows)
            value = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value, pa.float64()), pa.array((value >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    meta = [_bounded(c, docs.schema[c].dataType.simpleString()) for c in metadata]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *meta)
    return own.mapInArrow(run, "doc_id long, score double, predicted int")


def grade(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = ()) -> DataFrame:
    """The probability that a text is good, for each row of ``docs`` (doc_id, text and the metadata columns).

    ``labels`` (doc_id, label 0 or 1) says what is learned from; neither labels nor ids take part in a score. Null and
    empty texts have no words and are scored by the rest. Repeated rows are answered each, null ids too (they are never
    learned from); other columns are ignored. ``predicted`` is 1 from a score of 0.5 on.
    """
    return score(docs, train(docs, labels, metadata), metadata)
