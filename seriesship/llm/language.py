"""Language identification with a linear-chain conditional random field over words.

A word's features are its affixes and inner character n-grams (hashed) and its entry in a lexicon of words that were
frequent in training. With learned transitions between languages, forward-backward gives every word of a line its
posterior over languages, so a text that switches languages is labelled word by word; the text's language is the one
with the largest share of its words.

The model is fitted on a bounded sample of labelled rows (about ``SAMPLE`` texts of each language, those with a small
hash), on the driver; its size is fixed by ``DIMS``, ``LEXICON`` and the number of languages, so it is broadcast. All
texts are then labelled where they are read; nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import bound_batches, lean, slices

UNKNOWN = "und"
#: Hash buckets for character n-grams, their longest length, lexicon entries for each language.
DIMS, ORDER, LEXICON = 1 << 16, 4, 1000
#: Sampled texts for each language, and languages at most: with more the job ends with an error, since the model's
#: size is in proportion to them.
SAMPLE, LANGUAGES = 200, 250
#: A sequence is a line or, of a longer line, so many words. Word posteriors of so many numbers are worked on at once.
LINE, CELLS = 4096, 1 << 21
#: Training sequences are stitched from runs of one language, so that switches are seen: about this many words a run.
RUN, RUNS = 16, 4
ROUNDS, RATE, RIDGE = 30, 0.3, 1e-3
_GAP = r"[^\p{L}]+"
SCHEMA = "doc_id long, lang_pred string, score double, n_switches long"


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray = field(default=None)
    lexicon: np.ndarray = field(default=None)  # sorted hashes
    entries: np.ndarray = field(default=None)
    moves: np.ndarray = field(default=None)
    first: np.ndarray = field(default=None)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with marks around each, and where each word starts."""
    text = "".join([f"<{w}>" for w in words])
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), np.cumsum(sizes) - sizes


def _features(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams that start at each code point (``DIMS`` if none), word starts, hashes of words."""
    points, starts = _letters(words)
    n = len(points)
    sizes = np.diff(np.append(starts, n))
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # code points to the word's end
    key, out = np.zeros(n, np.uint64), []
    with np.errstate(over="ignore"):
        for k in range(ORDER):
            nxt = np.zeros(n, np.uint64)
            nxt[: n - k] = points[k:]
            key = (key ^ nxt) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            bucket = (key >> np.uint64(7)).astype(np.int64) & (DIMS - 1)
            out.append(np.where(left > k, bucket, DIMS))
        powers = (np.arange(n) - np.repeat(starts, sizes)).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(0x9E3779B97F4A7C15)
        mixed = (points ^ (powers >> np.uint64(17))) * powers
        whole = np.add.reduceat(mixed ^ (mixed >> np.uint64(31)), starts) if n else np.zeros(0, np.uint64)
    return out, starts, whole


def _emissions(m: Model, features) -> np.ndarray:
    grams, starts, whole = features
    out = np.zeros((len(starts), len(m.languages)), np.float32)
    if not len(starts):
        return out
    for bucket in grams:
        out += np.add.reduceat(m.grams[bucket], starts, axis=0)
    return out + m.entries[_entry(m, whole)]


def _entry(m: Model, whole: np.ndarray) -> np.ndarray:
    """Lexicon entry of each word; the last one stands for none."""
    if not len(m.lexicon):
        return np.zeros(len(whole), np.int64)
    at = np.minimum(np.searchsorted(m.lexicon, whole), len(m.lexicon) - 1)
    return np.where(m.lexicon[at] == whole, at, len(m.lexicon))


def forward_backward(m: Model, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of each word, and expected counts of moves, of sequences of ``sizes`` words that follow each other.

    All sequences advance side by side, the longest first, so that those still running are a prefix.
    """
    n, k = scores.shape
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-12 if n else scores
    move, first = np.exp(m.moves), np.exp(m.first)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    start, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
    longest = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(longest), side="left")  # sequences longer than each step
    alpha, beta = np.empty((n, k)), np.ones((n, k))
    for t in range(longest):
        at = start[: running[t]] + t
        a = (alpha[at - 1] @ move if t else first) * e[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    moved = np.zeros((k, k))
    for t in range(longest - 2, -1, -1):
        at = start[: running[t + 1]] + t
        b = e[at + 1] * beta[at + 1]
        back = b @ move.T
        total = (alpha[at] * back).sum(axis=1, keepdims=True)
        moved += (alpha[at] / total).T @ b * move
        beta[at] = back / back.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300), moved


def fit(texts: list[str], labels: list[str], languages: list[str]) -> Model:
    """A model of texts with one label each: gradient steps (AdaGrad) on the likelihood of stitched sequences."""
    k, rng = len(languages), np.random.default_rng(5)
    m = Model(languages, np.zeros((DIMS + 1, k), np.float32), np.zeros(0, np.uint64), np.zeros((1, k), np.float32), np.zeros((k, k)), np.zeros(k))
    number = {lang: i for i, lang in enumerate(languages)}
    runs, counts = [], [Counter() for _ in languages]
    for text, label in zip(texts, labels):
        found = [w for w in pc.split_pattern_regex(pa.scalar(text.lower()), _GAP).as_py() if w]
        counts[number[label]].update(found)
        runs += [(number[label], found[i : i + RUN]) for i in range(0, len(found), RUN)]
    if not runs:
        return m
    runs = [runs[i] for i in rng.permutation(len(runs))]
    place: dict[str, int] = {}
    word = np.array([place.setdefault(w, len(place)) for _, run in runs for w in run])
    gold = np.array([label for label, run in runs for _ in run])
    sizes = np.array([len(run) for _, run in runs])
    sizes = np.add.reduceat(sizes, np.arange(0, len(sizes), RUNS))

    features = _features(list(place))
    frequent = {w for c in counts for w, _ in c.most_common(LEXICON)}
    m.lexicon = np.unique(features[2][np.fromiter((w in frequent for w in place), bool, len(place))])
    m.entries = np.zeros((len(m.lexicon) + 1, k), np.float32)
    entry = _entry(m, features[2])
    lengths = np.diff(np.append(features[1], len(features[0][0])))

    starts = np.cumsum(sizes) - sizes
    true = np.zeros((k, k))
    inside = np.ones(len(word), bool)
    inside[starts] = False
    np.add.at(true, (gold[np.flatnonzero(inside) - 1], gold[inside]), 1)
    opened = np.bincount(gold[starts], minlength=k)
    sums = {name: np.full(np.shape(getattr(m, name)), 1e-8) for name in ("grams", "entries", "moves", "first")}

    def step(name: str, gradient: np.ndarray) -> None:
        gradient = gradient / len(word) - RIDGE / DIMS * getattr(m, name)
        sums[name] += gradient**2
        setattr(m, name, (getattr(m, name) + RATE * gradient / np.sqrt(sums[name])).astype(getattr(m, name).dtype))

    for _ in range(ROUNDS):
        scores = _emissions(m, features)
        posterior, moved = forward_backward(m, scores[word], sizes)
        rest = -posterior
        rest[np.arange(len(gold)), gold] += 1
        by_word = np.column_stack([np.bincount(word, rest[:, j], len(place)) for j in range(k)])
        wide = np.repeat(by_word, lengths, axis=0)
        grams = np.zeros((DIMS + 1, k))
        for bucket in features[0]:
            for j in range(k):
                grams[:, j] += np.bincount(bucket, wide[:, j], DIMS + 1)
        grams[DIMS] = 0
        entries = np.column_stack([np.bincount(entry, by_word[:, j], len(m.entries)) for j in range(k)])
        entries[-1] = 0
        step("grams", grams)
        step("entries", entries)
        step("moves", true - moved)
        step("first", opened - posterior[starts].sum(axis=0))
    return m


def train(labelled: DataFrame) -> Model:
    """Fits on a sample of ``labelled`` (text, lang): rows without language or letters don't count.

    One scan counts the languages, one takes the texts whose hash is under ``SAMPLE`` / count of their language: about
    ``SAMPLE`` each, and never over twice that on the whole. Copies of a text are one.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counted = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if not counted:
        return Model([])
    if len(counted) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    limit = F.create_map(*(F.lit(v) for r in counted for v in (r["lang"], min(1.0, SAMPLE / r["n"]))))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    chosen = rows.where(F.pmod("h", F.lit(1 << 20)) < limit[F.col("lang")] * (1 << 20))
    chosen = chosen.groupBy("lang", "h").agg(F.first("text").alias("text")).orderBy("h", "lang")
    chosen = chosen.limit(2 * SAMPLE * len(counted)).collect()
    return fit([r["text"] for r in chosen], [r["lang"] for r in chosen], sorted(r["lang"] for r in counted))


def label(m: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: the number of its language (-1: no letter or null), that language's share of words, switches."""
    n, k = len(texts), len(m.languages)
    share, switches = np.zeros((n, max(k, 1))), np.zeros(n, np.int64)
    texts = pc.utf8_lower(texts.fill_null(""))
    lines = pc.split_pattern(texts, "\n")
    doc = np.repeat(np.arange(n), np.diff(lines.offsets.to_numpy()))
    words = pc.split_pattern_regex(lines.flatten(), _GAP)
    line = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    words = words.flatten()
    real = pc.binary_length(words).to_numpy() > 0
    words, line = words.filter(pa.array(real)), line[real]
    if len(words) and k:
        coded = words.dictionary_encode()
        emitted, word = _emissions(m, _features(coded.dictionary.to_pylist())), coded.indices.to_numpy()
        # Sequences follow each other, so that blocks of them can be worked on one after another.
        sizes = np.bincount(line, minlength=len(doc))
        place = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        opens = np.flatnonzero(place % LINE == 0)
        sizes, of = np.diff(np.append(opens, len(line))), doc[line]
        block = (opens + sizes - 1) * k // CELLS
        cuts = np.append(opens[np.flatnonzero(np.diff(block, prepend=-1))], len(line)).tolist()
        best = np.empty(len(line), np.int32)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            inside = sizes[np.searchsorted(opens, lo) : np.searchsorted(opens, hi)]
            posterior, _ = forward_backward(m, emitted[word[lo:hi]], inside)
            for j in range(k):
                share[:, j] += np.bincount(of[lo:hi], posterior[:, j], n)
            best[lo:hi] = posterior.argmax(axis=1)
        changed = (best[1:] != best[:-1]) & (of[1:] == of[:-1])
        switches = np.bincount(of[1:][changed], minlength=n)
    total = share.sum(axis=1)
    found = np.where(total > 0, share.argmax(axis=1), -1)
    return found, np.where(total > 0, share.max(axis=1) / np.maximum(total, 1e-300), 0.0), switches


def identify(docs: DataFrame, learn_from: Column) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang): predicted language, its share of the words, switches.

    Only text and language of rows for which ``learn_from`` holds are learned from; predictions see the text alone.
    A text that is null or has no letter, and every text if there was nothing to learn from, is ``und`` with score 0.
    Repeated rows are answered each; ties go to the language that sorts first. Other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs.where(learn_from).select("text", "lang")))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(_labeller(model, None), SCHEMA)


def annotate(docs: DataFrame, model, language: str = "lang_pred", share: str = "score") -> DataFrame:
    """``docs`` with two columns added, of these names; columns that have them are replaced. ``model`` is broadcast."""
    bound_batches(docs.sparkSession)
    docs = docs.drop(language, share)
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_labeller(model, (language, share)), f"{schema}, `{language}` string, `{share}` double")


def _labeller(model, added: tuple[str, str] | None):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in slices(batches, "text", 1 << 20):
            found, score, switches = label(m, batch.column("text"))
            more = [pa.array(names[found], pa.string()), pa.array(score)]
            if added:
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *added])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *more, pa.array(switches)], ["doc_id", "lang_pred", "score", "n_switches"])

    return run
