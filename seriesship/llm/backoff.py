"""Scoring texts with a weighted backoff automaton.

The model has word n-grams up to order 3. Its base is the smoothed unigram (c + 0.1) / (N + 0.1 (V + 1)) over all
training tokens; higher orders are discounted by 0.75 and back off with weights that make every distribution sum to 1.
As an automaton: each context is a state; an arc leads over a word to the longest context that follows, and a failure
arc leads to the context one word shorter.

All words can stand in n-grams and every n-gram seen ``LEAST`` times is kept, so the model grows with the corpus and is
never in one place. Texts become numbers of words once, in blocks of some MB. Every block sends its distinct pairs, and
then the triples whose two pairs are kept, to buckets; a bucket adds up the counts of all blocks, works out the
backoff weights of its contexts, and answers each block for the arcs that it asked for. From the answers the block
puts together the part of the automaton that its texts can enter, and reads them through it. Contexts that alone would fill a
bucket are spread over all, and their few sums are broadcast. Words are numbered by falling count, so a table of
the distinct counts (at most sqrt(2 N) of them) tells the count of any word.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import cut, lean, shuffles_end_with_queries, slices

#: The end of a text, counted as a token. No word holds white space.
END = b"\n"
DISCOUNT = 0.75
SMOOTH = 0.1
#: n-grams seen so often are kept, whatever the size of the corpus.
LEAST = 2
SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all words in turn, A-Z lower-cased; only ASCII letters and white space count."""
    text = pa.compute.ascii_trim_whitespace(pa.compute.ascii_lower(texts.fill_null(b"").view(pa.string())))
    found = pa.compute.ascii_split_whitespace(text)
    sizes = pa.compute.list_value_length(found).to_numpy().astype(np.int64)
    flat, none = found.flatten(), pa.compute.equal(text, "")
    return np.where(none.to_numpy(zero_copy_only=False), 0, sizes), flat.filter(pa.compute.not_equal(flat, "")).view(pa.binary())


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of whole numbers from 0 on, sorted, and the place of each among them. ``key`` is overwritten.

    Where both fit in 64 bits, number and place are sorted as one number, which is several times faster than an argsort.
    """
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 63:
        return np.unique(key, return_inverse=True)
    key <<= bits
    key |= np.arange(len(key))
    key.sort()
    place = key & ((1 << bits) - 1)
    key >>= bits
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    found = key[new]
    np.cumsum(new, out=key)
    key -= 1
    inverse = np.empty(len(key), np.int64)
    inverse[place] = key
    return found, inverse


@dataclass
class Automaton:
    """The arcs that one block can take. States are contexts: 0 the empty one, 1 + i the block's i-th word, then the kept
    pairs of words that the block goes on from. ``arcs`` are state * width + word, sorted."""

    width: int
    arcs: np.ndarray
    log_p: np.ndarray
    next: np.ndarray
    fail: np.ndarray
    back: np.ndarray

    def __post_init__(self) -> None:
        # An open table of the arcs by hash: the first free slot from that of the hash on.
        self.bits = (2 * len(self.arcs)).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(self.arcs), dtype=np.int32), self._slot(self.arcs)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            on = self.slots[at] != todo
            todo, at = todo[on], (at[on] + 1) & (len(self.slots) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _arc(self, key: np.ndarray) -> np.ndarray:
        """The number of the arc state * width + word, -1 if there is none."""
        slot = self._slot(key)
        at = self.slots[slot]
        wrong = np.flatnonzero((self.arcs[at] != key) & (at >= 0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & (len(self.slots) - 1)
            at[wrong] = self.slots[slot[wrong]]
            wrong = wrong[(self.arcs[at[wrong]] != key[wrong]) & (at[wrong] >= 0)]
        return at

    @property
    def start(self) -> int:
        return self.width  # the last word stands for the start of a text

    def traverse(self, word: np.ndarray, base: np.ndarray, first: np.ndarray, sizes: np.ndarray, most: int = 64) -> np.ndarray:
        """log10 of the probability of each text: ``sizes[k]`` tokens from ``first[k]`` on, read from left to right.

        ``word`` has the block's own word numbers, ``base`` the unigram log-probabilities. Texts are read side by side.
        One of over ``most`` tokens is read in pieces: a state tells no more than two words, so a piece that starts two
        words early, from the empty context, is in the text's own state when its first token comes.
        """
        pieces = np.maximum(-(-sizes // most), 1)
        text = np.repeat(np.arange(len(sizes)), pieces)
        skip = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * most
        early = np.where(skip > 0, 2, 0)
        begin, length = first[text] + skip - early, np.minimum(sizes[text] - skip, most) + early
        state, total = np.where(skip > 0, 0, self.start), np.zeros(len(text))
        order = np.argsort(-length, kind="stable")
        begin, early, length, state = begin[order], early[order], length[order], state[order]
        running = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), "left")
        for step, n in enumerate(running.tolist()):
            at = begin[:n] + step
            gained = self._follow(state[:n], word[at], base[at])
            total[:n] += gained if step > 1 else np.where(early[:n] > step, 0.0, gained)
        return np.bincount(text[order], total, len(sizes))

    def _follow(self, state: np.ndarray, word: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Takes each state over its word, in place; failure arcs are followed until an arc or the empty context."""
        gained = np.zeros(len(state))
        todo, s, w = np.arange(len(state)), state.copy(), word
        while len(todo):
            at = self._arc(s * self.width + w)
            hit = np.flatnonzero(at >= 0)
            done, at_hit = todo[hit], at[hit]
            gained[done] += self.log_p[at_hit]
            state[done] = self.next[at_hit]
            done = todo[(at < 0) & (s == 0)]
            gained[done] += base[done]
            state[done] = 1 + word[done]
            on = np.flatnonzero((at < 0) & (s != 0))
            todo, s, w = todo[on], s[on], w[on]
            gained[todo] += self.back[s]
            s = self.fail[s]
        return gained


def _backed(taken: np.ndarray, lower: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """log10 of backoff weights: what a context's arcs leave, over what the shorter context gives the other words."""
    back = np.maximum((1 - taken / seen) / np.maximum(1 - lower, 1e-12), 1e-12)
    return np.log10(np.where(taken > 0, back, 1.0))


def automaton(base: Base, words: np.ndarray, two: Asked, told2: tuple, three: Asked, told3: tuple) -> Automaton:
    """From the answers to a block's questions. ``words`` are the ids in the block, sorted, and the start's as the last."""
    width, n = len(words), base.count(words)
    (n2, sums2), (n3, sums3) = told2, told3
    heads = three.contexts  # all of them kept pairs
    seen = n2[heads]

    back = np.zeros(1 + width + len(heads))
    (arcs2, counts2, low2), (arcs3, counts3, low3) = sums2, sums3
    lower2 = (low2 + SMOOTH * arcs2) / (base.tokens + SMOOTH * (base.distinct + 1))
    lower3 = (low3 - DISCOUNT * arcs3) / np.maximum(n[two.last[heads]], 1)
    back[1 : 1 + width] = _backed(counts2 - DISCOUNT * arcs2, lower2, np.maximum(n, 1))
    back[1 + width :] = _backed(counts3 - DISCOUNT * arcs3, lower3, seen)
    fail = np.concatenate([np.zeros(1 + width, np.int64), 1 + two.last[heads]])

    # An arc leads to the pair that its last two words make, if the block goes on from it, else to its last word.
    state = 1 + two.last.astype(np.int64)
    state[heads] = 1 + width + np.arange(len(heads))
    k2, k3 = np.flatnonzero(n2), np.flatnonzero(n3)
    u, h = two.of[k2].astype(np.int64), three.of[k3].astype(np.int64)
    arcs = np.concatenate([(1 + u) * width + two.last[k2], (1 + width + h) * width + three.last[k3]])
    if not len(arcs):
        return Automaton(width, np.array([-1]), np.zeros(1), np.zeros(1, np.int64), fail, back)
    p = np.concatenate([(n2[k2] - DISCOUNT) / n[u], (n3[k3] - DISCOUNT) / seen[h]])
    return Automaton(width, arcs, np.log10(p), np.concatenate([state[k2], state[three.pair[k3]]]), fail, back)


def pack(a: np.ndarray) -> bytes:
    """Numbers, compressed, their bytes of equal weight side by side."""
    if a.dtype.kind == "i" and (not len(a) or (a.max() < 1 << 31 and a.min() >= -(1 << 31))):
        a = a.astype(np.int32)
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return a.dtype.char.encode() + struct.pack("<q", len(a)) + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:1].decode()), struct.unpack("<q", b[1:9])[0]
    raw = pa.decompress(b[9:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    a = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(n)
    return a.astype(np.int64) if kind.kind == "i" else a


def _packed(x: bytes) -> bytes:
    return struct.pack("<q", len(x)) + pa.compress(x, codec="zstd", asbytes=True)


def _unpacked(b: bytes) -> bytes:
    return pa.decompress(b[8:], decompressed_size=struct.unpack("<q", b[:8])[0], codec="zstd", asbytes=True)


@dataclass
class Base:
    """Unigrams. Word ids go by falling count; ``n[i]`` is the count of ids from ``first[i]`` on. The id after the last
    stands for the start of a text, and as a predicted word, which it never is, for any word without an arc."""

    first: np.ndarray
    n: np.ndarray
    tokens: int
    distinct: int
    texts: int
    words: int  #: smaller ids may stand in n-grams
    least: int
    buckets: int
    heavy: int  #: contexts seen more often are spread over the buckets

    @property
    def start(self) -> int:
        return self.distinct

    @property
    def width(self) -> int:
        return self.distinct + 1

    def count(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.first):
            return np.where(ids == self.start, self.texts, 0)
        n = self.n[np.maximum(np.searchsorted(self.first, ids, "right") - 1, 0)]
        return np.where(ids < 0, 0, np.where(ids == self.start, self.texts, n))

    def unigram(self, ids: np.ndarray) -> np.ndarray:
        return (self.count(ids) + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1))


def _mixed(key: np.ndarray) -> np.ndarray:
    x = key.astype(np.uint64)
    for by, shift in ((0xBF58476D1CE4E5B9, 30), (0x94D049BB133111EB, 27)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class Asked:
    """The distinct (context, word) of a block at one order, sorted, the place of each token among them, and their buckets.

    ``contexts`` are the block's own words or, at order 3, pairs; ``of`` and ``last`` tell context and word of each in the
    block's numbers, ``head`` and ``word`` in ids. ``pair`` is the pair of the last two words, where that is kept. A block's
    own numbers are under 2^31, as a text's bytes are, and are held in 32 bits.
    """

    def __init__(
        self, base: Base, contexts: np.ndarray, heads: np.ndarray, words: np.ndarray, of: np.ndarray, last: np.ndarray,
        inverse: np.ndarray, seen: np.ndarray, pair: np.ndarray | None = None,
    ) -> None:
        """``heads`` has the id of each context, ``seen`` how often it occurs, ``words`` the id of each word."""
        self.contexts, self.heads, self.words, self.pair = contexts, heads, words, pair
        self.of, self.last, self.inverse = (x.astype(np.int32) for x in (of, last, inverse))
        n, mixed = np.uint64(base.buckets), _mixed(heads)
        bucket, far = (mixed % n)[of], np.flatnonzero((seen > base.heavy)[of])
        bucket[far] = _mixed(mixed[of[far]] + words[last[far]].astype(np.uint64)) % n + n
        bucket = bucket.astype(np.uint16 if base.buckets < 1 << 15 else np.int64)  # short numbers are sorted faster
        order = np.argsort(bucket, kind="stable").astype(np.int32)
        first = np.flatnonzero(np.append(True, np.diff(bucket := bucket[order]) != 0)) if len(order) else np.zeros(0, np.int64)
        self.parts = {int(bucket[i]): order[i:j] for i, j in zip(first, np.append(first[1:], len(bucket)))}
        self.far = order[np.searchsorted(bucket, base.buckets) :]

    @property
    def head(self) -> np.ndarray:
        return self.heads[self.of]

    @property
    def word(self) -> np.ndarray:
        return self.words[self.last]

    def rows(self, block: int, count: np.ndarray, lower: np.ndarray | None = None) -> pa.Table:
        """What goes to the buckets."""
        out: list[tuple] = []
        for b, at in self.parts.items():
            low = None if lower is None else pack(lower[at])
            head, word = self.heads[self.of[at]], self.words[self.last[at]]
            out.append((b, block, pack(np.diff(head, prepend=0)), pack(word), pack(count[at]), low))
        return pa.table([pa.array(list(c), t.type) for c, t in zip(list(zip(*out)) or [()] * 6, _ASK)], schema=_ASK)

    def kept(self, answers: pa.Table) -> np.ndarray:
        """For each (context, word) its count if kept, else 0."""
        n = np.zeros(len(self.of), np.int64)
        for b, x in zip(*(answers.column(c).to_pylist() for c in ("bucket", "n"))):
            n[self.parts[b]] = unpack(x)
        return n

    def sums(self, base: Base, answers: pa.Table, spread: tuple) -> np.ndarray:
        """The three sums of each context; 0 where nothing is asked about it."""
        sums = np.zeros((3, len(self.contexts)), np.int64)
        for b, *own in zip(*(answers.column(c).to_pylist() for c in ("bucket", *SUMS))):
            if b < base.buckets:
                of = self.of[self.parts[b]]
                of = of[np.diff(of, prepend=-1) != 0]
                for x, y in zip(sums, own):
                    x[of] = unpack(y)
        if len(self.far):
            far = np.unique(self.of[self.far])
            sums[:, far] = spread[1][np.searchsorted(spread[0], self.heads[far])].T
        return sums


_ASK = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("head", pa.binary()), ("word", pa.binary()), ("count", pa.binary()), ("low", pa.binary())])
#: Of a context, whole numbers: its kept arcs, their counts, and the counts of the same words after the shorter context.
SUMS = ("arcs", "counts", "lower")
_ANSWER = pa.schema(
    [("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.binary()), *((c, pa.binary()) for c in SUMS)]
    + [("head", pa.int64()), *((f"sum_{c}", pa.int64()) for c in SUMS)]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def answered(asks: DataFrame, shared, order: int) -> DataFrame:
    """The buckets' answers, and the parts of the sums of spread contexts (without a block)."""

    @lean
    def run(here: pa.Table) -> pa.Table:
        base: Base = shared.value
        bucket = here.column("bucket")[0].as_py()
        blocks = here.column("block").to_pylist()
        parts = [np.cumsum(unpack(x)) for x in here.column("head").to_pylist()]
        sizes = [len(x) for x in parts]
        word = np.concatenate([unpack(x) for x in here.column("word").to_pylist()])
        count = np.concatenate([unpack(x) for x in here.column("count").to_pylist()])
        heads, of = distinct(np.concatenate(parts))
        del parts
        grams, place = distinct(of * base.width + word)
        n = np.bincount(place, count, len(grams)).astype(np.int64)
        n[n < base.least] = 0
        head = grams // base.width
        if order == 2:
            low = base.count(grams % base.width)
        else:
            low = np.zeros(len(grams), np.int64)
            low[place] = np.concatenate([unpack(x) for x in here.column("low").to_pylist()])
        kept = n > 0
        sums = [np.bincount(head, np.where(kept, x, 0), len(heads)).astype(np.int64) for x in (kept, n, low)]
        spread, out, i = bucket >= base.buckets, [], 0
        for block, size in zip(blocks, sizes):
            at = of[i : i + size]
            own = at[np.diff(at, prepend=-1) != 0]
            out.append((block, bucket, pack(n[place[i : i + size]]), *(None if spread else pack(x[own]) for x in sums), *[None] * 4))
            i += size
        if spread:
            out += [(None, bucket, *[None] * 4, *x) for x in zip(heads.tolist(), *(x.tolist() for x in sums))]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return cut(asks.groupBy("bucket").applyInArrow(run, _ddl(_ANSWER)))


def spread_sums(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Spread contexts, of which there are fewer than a few times the buckets, and their sums by column."""
    sums = answers.where(F.col("block").isNull()).groupBy("head").agg(*(F.sum(f"sum_{c}").alias(c) for c in SUMS))
    found = sums.toArrow().sort_by("head")
    return found.column("head").to_numpy(), np.column_stack([found.column(c).to_numpy() for c in SUMS])


@dataclass
class Block:
    """Texts one after another with their ends, as the block's own numbers of words. ``words`` are the ids, sorted (-1:
    unknown), with the start's as the last."""

    words: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    trained: np.ndarray

    def __post_init__(self) -> None:
        self.tokens = self.tokens.astype(np.int32)
        self.first = np.cumsum(self.sizes) - self.sizes

    def pairs(self, base: Base) -> tuple[Asked, np.ndarray]:
        """What is asked about pairs, and the tokens (by number) that have a context."""
        width, n = len(self.words), base.count(self.words)
        start, known = width - 1, n >= base.least
        known[:start] &= self.words[:start] < base.words
        before = np.roll(self.tokens, 1)
        before[self.first] = start
        at = np.flatnonzero(known[before])
        key = before[at].astype(np.int64)
        del before
        key *= width
        key += np.where(known, np.arange(width), start)[self.tokens[at]]
        grams, inverse = distinct(key)
        del key
        return Asked(base, np.arange(width), self.words, self.words, *np.divmod(grams, width), inverse, n), at.astype(np.int32)

    def triples(self, base: Base, two: Asked, at: np.ndarray, n: np.ndarray) -> tuple[Asked, np.ndarray, np.ndarray]:
        """What is asked about triples, the tokens that have a kept pair for context, and the count of that pair."""
        width = len(self.words)
        pair = np.full(len(self.tokens), -1, np.int32)
        pair[at] = two.inverse
        follows = np.zeros(len(self.tokens), bool)
        follows[at] = n[two.inverse] > 0
        follows = np.roll(follows, 1)
        follows[self.first] = False
        at3 = np.flatnonzero(follows)
        before, pair = pair[at3 - 1], pair[at3]
        here = np.where(pair >= 0, n[pair], 0)
        used = np.zeros(len(n), bool)
        used[before] = True
        heads, place = np.flatnonzero(used), np.cumsum(used) - 1
        key = place[before]
        key *= width
        key += np.where(here > 0, self.tokens[at3], width - 1)
        del place, before
        grams, inverse = distinct(key)
        del key
        low, ends = np.zeros(len(grams), np.int64), np.full(len(grams), -1, np.int32)
        low[inverse], ends[inverse] = here, pair
        ids = self.words[two.of[heads]] * base.width + self.words[two.last[heads]]
        asked = Asked(base, heads, ids, self.words, *np.divmod(grams, width), inverse, n[heads], ends)
        return asked, at3.astype(np.int32), low

    def times(self, base: Base, asked: Asked, at: np.ndarray) -> np.ndarray:
        """How often each of ``asked`` stands in training texts."""
        n = np.bincount(asked.inverse, np.repeat(self.trained, self.sizes)[at], len(asked.of)).astype(np.int64)
        n[asked.last == len(self.words) - 1] = 0
        return n

    def unigrams(self, base: Base) -> np.ndarray:
        """log10 of the base's probability of every token."""
        return np.log10(base.unigram(self.words))[self.tokens]

    def score(self, base: Base, two: Asked, told2: tuple, three: Asked, told3: tuple) -> np.ndarray:
        """log10 of the probability of every text."""
        model = automaton(base, self.words, two, told2, three, told3)
        return model.traverse(self.tokens, self.unigrams(base), self.first, self.sizes)


_BLOCK = "block long, doc_id array<long>, held_out array<boolean>, sizes binary, tokens binary"


def read_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Texts by block, as places in the block's own list of words (the end comes first), with the words' counts."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names = ["block", "doc_id", "held_out", "sizes", "tokens", "words", "n"]
        held: list[pa.RecordBatch] = []
        size = 0

        def one() -> pa.RecordBatch:
            here = pa.Table.from_batches(held)
            sizes, found = words(here.column("text").combine_chunks())
            found, sizes = found.dictionary_encode(), sizes + 1
            tokens = np.ones(int(sizes.sum()), np.int64)
            tokens[np.cumsum(sizes) - 1] = 0
            tokens[tokens > 0] += found.indices.to_numpy()
            trained = np.array([x is False for x in here.column("held_out").to_pylist()], np.float64)
            n = np.bincount(tokens, np.repeat(trained, sizes), 1 + len(found.dictionary)).astype(np.int64)
            ids, out = [here.column(c).to_pylist() for c in ("doc_id", "held_out")], b" ".join(found.dictionary.to_pylist())
            data = [pa.array([number]), pa.array([ids[0]], pa.list_(pa.int64())), pa.array([ids[1]], pa.list_(pa.bool_()))]
            return pa.record_batch([*data, *(pa.array([x], pa.binary()) for x in (pack(sizes), pack(tokens), _packed(out), pack(n)))], names)

        for batch in slices(batches, "text", block_bytes):
            more = batch.get_total_buffer_size() if batch.num_rows == 1 else pa.compute.sum(pa.compute.binary_length(batch.column("text"))).as_py() or 0
            more += 100 * batch.num_rows
            if held and size + more > block_bytes:
                yield one()
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += more
        if held:
            yield one()

    return cut(docs.mapInArrow(run, f"{_BLOCK}, words binary, n binary"))


def words_of(blocks: DataFrame) -> DataFrame:
    """(block, place, word, n) of the distinct words of each block; n counts training texts."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, found, n in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "n"))):
                found = [END, *_unpacked(found).split()]
                data = [pa.array(np.full(len(found), block)), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found, pa.binary()), pa.array(unpack(n))]
                yield pa.record_batch(data, ["block", "place", "word", "n"])

    return blocks.select("block", "words", "n").mapInArrow(run, "block long, place int, word binary, n long")


def numbered(asked: DataFrame) -> DataFrame:
    """(word, n, id) of all training words; ids go by falling count and leave no gap."""
    counts = cut(asked.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0").orderBy(F.desc("n"), "word"))
    part = F.spark_partition_id()
    sizes = dict(counts.groupBy(part.alias("part")).count().collect())
    starts = [0]
    for k in range(max(sizes, default=0)):
        starts.append(starts[-1] + sizes.get(k, 0))
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return counts.select("word", "n", (inside + F.get(F.lit(starts), part)).alias("id"))


def score(
    docs: DataFrame,
    held_out: Column,
    *,
    word_share: float = 0.0,
    gram_share: float = 0.0,
    block_bytes: int = 8 << 20,
    bucket_tokens: int = 1 << 20,
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text), with scores by a model of the rows that are not held out.

    A null text counts as empty: its end is its only token. Rows that repeat count and are scored each. With no
    training rows every token is unknown. No rows give no rows. Other columns are ignored. For smaller models,
    ``word_share`` and ``gram_share`` leave out n-grams: words, and n-grams, below that share of all tokens.
    """
    with shuffles_end_with_queries(docs.sparkSession):
        return _score(docs, held_out, word_share, gram_share, block_bytes, bucket_tokens)


def _score(docs: DataFrame, held_out: Column, word_share: float, gram_share: float, block_bytes: int, bucket_tokens: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out.alias("held_out"), docs["text"].cast("binary").alias("text"))
    read = read_blocks(docs, block_bytes)
    asked = words_of(read)
    counts = numbered(asked)
    of = counts.groupBy("n").agg(F.count("*").alias("words"), F.max(F.when(F.col("word") == F.lit(END), F.col("n"))).alias("texts")).toArrow()
    of = of.sort_by([("n", "descending")])
    n, many = of.column("n").to_numpy().astype(np.int64), of.column("words").to_numpy().astype(np.int64)
    tokens, distinct = int((n * many).sum()), int(many.sum())
    if (distinct + 1) ** 2 >= 1 << 63:
        raise OverflowError(f"{distinct} different words: pairs of them do not fit 64 bits")
    texts = next((x for x in of.column("texts").to_pylist() if x), 0)
    often = int(many[n >= max(1.0, word_share * tokens)].sum())
    least = max(LEAST, math.ceil(gram_share * tokens))
    buckets = max(1, math.ceil(tokens / bucket_tokens))
    base = Base(np.cumsum(many) - many, n, tokens, distinct, texts, often, least, buckets, max(1, bucket_tokens // 4))
    shared = spark.sparkContext.broadcast(base)

    @lean
    def number(here: pa.Table, known: pa.Table) -> pa.Table:
        ids = np.empty(known.num_rows, np.int64)
        ids[known.column("place").to_numpy()] = known.column("id").to_numpy()
        found, own = np.unique(ids, return_inverse=True)
        tokens, found = own[unpack(here.column("tokens")[0].as_py())], np.diff(found, prepend=0)
        here = here.set_column(here.schema.get_field_index("tokens"), "tokens", pa.array([pack(tokens)], pa.binary()))
        return here.append_column("words", pa.array([pack(found)], pa.binary()))

    known = asked.select("block", "place", "word").join(counts.select("word", "id"), "word", "left")
    known = known.select("block", "place", F.coalesce("id", F.lit(-1)).alias("id"))
    blocks = read.select("block", "doc_id", "held_out", "sizes", "tokens")
    blocks = cut(blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(number, f"{_BLOCK}, words binary"))

    def block_of(here) -> Block:
        trained = np.array([x is False for x in here.column("held_out")[0].as_py()], np.float64)
        found, tokens, sizes = (unpack(here.column(c)[0].as_py()) for c in ("words", "tokens", "sizes"))
        return Block(np.append(np.cumsum(found), shared.value.start), tokens, sizes, trained)

    @lean
    def ask_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.slice(i, 1)
                block = block_of(here)
                two, at = block.pairs(shared.value)
                yield from two.rows(here.column("block")[0].as_py(), block.times(shared.value, two, at)).to_batches(1024)

    pairs = answered(blocks.mapInArrow(ask_pairs, _ddl(_ASK)), shared, 2)
    spread2 = spark.sparkContext.broadcast(spread_sums(pairs))
    pairs = pairs.where(F.col("block").isNotNull()).select("block", F.lit(2).alias("size"), "bucket", "n", *SUMS)

    @lean
    def ask_triples(here: pa.Table, told: pa.Table) -> pa.Table:
        m, block = shared.value, block_of(here)
        two, at = block.pairs(m)
        three, at3, low = block.triples(m, two, at, two.kept(told))
        return three.rows(here.column("block")[0].as_py(), block.times(m, three, at3), low)

    asks = blocks.groupBy("block").cogroup(pairs.select("block", "bucket", "n").groupBy("block")).applyInArrow(ask_triples, _ddl(_ASK))
    triples = answered(asks, shared, 3)
    spread3 = spark.sparkContext.broadcast(spread_sums(triples))
    triples = triples.where(F.col("block").isNotNull()).select("block", F.lit(3).alias("size"), "bucket", "n", *SUMS)

    @lean
    def answer(here: pa.Table, told: pa.Table) -> pa.Table:
        m, block = shared.value, block_of(here)
        sums = [np.add.reduceat((block.words >= 0).astype(np.int64)[block.tokens], block.first)]
        sums.append(np.add.reduceat(block.unigrams(m), block.first))
        size = told.column("size").to_numpy()
        answers = told.filter(pa.array(size == 2))
        two, at = block.pairs(m)
        told2 = two.kept(answers), two.sums(m, answers, spread2.value)
        three = block.triples(m, two, at, told2[0])[0]
        answers = told.filter(pa.array(size == 3))
        told3 = three.kept(answers), three.sums(m, answers, spread3.value)
        del at, answers
        sums.append(block.score(m, two, told2, three, told3))
        return pa.table(
            [
                pa.array(here.column("doc_id")[0].as_py(), pa.int64()),
                pa.array(here.column("held_out")[0].as_py(), pa.bool_()),
                pa.array(block.sizes),
                pa.array(sums[0]),
                pa.array(np.full(len(block.sizes), m.tokens, np.int64)),
                pa.array(sums[1]),
                pa.array(sums[2]),
            ],
            schema=_OUT,
        )

    return blocks.groupBy("block").cogroup(pairs.union(triples).groupBy("block")).applyInArrow(answer, SCHEMA)
