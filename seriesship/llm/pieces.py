"""Encoding into the pieces of a given vocabulary, with the N best segmentations, and decoding.

A text is a path through the lattice of its pieces. Going forward, Viterbi scores give every node the best score of
any path up to it. Going back from the end, these scores are exact heuristics for an A-star search, so paths leave
the queue from best to worst: the first N are the N best.

No piece reaches over certain places (before a blank that follows other text, around line ends and, if the vocabulary
allows, between letters and punctuation). Between these places the search runs once for each distinct string, and the
N best of a text are combined from those of its parts, again best first: a combination among the N best only uses
alternatives that are among the N - 1 cheapest of the text.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, count
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesship.llm.common import Memo, bound_batches, lean, slices

_EDIT = "struct<start:int,size:int,ids:array<int>>"
SCHEMA = (
    "doc_id long, n_pieces long, score double, decoded boolean, ids array<int>, "
    f"nbest array<struct<score:double,edits:array<{_EDIT}>>>"
)
_NBEST = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            (
                "edits",
                pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("ids", pa.list_(pa.int32()))])),
            ),
        ]
    )
)
_COARSE = re.compile(r"\n| *[^ \n]+| +")
_FINE = re.compile(r"\n| *[^\W_²]+(?=[.,!?;:|\n ]|\Z)| *[^ \n]+| +")
_NO_PIECE = object()
#: Longer strings do not go side by side with others; so many do at once.
_SHORT, _SIDE_BY_SIDE = 64, 1 << 13
_SPLIT = re.compile(r"[^\W_²][.,!?;:|]")


def _mix(key: np.ndarray, point: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (key ^ point) * np.uint64(0x9E3779B97F4A7C15)
        return key ^ (key >> np.uint64(31))


def _hash(text: str) -> int:
    key = 0
    for c in text:
        key = ((key ^ ord(c)) * 0x9E3779B97F4A7C15) & (1 << 64) - 1
        key ^= key >> 31
    return key


class Vocabulary:
    """Pieces, written with a blank for the word mark, with ids and log-probabilities; 256 byte pieces for the rest.

    A byte-pair vocabulary has merge ranks for scores and no probabilities. Zipf's law by rank serves instead:
    log(1 / (rank + 10)), normalised over the vocabulary; a byte costs 10 more than the rarest piece.
    """

    def __init__(self, pieces: Sequence[tuple[str, int, float]], bytes_: Sequence[int]) -> None:
        norm = math.log(sum(1 / (10 - score) for _, _, score in pieces))
        self.known = {p: (i, -math.log(10 - score) - norm) for p, i, score in pieces}
        #: Pieces with ids and score, and None for what only begins a piece: a search stops at anything else.
        self.table: dict = {p[:k]: None for p in self.known for k in range(1, len(p))}
        self.table |= {p: ((i,), score) for p, (i, score) in self.known.items()}
        self.bytes, self.byte_of = list(bytes_), {i: b for b, i in enumerate(bytes_)}
        self.byte_cost = min((s for _, s in self.known.values()), default=0.0) - 10
        self.text = {i: p for p, (i, _) in self.known.items()}
        self.text |= {i: chr(b) for i, b in self.byte_of.items() if b < 128}
        #: An open table of what begins a piece, by hash: the first free slot from that of the hash on.
        self.slots = 1 << (4 * len(self.table)).bit_length()
        self.begins, self.begun = np.zeros(self.slots, np.uint64), np.full(self.slots, -2, np.int64)
        for p, found in self.table.items():
            key = _hash(p)
            at = key & (self.slots - 1)
            while self.begun[at] > -2:
                at = (at + 1) & (self.slots - 1)
            self.begins[at], self.begun[at] = key, found[0][0] if found else -1
        self.longest = max(map(len, self.known), default=1)
        self.held: dict[int, tuple[Memo, Memo]] = {}
        self.score_of = np.zeros(1 + max((i for i, _ in self.known.values()), default=0))
        for i, score in self.known.values():
            self.score_of[i] = score
        #: Code points of the texts of pieces, one after another, by id: for decoding many paths at once.
        texts = [self.text[i] if i in self.text else "" for i in range(len(self.score_of))]
        self.points_of = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.length_of = np.fromiter(map(len, texts), np.int64, len(texts))
        self.from_of = np.cumsum(self.length_of) - self.length_of
        whole = all(len(_FINE.findall(p)) == 1 or p == "\n" for p in self.known)
        self.parts = _FINE if whole and not any(map(_SPLIT.search, self.known)) else _COARSE
        if any(re.search(r"[^ ] |.\n|\n.", p) for p in self.known):
            self.parts = re.compile(r"(?s).+")  # a piece may reach over anything: the whole text is one part

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        usable = [
            (model.id_to_piece(i).replace("▁", " "), i, model.get_score(i))
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        return cls(usable, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def lattice(self, text: str) -> tuple[list[float], list[list[tuple[int, tuple[int, ...], float]]]]:
        """The Viterbi score of every node, and by node the edges (start, ids, score) that end there."""
        table, n = self.table, len(text)
        best, edges = [0.0] + [-math.inf] * n, [[] for _ in range(n + 1)]
        for start in range(n):
            so_far = best[start]
            for end in range(start + 1, n + 1):
                found = table.get(text[start:end], _NO_PIECE)
                if found is None:
                    continue  # only the beginning of pieces
                if found is _NO_PIECE:
                    break
                edges[end].append((start, *found))
                if so_far + found[1] > best[end]:
                    best[end] = so_far + found[1]
            if text[start] not in self.known:
                data = text[start].encode("utf-8", "surrogatepass")
                score = self.byte_cost * len(data)
                edges[start + 1].append((start, tuple(self.bytes[b] for b in data), score))
                if so_far + score > best[start + 1]:
                    best[start + 1] = so_far + score
        return best, edges

    def nbest(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths as (score, ids), best first (to six decimals)."""
        best, edges = self.lattice(text)
        order, out = count(), []
        queue: list = [(0.0, len(text), next(order), 0.0, None)]
        while queue and len(out) < n:
            _, end, _, behind, path = heapq.heappop(queue)
            if not end:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((behind, tuple(ids)))
                continue
            for start, ids, score in edges[end]:
                g = behind + score
                # Of equally good ways, the one that is nearest to its end: else all of them would be begun.
                heapq.heappush(queue, (round(best[-1] - g - best[start], 6), start, next(order), g, (ids, path)))
        return out

    def _begun(self, key: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 for what only begins one, -2 for neither."""
        at = (key & np.uint64(self.slots - 1)).astype(np.int64)
        out = self.begun[at]
        wrong = np.flatnonzero((self.begins[at] != key) & (out > -2))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (self.slots - 1)
            out[wrong] = self.begun[at[wrong]]
            wrong = wrong[(self.begins[at[wrong]] != key[wrong]) & (out[wrong] > -2)]
        return out

    def best(self, strings: list[str]) -> Iterator[tuple[str, tuple[bytes, float, float, bool]]]:
        """(string, (best ids as int32, score, what the second path costs, decoding gives it back)) of different strings.

        Some thousand strings go forward side by side; every node keeps the scores of its two best paths. Long strings
        and those with characters that have no piece go one by one.
        """
        for at in range(0, len(strings), _SIDE_BY_SIDE):
            yield from self._best(strings[at : at + _SIDE_BY_SIDE])

    def _best(self, strings: list[str]) -> Iterator[tuple[str, tuple[bytes, float, float, bool]]]:
        short = [s for s in strings if len(s) <= _SHORT]
        for s in strings:
            if len(s) > _SHORT:
                yield s, self._proven(s, self._one(s))
        sizes = np.fromiter(map(len, short), np.int64, len(short))
        points = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = len(points)
        if not n:
            return
        word = np.repeat(np.arange(len(short)), sizes)
        first = np.cumsum(sizes) - sizes
        place = np.arange(n) - first[word]
        left = sizes[word] - place
        # Edges by length: as long as what was read so far begins a piece.
        live, key, edges = np.arange(n), np.zeros(n, np.uint64), []
        for size in range(1, self.longest + 1):
            fits = left[live] >= size
            live, key = live[fits], key[fits]
            if not len(live):
                break
            key = _mix(key, points[live + size - 1])
            piece = self._begun(key)
            known = piece > -2
            live, key, piece = live[known], key[known], piece[known]
            real = piece >= 0
            edges.append((live[real], np.full(int(real.sum()), size), piece[real]))
        start, size, piece = (np.concatenate(x) for x in zip(*edges)) if edges else [np.zeros(0, np.int64)] * 3
        order = np.argsort(place[start] * (self.longest + 1) + size, kind="stable")
        start, size, piece = start[order], size[order], piece[order]
        step = place[start] * (self.longest + 1) + size
        cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(step))
        # Nodes: one more than characters in every string.
        node = start + word[start]
        score = self.score_of[piece]
        best, second = np.full(n + len(short), -np.inf), np.full(n + len(short), -np.inf)
        best[first + np.arange(len(short))] = 0.0
        came, by = np.full(n + len(short), -1), np.full(n + len(short), -1)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at, to = node[a:b], node[a:b] + size[a]
            one, two, old = best[at] + score[a:b], second[at] + score[a:b], best[to]
            better = one > old
            second[to] = np.maximum(np.minimum(old, one), np.maximum(second[to], two))
            best[to[better]] = one[better]
            came[to[better]], by[to[better]] = at[better], piece[a:b][better]
        ends = first + np.arange(len(short)) + sizes
        reached = np.isfinite(best[ends])
        paths: list[np.ndarray] = []
        now, begin = np.where(reached, ends, -1), first + np.arange(len(short))
        while True:
            open_ = (now >= 0) & (now != begin)
            if not open_.any():
                break
            paths.append(np.where(open_, by[now], -1))
            now = np.where(open_, came[now], now)
        table = np.array(paths[::-1]).T if paths else np.zeros((len(short), 0), np.int64)
        ids, count_ = table[table >= 0], (table >= 0).sum(axis=1)
        flat, upto = ids.astype(np.int32).tobytes(), (4 * np.cumsum(count_)).tolist()
        gaps = np.where(reached, best[ends], 0.0) - second[ends]
        same = self._decoded(ids, np.repeat(np.arange(len(short)), count_), points, first, sizes) & reached
        own = map(flat.__getitem__, map(slice, [0, *upto], upto))
        found = list(zip(own, best[ends].tolist(), gaps.tolist(), same.tolist()))
        for k in np.flatnonzero(~same).tolist():
            s = short[k]
            found[k] = self._proven(s, found[k][:3] if reached[k] else self._one(s))
        yield from zip(short, found)

    def _decoded(self, ids: np.ndarray, word: np.ndarray, points: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the texts of the pieces ``ids``, each of the string ``word``, make up the code points of every string."""
        length = self.length_of[ids]
        right = np.bincount(word, length, len(sizes)).astype(np.int64) == sizes
        fits = right[word]
        length, word, begin = length[fits], word[fits], self.from_of[ids[fits]]
        upto = np.cumsum(length)
        step = np.arange(int(length.sum()))
        got = self.points_of[step + np.repeat(begin - upto + length, length)]
        given = points[np.repeat(right, sizes)]
        right[np.repeat(word, length)[got != given]] = False
        return right

    def _one(self, text: str) -> tuple[bytes, float, float]:
        found = self.nbest(text, 2)
        ids = np.array(found[0][1], np.int32).tobytes()
        return ids, found[0][0], found[0][0] - found[1][0] if len(found) > 1 else math.inf

    def _proven(self, text: str, found: tuple[bytes, float, float]) -> tuple[bytes, float, float, bool]:
        """``found`` and whether decoding it gives the text back."""
        return (*found, self.decode(memoryview(found[0]).cast("i"), 0) == text)

    def decode(self, ids: Sequence[int], skip: int = 1) -> str:
        """The text of ids: pieces, and runs of bytes as UTF-8; the blank put before the text (``skip``) is taken off."""
        try:
            text = "".join(map(self.text.__getitem__, ids))
        except KeyError:
            raw = b"".join(
                bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].encode("utf-8", "surrogatepass")
                for i in ids
            )
            text = raw.decode("utf-8", "surrogatepass")
        return text[skip:]


def combine(
    paths_of: Callable[[int], list[tuple[float, tuple[int, ...]]]], gaps: np.ndarray, n: int
) -> tuple[list[tuple[float, dict[int, int]]], dict[int, list]]:
    """The ``n`` cheapest choices over all parts: (cost over the best, {part: alternative}), cheapest first; and the
    paths of the parts that may differ.

    ``gaps`` has for each part what its second path costs, infinity if it has one path only.
    """
    few = min(n - 1, len(gaps))
    near = np.argpartition(gaps, few - 1)[:few] if 0 < few < len(gaps) else np.arange(len(gaps))[:few]
    if few and few < len(gaps):  # of equal gaps the first parts
        most = gaps[near].max()
        near = np.concatenate([np.flatnonzero(gaps < most), np.flatnonzero(gaps == most)])[:few]
    near = sorted((int(i) for i in near if np.isfinite(gaps[i])), key=lambda i: (gaps[i], i))
    paths = {i: paths_of(i) for i in near}
    costs = [[paths[i][0][0] - score for score, _ in paths[i]] for i in near]
    start = (0,) * len(near)
    queue, seen, out = [(0.0, start)], {start}, []
    while queue and len(out) < n:
        cost, pick = heapq.heappop(queue)
        out.append((cost, {near[k]: a for k, a in enumerate(pick) if a}))
        for k, a in enumerate(pick):
            if a + 1 < len(costs[k]):
                more = (*pick[:k], a + 1, *pick[k + 1 :])
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(queue, (sum(c[x] for c, x in zip(costs, more)), more))
    return out, paths


def _first(paths: list[tuple[float, tuple[int, ...]]], ids: tuple[int, ...]) -> list[tuple[float, tuple[int, ...]]]:
    """``paths`` with the path of these ids first: of equally good ones, the text may have taken another."""
    if paths[0][1] == ids:
        return paths
    return [(paths[0][0], ids), *(p for p in paths if p[1] != ids)][: len(paths)]


def encode(df: DataFrame, vocabulary: Vocabulary, n: int = 4) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): the best ids, their score, and the ``n`` best as edits of them.

    ``nbest[k]`` has the score of the k-th segmentation and the edits that lead to it: at ``start`` of ``ids``,
    ``size`` ids give way to others. ``decoded`` says that decoding gives the text back. A null text has no ids, null
    ``decoded`` and score; an empty one has no ids and score 0. Other columns are ignored, repeated rows answered each.
    """
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value

        find = v.parts.findall
        # Held in the worker from task to task, as the broadcast vocabulary is.
        memo, more = v.held.setdefault(n, (Memo(lambda s: v._proven(s, v._one(s)), 60_000), Memo(lambda s: v.nbest(s, n), 4_000)))
        for batch in slices(batches, "text", 1 << 20):
            texts = batch.column(1).to_pylist()
            found = [find(" " + text) if text else [] for text in texts]
            # Different strings get numbers; texts are put together from the numbers' ids, scores and gaps.
            number: defaultdict = defaultdict()
            number.default_factory = number.__len__
            ends = np.cumsum([0, *map(len, found)])
            part = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64, int(ends[-1]))
            strings = list(number)
            memo.fill(set(strings), v.best)
            known = list(map(memo.__getitem__, strings))
            ids_of = list(map(itemgetter(0), known))
            score_of = np.fromiter(map(itemgetter(1), known), np.float64, len(known))[part]
            gap_of = np.fromiter(map(itemgetter(2), known), np.float64, len(known))[part]
            sizes = np.fromiter(map(len, ids_of), np.int64, len(known)) // 4
            size_of = sizes[part]
            upto = np.concatenate([[0], np.cumsum(size_of)])
            flat = np.frombuffer(b"".join(ids_of), np.int32)
            flat = flat[np.arange(upto[-1]) + np.repeat((np.cumsum(sizes) - sizes)[part] - upto[:-1], size_of)]
            # Bytes of one character never stand in two parts, so a text decodes if its parts do and make it up.
            wrong = {s for s, x in zip(strings, known) if not x[3]}
            out: list[list] = [[], [], [], [], [], []]
            for k, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), texts)):
                if not text:
                    row = (doc, 0, None if text is None else 0.0, None if text is None else True, flat[:0], [])
                else:
                    a, b, parts = ends[k], ends[k + 1], found[k]
                    starts = upto[a:b] - upto[a]
                    ids = flat[upto[a] : upto[b]]
                    score = math.fsum(score_of[a:b])
                    first = lambda i: tuple(ids[starts[i] : starts[i] + size_of[a + i]].tolist())  # noqa: B023, E731
                    picks, paths = combine(lambda i: _first(more[parts[i]], first(i)), gap_of[a:b], n)  # noqa: B023
                    nbest = []
                    for cost, pick in picks:
                        edits = []
                        for i, choice in sorted(pick.items()):
                            edits.append({"start": int(starts[i]), "size": int(size_of[a + i]), "ids": list(paths[i][choice][1])})
                        nbest.append({"score": score - cost, "edits": edits})
                    whole = "".join(parts) == " " + text and not (wrong and wrong.intersection(parts))
                    row = (doc, len(ids), score, whole, ids, nbest)
                for column, value in zip(out, row):
                    column.append(value)
            del found, number, strings, known, ids_of, part
            more.trim()
            memo.trim()
            sizes = np.cumsum([0, *map(len, out[4])])
            flat = np.concatenate(out[4]) if out[4] else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.float64()),
                    pa.array(out[3], pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32())),
                    pa.array(out[5], _NBEST),
                ],
                ["doc_id", "n_pieces", "score", "decoded", "ids", "nbest"],
            )

    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)

