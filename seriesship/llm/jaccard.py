"""Similarity join of documents by Jaccard similarity of their word shingles, through a token-group matrix.

1. Texts with equal sets form a class; its smallest id stands for it.
2. Similar classes are partitioned into groups. Candidates come from shared minima of hashes; a class joins a leader
   only if it really links with it, so every group is connected. All others are groups of one.
3. The matrix holds, for each group, the union of its members' prefix tokens. The prefix of a set of n tokens, in one
   global order with frequent tokens last, is so long that two linked sets share a token of their prefixes. With the
   most that may follow such a token in any member, and the members' sizes, the overlap that a document of one group
   can have with one of the other is bounded from above.
4. Only pairs of groups whose bound reaches what a link needs are opened: there the smaller group's documents are
   compared with the members of the larger one, in blocks of bounded size, exactly. Groups of one first compare
   how their tokens spread over 256 bins: what the bins have in common bounds the overlap too.
5. Links make components, by the smallest label along links with jumps.

Frequent tokens come last in the order, so no token's list grows with the number of documents that merely share it;
copies and near copies take part as groups, so no group's pairs are spelled out. Frequencies only steer the order:
the result is exact whatever they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import bound_batches, cut, lean, slices, small

SIZE = 5
#: Two sets link when NUM * overlap >= DEN * (sum of sizes): Jaccard similarity of 0.8 or more.
NUM, DEN = 9, 4
KEYS, AGREE = 6, 2
#: A token in so many texts, counted where texts are read together, comes last in the order; at most HOT_MOST do.
HOT_FROM, HOT_MOST = 32, 200_000
MEMBERS, QUERIES = 256, 2048
_P = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(9).integers(1, 1 << 63, KEYS, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """The shingle set of each UTF-8 text as sorted 64-bit hashes; A-Z are lower-cased, white space splits words."""
    split = [t.lower().split() if t else [] for t in texts]
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(chain.from_iterable(split))}
    words = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.uint64)
    sizes = [len(s) for s in split]
    del split
    with np.errstate(over="ignore"):
        n = max(len(words) - SIZE + 1, 0)
        keys = np.zeros(n, np.uint64)
        for k in range(SIZE):
            keys = keys * _P + words[k : k + n]
        keys = _spread(keys)
        out, at = [], 0
        for size in sizes:
            if size >= SIZE:
                out.append(np.unique(keys[at : at + size - SIZE + 1]))
            elif size:
                key = np.full(1, size, np.uint64)
                for w in words[at : at + size]:
                    key = key * _P + w
                out.append(_spread(key))
            else:
                out.append(np.zeros(0, np.uint64))
            at += size
    return out


def _bytes(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.col("text").cast("binary"))


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, n, digest, keys, sketch) and of tokens (token, n) seen in several texts of a batch."""
    schema = "doc_id long, n long, digest binary, keys array<long>, sketch binary, token long"
    names = ["doc_id", "n", "digest", "keys", "sketch", "token"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = token_sets(batch.column("text").to_pylist())
            digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            with np.errstate(over="ignore"):
                keys = [[int(_spread(s * seed).min().astype(np.int64)) for seed in _SEEDS] if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array([_sketch(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int64()),
                ],
                names,
            )
            token, n = np.unique(np.concatenate(sets), return_counts=True)
            token, n = token[n > 1].view(np.int64), n[n > 1]
            if len(token):
                none = len(token)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(none, pa.int64()), pa.array(n, pa.int64()), pa.nulls(none, pa.binary()), pa.nulls(none, pa.list_(pa.int64())), pa.nulls(none, pa.binary()), pa.array(token)],
                    names,
                )

    return docs.mapInArrow(run, schema)


def _candidates(reps: DataFrame) -> DataFrame:
    """(a, b): for each class the leader it may join: one that shares two or more minima and has a fitting size."""
    keys = cut(reps.select("rep", "n", F.posexplode("keys").alias("k", "key")))
    shared = keys.groupBy("k", "key").agg(F.count("*").alias("many")).where(F.col("many") > 1)
    keys = cut(keys.join(shared, ["k", "key"]))
    scores = keys.groupBy("rep").agg(F.sum("many").alias("score"))
    keys = cut(keys.join(scores, "rep"))
    # Leaders are classes that share most minima with others: the middle of a family of near copies.
    best = F.max(F.struct("score", (-F.col("rep")).alias("minus"), F.col("n").alias("size"))).alias("best")
    leaders = keys.groupBy("k", "key").agg(best)
    leaders = leaders.select("k", "key", (-F.col("best.minus")).alias("leader"), F.col("best.score").alias("lead"), "best.size")
    met = keys.join(leaders, ["k", "key"]).where((F.col("rep") != F.col("leader")) & (5 * F.least("n", "size") >= 4 * F.greatest("n", "size")))
    met = met.groupBy("rep", "leader").agg(F.count("*").alias("agree"), F.max("lead").alias("lead")).where(F.col("agree") >= AGREE)
    chosen = met.groupBy("rep").agg(F.max(F.struct("lead", "agree", (-F.col("leader")).alias("minus"))).alias("best"))
    return chosen.select(F.col("rep").alias("a"), (-F.col("best.minus")).alias("b"))


def _tokens_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, tokens as binary) of the documents whose id is in ``ids``, each id once."""
    ids = cut(ids.distinct())
    few = small(ids, ids.count(), 16)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = token_sets(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "tokens"])

    found = docs.join(few, docs["doc_id"] == few["id"], "left_semi").select("doc_id", "text")
    return found.mapInArrow(run, "id long, tokens binary").dropDuplicates(["id"])


def _sketch(tokens: np.ndarray) -> bytes:
    """How many tokens fall in each of 256 bins, at most 255."""
    return np.minimum(np.bincount((tokens & np.uint64(255)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def _plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sketches leave room for a link: an overlap is at most the bins' common part."""
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("of_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("of_b"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, 256) for c in ("of_a", "of_b"))
            least = np.minimum(a, b)
            room = least.sum(axis=1, dtype=np.int64)
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = (NUM * room >= DEN * total) | (least == 255).any(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def overlap(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))


def _linked(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that link."""
    left = tokens.select(F.col("id").alias("a"), F.col("tokens").alias("of_a"))
    right = tokens.select(F.col("id").alias("b"), F.col("tokens").alias("of_b"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist()
            keep = pa.array([NUM * overlap(x, y) >= DEN * (len(x) + len(y)) // 8 if x and y else False for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _prefixes(docs: DataFrame, hot) -> DataFrame:
    """The matrix, not yet merged over tasks: (token, grp, most tokens from it on, least size << 32 | largest size)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = hot.value
        for batch in slices(batches, "text"):
            groups = batch.column("grp").to_numpy()
            parts: list[tuple] = []
            for grp, tokens in zip(groups.tolist(), token_sets(batch.column("text").to_pylist())):
                n = len(tokens)
                if not n:
                    continue
                long_ = n - (4 * n + 4) // 5 + 1
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    late = known[at] == tokens
                    first = tokens[~late][:long_]
                    if len(first) < long_:
                        held = np.flatnonzero(late)
                        held = held[np.argsort(rank[at[held]])][: long_ - len(first)]
                        first = np.concatenate([first, tokens[held]])
                else:
                    first = tokens[:long_]
                parts.append((first, grp, n))
            if not parts:
                continue
            token = np.concatenate([p[0] for p in parts]).view(np.int64)
            lengths = np.array([len(p[0]) for p in parts])
            grp = np.repeat(np.array([p[1] for p in parts], np.int64), lengths)
            size = np.repeat(np.array([p[2] for p in parts], np.int64), lengths)
            rest = size - (np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths))
            yield _rows(*_merge(token, grp, rest, size, size))

    return docs.mapInArrow(run, "token long, grp long, rest long, sizes long")


def _merge(token, grp, rest, low, high):
    """Rows of one (token, group) as one."""
    order = np.lexsort((grp, token))
    token, grp, rest, low, high = (x[order] for x in (token, grp, rest, low, high))
    first = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (grp[1:] != grp[:-1]))) if len(token) else np.zeros(0, np.int64)
    if len(first) == len(token):
        return token, grp, rest, low, high
    return token[first], grp[first], np.maximum.reduceat(rest, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)


def _rows(token, grp, rest, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(token), pa.array(grp), pa.array(rest), pa.array(low << 32 | high)], ["token", "grp", "rest", "sizes"])


def _may_link(rest_a, low_a, high_a, rest_b, low_b, high_b) -> np.ndarray:
    """Whether a set of one group can have with one of the other the overlap that a link needs."""
    a = np.maximum(low_a, (4 * low_b + 4) // 5)
    b = np.maximum(low_b, (4 * low_a + 4) // 5)
    return (a <= high_a) & (b <= high_b) & (NUM * np.minimum(rest_a, rest_b) >= DEN * (a + b))


def _qualifying(matrix: DataFrame) -> DataFrame:
    """(a, b), a < b: pairs of groups that share a token and whose bound allows a link."""

    def pairs(token, grp, rest, low, high) -> tuple[np.ndarray, np.ndarray]:
        token, grp, rest, low, high = _merge(token, grp, rest, low, high)
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(starts, len(token)))
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def test(i: np.ndarray, j: np.ndarray) -> None:
            ok = _may_link(rest[i], low[i], high[i], rest[j], low[j], high[j])
            out.append((grp[i[ok]], grp[j[ok]]))

        row = np.arange(len(token))
        short = np.repeat(lengths <= 64, lengths)
        left = np.repeat(starts + lengths, lengths) - row  # rows from here to the end of the token
        row, left = row[short & (left > 1)], left[short & (left > 1)]
        gap = 1
        while len(row):
            test(row, row + gap)
            gap += 1
            row, left = row[left > gap], left[left > gap]
        for start, length in zip(starts[lengths > 64].tolist(), lengths[lengths > 64].tolist()):
            for k in range(length - 1):
                others = np.arange(start + k + 1, start + length)
                test(np.full(len(others), start + k), others)
                if len(out) > 4096:
                    out[:] = [_distinct(out)]
        return _distinct(out)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def take(rows: list[list[np.ndarray]], last: bool) -> Iterator[pa.RecordBatch]:
            token, grp, rest, sizes = (np.concatenate(x) for x in zip(*rows))
            end = len(token) if last else int(np.searchsorted(token, token[-1]))
            held[:] = [[token[end:], grp[end:], rest[end:], sizes[end:]]]
            a, b = pairs(token[:end], grp[:end], rest[:end], sizes[:end] >> 32, sizes[:end] & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            if sum(len(h[0]) for h in held) > 400_000:
                yield from take(list(held), False)
        if held:
            yield from take(list(held), True)

    return matrix.repartition("token").sortWithinPartitions("token", "grp").mapInArrow(run, "a long, b long").distinct()


def _distinct(out: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    return a[new], b[new]


def _opened(pairs: DataFrame, groups: DataFrame, tokens: DataFrame) -> DataFrame:
    """Links (a, b) between the documents of one group and those of a larger one; one for each document and block.

    ``pairs`` has (query group, group). The larger group's members come in blocks of about ``MEMBERS``, the documents
    that are compared with them in blocks of about ``QUERIES``.
    """
    sized = groups.groupBy("grp").agg(F.count("*").alias("many"))
    asked = pairs.join(groups.select(F.col("grp").alias("q"), F.col("id").alias("query")), "q").select("g", "query").distinct()
    counts = asked.groupBy("g").agg(F.count("*").alias("n")).join(sized.withColumnRenamed("grp", "g"), "g")
    blocks = counts.select(
        "g", F.ceil(F.col("n") / QUERIES).cast("int").alias("qs"), F.ceil(F.col("many") / MEMBERS).cast("int").alias("ms")
    )
    blocks = cut(blocks)
    blocks = small(blocks, blocks.count(), 32)
    left = groups.join(blocks, groups["grp"] == blocks["g"]).join(tokens, "id")
    left = left.select("g", F.pmod(F.xxhash64("id"), F.col("ms")).cast("int").alias("m"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("s"), "id", "tokens")
    right = asked.join(blocks, "g").join(tokens.withColumnRenamed("id", "query"), "query")
    right = right.select(F.explode(F.sequence(F.lit(0), F.col("ms") - 1)).alias("m"), F.pmod(F.xxhash64("query"), F.col("qs")).cast("int").alias("s"), "query", F.col("tokens").alias("own"), F.col("g").alias("of"))

    @lean
    def compare(members: pa.Table, queries: pa.Table) -> pa.Table:
        sets = [np.frombuffer(t, np.uint64) for t in members.column("tokens").to_pylist()] if members.num_rows else []
        a, b = [], []
        if sets:
            sizes = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            flat, owner, ids = flat[order], owner[order], members.column("id").to_pylist()
            for query, raw in zip(queries.column("query").to_pylist(), queries.column("own").to_pylist()):
                own = np.frombuffer(raw, np.uint64)
                low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                n = high - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                shared = np.bincount(owner[at], minlength=len(sets))
                link = np.flatnonzero(NUM * shared >= DEN * (sizes + len(own)))
                if len(link):
                    a.append(query)
                    b.append(ids[int(link[0])])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.groupBy("g", "m", "s").cogroup(right.groupBy("of", "m", "s")).applyInArrow(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ids in ``links`` (a, b): the smallest id that links lead to."""
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    label = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(label, both["b"] == label["id"]).groupBy("a").agg(F.min("component").alias("near"))
        jump = label.select(F.col("id").alias("to"), F.col("component").alias("jump"))
        new = label.join(near, label["id"] == near["a"]).join(jump, F.col("component") == jump["to"])
        new = cut(new.select("id", F.least("component", "near", "jump").alias("component"), F.col("component").alias("was")))
        if new.where(F.col("component") != F.col("was")).isEmpty():
            return new.select("id", "component")
        label = new.select("id", "component")


def similarity_components(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): size of its shingle set and the smallest id of its component.

    Null and text without words have no shingles and link with nothing; nor does a row without an id, whose component
    is null. A text of under 5 words is one shingle. Repeated rows are answered each. No rows give no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = _bytes(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"))
    survey = cut(_survey(docs))
    rows = survey.where(F.col("token").isNull())
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    classes = rows.where(usable).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    classes = cut(classes)

    often = survey.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_FROM)
    often = often.orderBy(F.desc("n"), "token").limit(HOT_MOST).collect()
    known = np.array([r["token"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(known)
    hot = spark.sparkContext.broadcast((known[order], -order))  # rarer ones first

    # One row for each id; where an id has several texts, they are tried together.
    repeated = not classes.groupBy("rep").count().where(F.col("count") > 1).isEmpty()
    reps = classes.select("rep", "n", "keys", "sketch")
    near = _candidates(reps.dropDuplicates(["rep"]) if repeated else reps)
    near = cut(_plausible(near, reps).distinct())
    joined = cut(_linked(near, _tokens_of(docs, near.select(F.col("a").alias("id")).union(near.select("b")))))
    leaders = joined.select(F.col("b").alias("id")).distinct()
    members = joined.join(leaders, joined["a"] == leaders["id"], "left_anti").select(F.col("a").alias("id"), F.col("b").alias("grp"))
    groups = cut(members.union(members.select("grp", "grp").distinct()))  # groups of two and more

    copies = rows.where(usable).join(classes.select("digest", "rep"), "digest").where(F.col("doc_id") != F.col("rep"))
    copies = copies.select(F.col("doc_id").alias("id")).distinct().join(reps, F.col("id") == F.col("rep"), "left_anti")
    tags = cut(copies.select("id", F.lit(None).cast("long").alias("grp"), F.lit(True).alias("copy")).union(groups.select("id", "grp", F.lit(False))))
    tags = small(tags, tags.count(), 32)
    tagged = docs.join(tags, docs["doc_id"] == tags["id"], "left").where(F.col("doc_id").isNotNull() & ~F.coalesce("copy", F.lit(False)))
    matrix = _prefixes(tagged.select("text", F.coalesce("grp", "doc_id").alias("grp")), hot)
    pairs = cut(_qualifying(matrix))

    sized = groups.groupBy("grp").agg(F.count("*").alias("many"))
    both = pairs
    for side in ("a", "b"):
        both = both.join(sized.select(F.col("grp").alias(side), F.col("many").alias(f"of_{side}")), side, "left")
    both = cut(both.withColumns({f"of_{s}": F.coalesce(f"of_{s}", F.lit(1)) for s in "ab"}))
    alone = (F.col("of_a") == 1) & (F.col("of_b") == 1)
    swap = F.col("of_a") > F.col("of_b")
    open_ = cut(both.where(~alone).select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("q"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("g")))
    inside = open_.select(F.col("q").alias("grp")).union(open_.select("g")).distinct()
    own = groups.join(inside, "grp").select("id", "grp").union(inside.join(groups, "grp", "left_anti").select("grp", "grp"))
    own = cut(own)
    single = cut(_plausible(both.where(alone).select("a", "b"), reps).distinct())
    needed = single.select(F.col("a").alias("id")).union(single.select("b")).union(own.select("id"))
    tokens = cut(_tokens_of(docs, needed))
    links = joined.union(_linked(single, tokens)).union(_opened(open_, own, tokens))
    found = components(cut(links))
    labels = classes.select("digest", "rep").join(found, F.col("rep") == F.col("id"), "left")
    labels = labels.select(F.col("digest").alias("of"), F.coalesce("component", "rep").alias("component"))
    out = rows.join(labels, (rows["digest"] == labels["of"]) & usable, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
