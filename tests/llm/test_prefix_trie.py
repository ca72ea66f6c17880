import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from seriesship.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(paths):
    """All nodes of {conv_id: [(role, text)]} by grouping every prefix."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for p, convs in members.items():
        kids = [k for k in members if len(k) == len(p) + 1 and k[: len(p)] == p]
        below = [k for k in members if k[: len(p)] == p]
        leaves = [k for k in below if not any(x[: len(k)] == k and len(x) > len(k) for x in below)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(convs), len(p), parent, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(paths):
    return [(c, i, role, text) for c, turns in paths.items() for i, (role, text) in enumerate(turns)]


def got(frame):
    return sorted((tuple(r[c] for c in COLS) for r in frame.collect()), key=str)


def random_paths(rng, n, depth=6):
    return {c: [(rng.choice(["u", "a"]), rng.choice(["x", "yy", "é", ""])) for _ in range(rng.randrange(1, depth))] for c in range(n)}


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_against_brute_force(spark, partitions):
    rng = random.Random(int(partitions))
    paths = random_paths(rng, 120) | {1000 + i: [("u", "same"), ("a", "same")] for i in range(60)}
    paths |= {2000: [("u", "long")] + [("a", f"t{i}") for i in range(150)], 2001: [("u", "long")] + [("a", f"t{i}") for i in range(90)]}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = got(prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame(rows_of(paths), SCHEMA))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out == brute(paths)


def test_ids_in_pieces(spark, monkeypatch):
    """One path's ids leave in many pieces and one middle path's too; hashes are those of whole lists."""
    paths = {i: [("u", "b")] for i in range(500)} | {600 + i: [("u", "a"), ("a", str(i % 3))] for i in range(300)}
    frame = prefix_trie.sequences(spark.createDataFrame(rows_of(paths), SCHEMA)).coalesce(1)
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    parts = {}
    for conv_id, turns in sorted(((c, t) for c, t in paths.items()), key=lambda x: (marks(x[1]), x[0])):
        for row in parts.setdefault("f", prefix_trie.Forest()).add(conv_id, marks(turns), [len(t) for _, t in turns]):
            parts.setdefault(row[1], []).append(row[-1])
    for row in parts["f"].nodes():
        if row[0] == 2:
            parts.setdefault(row[1], []).append(row[-1])
    ids = sorted(sorted(map(int, ",".join(v).split(","))) for k, v in parts.items() if k != "f")
    assert ids == sorted([list(range(500))] + [[600 + i for i in range(300) if i % 3 == k] for k in range(3)])
    monkeypatch.undo()
    assert got(prefix_trie.trie(frame)) == brute(paths)


def marks(turns):
    return b"".join(hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() for r, t in turns)


def test_nulls_ties_and_clashes(spark):
    rows = [
        (1, None, None, None), (1, 0, "u", "é"), (2, None, "", ""), (2, 5, "u", "é"), (3, 1, "u", "x"), (3, 1, "u", "x"),
        (None, 0, "u", "lost"), (4, 0, "ab", "c"), (5, 0, "a", "bc"),
    ]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", key int, mark string")
    want = brute({1: [("", ""), ("u", "é")], 2: [("", ""), ("u", "é")], 3: [("u", "x")] * 2, 4: [("ab", "c")], 5: [("a", "bc")]})
    assert got(prefix_trie.trie(prefix_trie.sequences(df))) == want
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.sequences(none)).count() == 0


def test_query_on_a_fixture(spark, tmp_path):
    rng = random.Random(4)
    own = {c: v for c, v in random_paths(rng, 90, 14).items() if c % 7}
    spark.createDataFrame(rows_of(own), SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert any(not p for p in paths.values())  # a conversation without turns
    assert got(queries.QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == brute(paths)
