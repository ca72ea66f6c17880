import os

import pytest

from seriesship.llm import pieces, queries
from tests.llm import cases

MODEL = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary here")
SMALL = pieces.Vocabulary(
    [(p, 256 + i, -float(i)) for i, p in enumerate([" ", "a", "b", "c", " a", "ab", "bc", " ab", "abc", "ca", ".", "b."])],
    list(range(256)),
)


def every_path(v, text):
    """All segmentations of a text, best first, by trying all cuts."""
    out = []

    def go(at, score, ids):
        if at == len(text):
            out.append((score, tuple(ids)))
            return
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in v.known:
                i, s = v.known[text[at:end]]
                go(end, score + s, ids + [i])
        if text[at] not in v.known:
            data = text[at].encode()
            go(at + 1, score + v.byte_cost * len(data), ids + [v.bytes[b] for b in data])

    go(0, 0.0, [])
    return sorted(out, reverse=True)


@pytest.mark.parametrize("text", [" a", " abcabca", " ab.abc cab", " é", " abéb."])
@pytest.mark.parametrize("n", [1, 3, 7])
def test_search_finds_the_best_paths(text, n):
    want, got = every_path(SMALL, text)[:n], SMALL.nbest(text, n)
    assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]
    assert len({ids for _, ids in got}) == len(got)


def applied(row, k):
    ids, out, at = row["ids"], [], 0
    for e in row["nbest"][k]["edits"]:
        out += ids[at : e["start"]] + e["ids"]
        at = e["start"] + e["size"]
    return out + ids[at:]


def check(rows, v, texts, n, brute):
    for row, text in zip(rows, texts):
        if not text:
            assert (row["n_pieces"], row["ids"], row["nbest"]) == (0, [], [])
            assert row["score"] == (None if text is None else 0.0)
            continue
        assert row["decoded"] and v.decode(row["ids"]) == text and row["n_pieces"] == len(row["ids"])
        paths = [applied(row, k) for k in range(len(row["nbest"]))]
        assert paths[0] == row["ids"] and len(set(map(tuple, paths))) == len(paths)
        for k, path in enumerate(paths):
            assert v.decode(path) == text
        if brute:
            want = every_path(v, " " + text)[:n]
            assert [round(x["score"], 6) for x in row["nbest"]] == [round(s, 6) for s, _ in want]


def test_whole_texts_against_all_segmentations(spark):
    texts = ["ab abc", "abca ab.", "a", "", None, "cab bc a", "é ab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = pieces.encode(df, SMALL, n=6).orderBy("doc_id").collect()
    check(rows, SMALL, texts, 6, True)


def test_side_by_side_equals_one_by_one():
    strings = [" ab", "abcab", ".", " c", "b.", " é", "abc" * 30, " abcabcabc"]
    got = dict(SMALL.best(strings))
    for s in strings:
        paths = every_path(SMALL, s)[:2] if len(s) < 20 else SMALL.nbest(s, 2)
        assert got[s][1] == pytest.approx(paths[0][0])
        if len(paths) > 1:
            assert got[s][2] == pytest.approx(paths[0][0] - paths[1][0])


@needs_model
def test_odd_rows_round_trip(spark):
    v = pieces.Vocabulary.load(MODEL)
    rows = pieces.encode(cases.odd(spark), v, n=3).collect()
    assert cases.ids(rows) == cases.EXPECTED_IDS
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    texts = {d: t for d, t, *_ in cases.ODD if d is not None}
    check([by_id[d] for d in sorted(texts)], v, [texts[d] for d in sorted(texts)], 3, False)


@needs_model
def test_no_piece_reaches_over_a_cut():
    v = pieces.Vocabulary.load(MODEL)
    assert v.parts is pieces._FINE
    text = " The word, and (more)  of_it: x².y\n\n  end."
    whole, parts = v.nbest(text, 1)[0], [v.nbest(p, 1)[0] for p in v.parts.findall(text)]
    assert "".join(v.parts.findall(text)) == text
    assert whole[0] == pytest.approx(sum(s for s, _ in parts))


def test_empty(spark):
    assert pieces.encode(cases.empty(spark), SMALL).count() == 0


def test_paths_are_decoded_side_by_side(monkeypatch):
    """Strings whose characters all have pieces are not decoded one by one; a piece that reads otherwise is found out."""
    v = pieces.Vocabulary([(p, 256 + i, -float(i)) for i, p in enumerate([" ", "a", "b", "ab", " ab", "İx"])], list(range(256)))
    alone, one = [], v._proven
    monkeypatch.setattr(v, "_proven", lambda s, x: alone.append(s) or one(s, x))
    strings = [" ab", "abab", "İxa", "é", "b", "ab" * 40, " a"]
    got = dict(v.best(strings))
    assert sorted(alone) == sorted(["é", "ab" * 40]) and all(x[3] for x in got.values())
    assert all(v.decode(memoryview(x[0]).cast("i"), 0) == s for s, x in got.items())

    wrong = pieces.Vocabulary([("a", 256, 0.0), ("b", 257, -1.0), ("ab", 258, -2.0)], list(range(256)))
    wrong.text[257] = "a"
    wrong.points_of = wrong.points_of.copy()
    wrong.points_of[wrong.from_of[257]] = ord("a")
    assert {s: x[3] for s, x in wrong.best(["a", "b", "ab", "bb", "aa"])} == {"a": True, "b": False, "ab": True, "bb": False, "aa": True}
