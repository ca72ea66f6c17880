import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesship.llm import packing, queries
from tests.llm import cases

RANKS = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"


def naive(lengths, length):
    room, rows = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(r, k) for k, r in enumerate(room) if r >= lengths[i]]
        if fits:
            k = min(fits)[1]
        else:
            k = len(room)
            room.append(length)
            rows.append([])
        room[k] -= lengths[i]
        rows[k].append(i)
    return rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 37), max_size=60))
def test_best_fit_takes_the_least_room(lengths):
    rows = packing.best_fit(lengths, 37)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    shape = lambda rows: sorted(sorted(lengths[i] for i in r) for r in rows)
    assert all(sum(lengths[i] for i in r) <= 37 for r in rows)
    assert len(rows) == len(naive(lengths, 37))
    assert sum(map(len, shape(rows))) == len(lengths)


def rebuilt(rows, kind, length):
    parts = {}
    for r in rows:
        ids, places = np.frombuffer(r["ids"], kind), np.frombuffer(r["position_ids"], kind)
        assert len(ids) == len(places) == length
        ends = r["cu_seqlens"]
        assert ends[0] == 0 and ends[-1] == r["n_tokens"]
        for k, (doc, at) in enumerate(zip(r["doc_ids"], r["doc_offsets"])):
            seg = slice(ends[k], ends[k + 1])
            assert places[seg].tolist() == list(range(ends[k + 1] - ends[k]))
            parts.setdefault(doc, []).append((at, ids[seg].tolist()))
        assert not places[ends[-1] :].any()
    return parts


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
@pytest.mark.parametrize("window", [1, 4 << 20])
def test_lossless(spark, window):
    make = packing.RanksEncoder(RANKS, queries.PATTERN)
    rows = packing.pack(cases.odd(spark), make, length=64, end_id=50256, pad_id=50256, window=window).collect()
    assert len({r["pack_id"] for r in rows}) == len(rows)
    parts, encode = rebuilt(rows, "<u2", 64), make()
    for doc, text, *_ in cases.ODD:
        if text is None or doc is None:
            continue
        want = encode(text) + [50256]
        got = sorted(parts[doc])
        whole = [i for _, ids in sorted(set((a, tuple(x)) for a, x in got)) for i in ids]
        assert whole == want
    assert 3 not in parts
    assert sum(at == 0 for at, _ in parts[1]) == 2  # a repeated row is packed twice


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_runs_do_not_change_the_encoding():
    encode = packing.RanksEncoder(RANKS, queries.PATTERN)()
    for text in ("a  b\n\n c d  e\x1cf", " lead", "trail  ", "don't  we'll\tgo", cases.ODD[9][1]):
        assert [i for run in packing._RUN.findall(text) for i in encode(run)] == encode(text)


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_empty(spark):
    make = packing.RanksEncoder(RANKS, queries.PATTERN)
    assert packing.pack(cases.empty(spark), make, length=8, end_id=1, pad_id=0).count() == 0


def test_texts_are_given_to_the_encoder_at_once():
    asked = []
    encode = lambda text: asked.append(text) or [*map(ord, text)]
    assert packing._ids(encode, "ab cd  e", np.dtype("<u2")).tolist() == [*map(ord, "ab cd  e")]
    assert asked == ["ab cd  e"]


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
@pytest.mark.parametrize("text", ["", " ", "a  b\n\n c", cases.ODD[9][1]])
def test_long_texts_have_the_same_ids(text):
    encode = packing.RanksEncoder(RANKS, queries.PATTERN)()
    kind = np.dtype("<u2")
    assert packing._ids(encode, text, kind, 0).tolist() == packing._ids(encode, text, kind).tolist() == encode(text)
