from collections import Counter

import pytest

from seriesship.llm import placement
from tests.llm import cases

NAMES = [f"s{i}" for i in range(7)]


def test_shares_are_equal():
    for n in (1, 2, 7):
        count = Counter(placement.fill(NAMES[:n], 101))
        assert max(count.values()) - min(count.values()) <= 1


def test_every_slot_is_the_first_free_of_its_shards_permutation():
    slots, owner = 101, placement.fill(NAMES, 101)
    orders = [
        [(placement._number(f"offset {s}") + j * (placement._number(f"skip {s}") % (slots - 1) + 1)) % slots for j in range(slots)]
        for s in NAMES
    ]
    taken = {}
    while len(taken) < slots:
        for k, order in enumerate(orders):
            if len(taken) < slots:
                taken[next(p for p in order if p not in taken)] = k
    assert owner == [taken[i] for i in range(slots)]


def test_few_slots_change_when_a_shard_goes():
    before = placement.fill(NAMES, 4099)
    after = placement.fill(NAMES[:-1], 4099)
    moved = sum(a != b for a, b in zip(before, after) if b is not None and before[0] is not None and a != 6)
    assert moved < 0.25 * 4099


def test_weights():
    count = Counter(placement.fill(["a", "b"], 1009, {"a": 3, "b": 1}))
    assert abs(count[0] / 1009 - 0.75) < 0.01
    with pytest.raises(ValueError):
        placement.fill(["a", "a"], 101)
    with pytest.raises(ValueError):
        placement.fill(["a"], 100)


def test_odd_rows(spark):
    df = cases.odd(spark)
    out = placement.place(df, "doc_id", NAMES, 101)
    rows = out.collect()
    assert cases.ids(rows) == cases.EXPECTED_IDS
    assert sorted(out.columns) == sorted([*df.columns, "shard"])  # a column named slot is replaced
    owner = placement.fill(NAMES, 101)
    assert all(r["shard"] == NAMES[owner[r["slot"]]] for r in rows)
    assert placement.place(cases.empty(spark), "doc_id", NAMES, 101).count() == 0
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
