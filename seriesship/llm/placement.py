"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table and the shards take turns: each claims the
first slot of its permutation that is still free, until the table is full. All shards so get equal shares (by
weight), and when a shard goes, nearly all slots of the others stay as they are. Placement is then one hash and one
lookup: the table has ``slots`` rows whatever the data, so it is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table: its rows of two numbers are broadcast.
MOST_SLOTS = 1 << 20


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], slots: int, weights: Mapping[str, int] | None = None) -> list[int]:
    """For each slot the index of the shard that claimed it.

    ``slots`` must be prime and not under the number of shards; names must differ. A shard of weight w claims w slots
    at each of its turns. Deterministic in the order of ``shards``.
    """
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards must be given and have different names")
    if slots < max(2, len(shards)) or slots > MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime not under the number of shards and at most MOST_SLOTS")
    turns = [(weights or {}).get(s, 1) for s in shards]
    if min(turns) < 0 or max(turns) < 1:
        raise ValueError("weights must not be negative and not all zero")
    spot = [_number(f"offset {s}") % slots for s in shards]
    step = [_number(f"skip {s}") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while True:
        for k, turn in enumerate(turns):
            for _ in range(turn):
                while owner[spot[k]] >= 0:
                    spot[k] = (spot[k] + step[k]) % slots
                owner[spot[k]] = k
                free -= 1
                if not free:
                    return owner


def lookup(spark: SparkSession, shards: Sequence[str], slots: int, weights: Mapping[str, int] | None = None) -> DataFrame:
    """The table as rows (slot, shard)."""
    rows = [(i, shards[k]) for i, k in enumerate(fill(shards, slots, weights))]
    return spark.createDataFrame(rows, "slot long, shard string")


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key: 60 bits of its MD5, modulo ``slots``. A null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % F.lit(slots)


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int, weights: Mapping[str, int] | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` added; no row moves, nothing is shuffled.

    Columns of ``df`` with these names are replaced. Null keys all share one slot; equal keys share a slot, so a key
    that a third of the rows have makes that shard larger: take a finer key then. An empty table stays empty.
    """
    df = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots))
    return df.join(F.broadcast(lookup(df.sparkSession, shards, slots, weights)), "slot").select(*df.columns, "shard")
