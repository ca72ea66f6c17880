"""Rows that every operator must cope with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = (
    "The quick brown fox jumps over the lazy dog while the old man reads a long letter about rivers, "
    "stones and ships that never came home to the quiet harbour of the northern town in winter."
)
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD = [
    (1, PROSE, "en", "a", 10),
    (1, PROSE, "en", "a", 10),  # the same row again
    (2, PROSE, None, None, None),  # a copy
    (3, None, "en", "a", None),
    (4, "", "en", None, 0),
    (5, " \n\t ", None, "a", 4),
    (6, "12 34 !!", "en", "a", 8),
    (7, LONG, "en", "b", len(LONG)),
    (8, "x" * 50_000, None, "b", 50_000),
    (9, "Élan 🙂 naïve\x00\x1f▁ café\r\nNext line", "fr", "b", 9),
    (None, "A text without an id, with a few words of its own here.", "en", "c", 1),
    (None, None, None, None, None),
]
#: Columns that operators use inside.
CLASHES = ["score", "words", "raw", "found", "grams", "print", "block", "held_out", "id", "grp", "tokens", "x", "kept", "slot"]


def odd(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASHES})


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def ids(rows) -> list:
    return sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i or 0))


EXPECTED_IDS = [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, None, None]
