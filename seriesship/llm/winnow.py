"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` words that follow each other, ``KEEP`` k-grams begin in the first places; the smallest k-gram hash
among them is kept as a fingerprint. Whatever two texts share over ``WINDOW`` words or more, they share a fingerprint
of it, since the choice sees nothing else. So documents and items are joined on fingerprints; each hit lays an item
along a document, and is extended word by word to the shared windows. Items shorter than a window are windows
themselves; there every gram of their length is kept, which is winnowing with windows of one.

All of it is DataFrame functions. Only hashes are exploded, one in about three words; the texts are read again, for
documents with a hit alone. Rows are told apart by id and text, so repeated rows do not multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import ascii_lower, cut, small

WINDOW, GRAM = 13, 8
KEEP = WINDOW - GRAM + 1
#: What separates words once A-Z are lower-cased, and before that.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), _GAP), "")


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP_CASED), "")).cast("long")


def _folded(text: Column) -> Column:
    """Words in full lower case, for hashes only: equal words stay equal and, unlike with translate, it is fast.

    Each word is folded by itself: the lower case of some letters, as the sigma, depends on what stands beside them.
    """
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP_CASED), ""), F.lower)


def _grams(found: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, by place."""
    hashed = F.transform(found, lambda _, i: F.xxhash64(F.slice(found, i + 1, size)))
    return F.slice(hashed, F.lit(1), F.greatest(F.size(found) - (size - 1), F.lit(0)))


def _minima(grams: Column) -> Column:
    """The smallest of every ``KEEP`` hashes; of all, where there are fewer. Each once."""
    least = F.transform(grams, lambda _, i: F.array_min(F.slice(grams, i + 1, KEEP)))
    return F.array_distinct(F.slice(least, F.lit(1), F.greatest(F.size(grams) - (KEEP - 1), F.least(F.size(grams), F.lit(1)))))


def _prepared(df: DataFrame, short: list[int]) -> DataFrame:
    """``df`` (with ``text``) and ``found`` (folded words) and ``grams`` of all sizes."""
    df = df.withColumn("found", _folded(F.col("text")))
    parts = {f"g{k}": _grams(F.col("found"), k) for k in (GRAM, *(s for s in short if s != GRAM))}
    return df.withColumns(parts)


def _fingerprints(df: DataFrame, short: list[int]) -> Column:
    kept = _minima(F.col(f"g{GRAM}"))
    return F.concat(kept, *(F.array_distinct(F.col(f"g{k}")) for k in short)) if short else kept


def _items(benchmark: DataFrame) -> DataFrame:
    """(row, item_id, item words, window) of every item that has a word."""
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    items = items.withColumn("item", words(F.col("text"))).where(F.size("item") > 0)
    items = items.withColumn("window", F.least(F.size("item"), F.lit(WINDOW)))
    return cut(items.withColumn("row", F.monotonically_increasing_id()))


def _key(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"), F.col("text"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["_doc"].eqNullSafe(b["_doc"]) & (a["_text"] == b["_text"])


def spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Shared windows: (_doc, _text hash, row of the item, item_id, first word, words) of all ``docs``, each once."""
    items = _items(benchmark)
    # As a row an item takes its text and a few bytes for each word.
    item_bytes = items.agg(F.coalesce(F.sum(F.octet_length("text") + 24 * F.size("item") + 64), F.lit(0))).first()[0]
    short = sorted(r[0] for r in items.where(F.col("window") < WINDOW).select("window").distinct().collect())
    long_ = F.col("window") == WINDOW
    laid = _prepared(items, short)
    chosen = F.when(long_, _minima(F.col(f"g{GRAM}")))
    for k in short:
        chosen = F.when(F.col("window") == k, F.array_distinct(F.col(f"g{k}"))).otherwise(chosen)
    prints = cut(laid.select("row", "window", F.explode_outer(chosen).alias("print")).where(F.col("print").isNotNull()))
    known = prints.select("print").distinct()
    known = small(known, known.count(), 16)

    own = _prepared(_key(docs), short).select("_doc", "_text", F.explode_outer(_fingerprints(docs, short)).alias("print"))
    hits = cut(own.join(known, "print").select("_doc", "_text").distinct())
    few = small(hits.withColumnsRenamed({"_doc": "_hit_doc", "_text": "_hit_text"}), hits.count(), 48)

    keyed = _key(docs)
    hit = keyed["_doc"].eqNullSafe(few["_hit_doc"]) & (keyed["_text"] == few["_hit_text"])
    texts = cut(keyed.join(few, hit).select("_doc", "_text", "text").dropDuplicates(["_doc", "_text"]))

    # Where each gram stands, in documents with a hit and in items; a common one lays the item from word ``at`` on.
    def places(k: int) -> Column:
        return F.transform(F.col(f"g{k}"), lambda x, i: F.struct(x.alias("print"), i.cast("long").alias("place")))

    placed = F.inline(F.concat(*(places(k) for k in (GRAM, *(k for k in short if k != GRAM)))))
    doc_at = _prepared(texts, short).select("_doc", "_text", placed)
    item_at = _prepared(items, short).select("row", "window", F.size("item").alias("size"), placed)
    item_at = item_at.join(prints.select("row", "print"), ["row", "print"])
    item_at = cut(item_at.select("row", "window", "size", "print", F.col("place").alias("from")))
    item_at = small(item_at, item_at.count(), 48)
    laid = doc_at.join(item_at, "print").select("_doc", "_text", F.struct("row", "window", "size", (F.col("place") - F.col("from")).alias("at")).alias("lay"))
    laid = laid.groupBy("_doc", "_text").agg(F.collect_set("lay").alias("lays"))

    # The stretch of the document under each item, then equal windows of both.
    whole = texts.select("_doc", "_text", words(F.col("text")).alias("words"))
    whole = whole.join(laid, _same(whole, laid)).select(whole["_doc"], whole["_text"], "words", "lays")

    def stretch(lay: Column) -> Column:
        first = F.greatest(lay["at"], F.lit(0))
        return F.struct(
            lay["row"].alias("row"), lay["window"].alias("window"), first.alias("first"), (first - lay["at"]).alias("skip"),
            F.slice(F.col("words"), (first + 1).cast("int"), (lay["size"] - (first - lay["at"])).cast("int")).alias("under"),
        )

    under = whole.select("_doc", "_text", F.inline(F.transform("lays", stretch)))
    item = small(items.select("row", "item_id", "item"), item_bytes, 1)
    under = under.join(item, "row").where(F.size("under") >= F.col("window"))
    starts = F.sequence(F.lit(0), F.size("under") - F.col("window"))
    equal = F.filter(
        starts,
        lambda j: F.slice(F.col("under"), j + 1, F.col("window"))
        == F.slice(F.col("item"), (j + 1 + F.col("skip")).cast("int"), F.col("window")),
    )
    found = under.select("_doc", "_text", "row", "item_id", F.col("window").cast("long").alias("n"), F.col("first"), F.explode_outer(equal).alias("j"))
    return found.where(F.col("j").isNotNull()).select("_doc", "_text", "row", "item_id", (F.col("first") + F.col("j")).alias("start"), "n")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): how much of it stands in items of ``benchmark`` (item_id, text).

    ``n_words``; ``n_hit``, words inside a shared window; ``n_items``, items with shared windows, and the SHA-256 of
    their ids; ``contaminated``: at least a twentieth of the words are hit. Null and empty texts have no words and are
    clean. Null item ids take part in hits and are left out of ``n_items``. Repeated rows are answered each; an empty
    benchmark hits nothing. Other columns are ignored.
    """
    shared = spans(docs, benchmark)
    piece = F.struct(F.col("start"), (F.col("start") + F.col("n")).alias("end"))
    found = shared.groupBy("_doc", "_text").agg(
        F.array_sort(F.collect_set(piece)).alias("pieces"),
        F.collect_set(F.col("item_id").cast("string")).alias("item_ids"),
    )
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    union = F.aggregate(
        "pieces",
        none,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(acc["upto"], x["start"]))).alias("n"),
            F.greatest(acc["upto"], x["end"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )
    found = cut(found.select(F.col("_doc").alias("_found_doc"), F.col("_text").alias("_found_text"), union.alias("hit"), "item_ids"))
    held = found.agg(F.coalesce(F.sum(F.size("item_ids") + 1), F.lit(0))).first()[0]
    found = small(found, held, 64)
    all_ = _key(docs).select("_doc", "_text", count_words(F.col("text")).alias("n_words"))
    out = all_.join(found, all_["_doc"].eqNullSafe(found["_found_doc"]) & (all_["_text"] == found["_found_text"]), "left")
    ids = F.array_join(F.array_sort(F.coalesce("item_ids", F.array().cast("array<string>"))), ",")
    hit = F.coalesce("hit", F.lit(0).cast("long"))
    return out.select(
        F.col("_doc").alias("doc_id"), "n_words", hit.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"), F.col("_text").alias("text_hash"),
    )
