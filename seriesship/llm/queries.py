"""One query per operator, over whole tables, with production parameters. The SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesship.llm import (
    backoff,
    factorisation,
    jaccard,
    language,
    outliers,
    packing,
    periodic,
    pieces,
    placement,
    prefix_trie,
    surrogates,
    url_templates,
    winnow,
)
from seriesship.llm.common import bucket_of, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZERS = "/opt/tokenizers"
#: How the byte-level vocabularies split a text, as their files' description gives it (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
SLOTS = 4099


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pack_token_ids(spark, sf):
    make = packing.RanksEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", PATTERN)
    return packing.pack(table(spark, sf, "documents"), make, length=2048, end_id=50256, pad_id=50256)


@query
def op2_encode_pieces(spark, sf):
    vocabulary = pieces.Vocabulary.load(f"{TOKENIZERS}/piece_bpe_32k.model")
    return pieces.encode(table(spark, sf, "documents"), vocabulary, n=4)


@query
def op4_place_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return placement.place(docs, "doc_id", SHARDS, SLOTS)


@query
def op8_robust_outliers(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return outliers.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query
def op10_backoff_score(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return backoff.score(docs, bucket_of(docs["doc_id"], 10) == 0)


def learned_from(docs: DataFrame):
    """Rows whose language may be learned from."""
    return bucket_of(docs["doc_id"], 3) != 1


@query
def op5_identify_language(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = language.identify(docs, learned_from(docs))
    return out.select("doc_id", (bucket_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "n_switches")


@query
def op6_winnow_benchmark(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = winnow.contamination(docs, table(spark, sf, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op9_jaccard_components(spark, sf):
    return jaccard.similarity_components(table(spark, sf, "documents").select("doc_id", "text"))


#: Keys the surrogates; a deployment passes its own.
SECRET = "surrogates of the sample corpus"


@query
def op3_surrogates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, SECRET, count_column="n_replaced")


@query
def op7_url_templates(spark, sf):
    """Labels: a page's path ends with the number of its document, and that is bad if of low quality or toxic."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    labels = table(spark, sf, "labels")
    labels = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    number = F.regexp_extract(url_templates.path_of(F.col("url")), r"/([0-9]{1,18})[^/0-9]*/?\z", 1)
    pages = pages.withColumn("number", number.try_cast("long"))
    return url_templates.judge(pages.join(labels, pages["number"] == labels["doc_id"], "left"))


def rewritten(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the hash of its id, goes on from word ``a`` with a period of ``p``."""
    hashed = bucket_of(F.col("doc_id"), 1 << 32)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n, g = F.size(words), F.floor(hashed / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    periodic_text = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    text = F.when(hashed % 10 == 0, F.when(n > 0, periodic_text).otherwise(F.col("text"))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op11_periodic_runs(spark, sf):
    found = periodic.collapse_runs(rewritten(table(spark, sf, "documents")))
    more = lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), more)
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best").getField(c).alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"),
    )


def grafted(own: DataFrame) -> DataFrame:
    """Every conversation with the first turns of the one whose id is its own rounded down to fives in place of its own.

    Only the few turns that may be taken are joined, five conversations to one.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    own = own.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % 5, "taken": taken.cast("int")})
    base = own.where(F.col("conv_id") == F.col("base_id")).select(F.col("base_id").alias("_base"), F.slice("turns", 1, 8).alias("first"))
    both = own.join(base, own["base_id"] == base["_base"], "left")
    none = F.slice("turns", 1, 0)
    first = F.slice(F.coalesce("first", none), F.lit(1), F.col("taken"))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(first, rest).alias("turns"))


@query
def op12_prefix_trie(spark, sf):
    return prefix_trie.trie(grafted(prefix_trie.sequences(table(spark, sf, "conversations"))))


@query
def op13_factorisation_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    out = factorisation.grade(docs, labels.where(bucket_of(F.col("doc_id"), 3) != 1), metadata=("n_chars",))
    return out.select("doc_id", (bucket_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
