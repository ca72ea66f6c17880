"""The corpus pipeline: every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.

All stages but the last return the columns of ``docs``; extra columns pass through. Results in between are stored in
the shared checkpoint folder, so that no stage works out the ones before it again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesship.llm import jaccard, language, pieces, surrogates, winnow
from seriesship.llm.common import cut, small, table
from seriesship.llm.queries import SECRET, TOKENIZERS, learned_from

#: A document goes if it has no language, or less than this share of its words is in its main one.
LEAST_SHARE = 0.5
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
USED = ("doc_id", "text", "lang", "n_chars")


def packed(stage: Stage) -> Stage:
    """All columns that no stage uses go through in one, so that their names can't meet those of a stage."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rest = [c for c in docs.columns if c not in USED]
        used = [c for c in docs.columns if c in USED]
        out = stage(spark, docs.select(*used, F.struct(*rest).alias("_rest")) if rest else docs, sf_dir)
        return out.select(*(F.col("_rest").getField(c).alias(c) if c in rest else F.col(c) for c in docs.columns))

    return run


@packed
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in no main language."""
    model = language.train(docs.where(learned_from(docs)).select("text", "lang"))
    told = language.annotate(docs, spark.sparkContext.broadcast(model), "_lang_pred", "_lang_share")
    kept = (F.col("_lang_pred") != language.UNKNOWN) & (F.col("_lang_share") >= LEAST_SHARE)
    return told.where(kept).select(docs.columns)


@packed
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every component; of repeated rows, one. Rows without id stay."""
    found = jaccard.similarity_components(docs.select("doc_id", "text"))
    found = found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_of"))
    found = found.agg(F.bool_and(F.col("component_id") != F.col("doc_id")).alias("_goes"), F.count("*").alias("_rows"))
    marked = cut(found.where(F.col("_goes") | (F.col("_rows") > 1)))
    repeated = not marked.where(~F.col("_goes")).isEmpty()
    marked = small(marked, marked.count(), 24)
    kept = docs.join(marked, docs["doc_id"] == marked["_of"], "left").where(~F.coalesce("_goes", F.lit(False)))
    if not repeated:
        return kept.select(docs.columns)
    once = kept.where(F.col("_rows").isNull()).select(docs.columns)
    return once.union(kept.where(F.col("_rows").isNotNull()).select(docs.columns).dropDuplicates(["doc_id", "text"]))


@packed
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more stands in benchmark items."""
    found = winnow.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("_of"), F.col("text_hash").alias("_hash")).distinct()
    bad = cut(bad)
    bad = small(bad, bad.count(), 24)
    same = docs["doc_id"].eqNullSafe(bad["_of"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti").select(docs.columns)


@packed
def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates; the number of characters follows."""
    out = surrogates.pseudonymise(docs, SECRET)
    if "n_chars" in docs.columns:
        own = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        out = out.withColumn("n_chars", own.cast(docs.schema["n_chars"].dataType))
    return out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with the best segmentations."""
    return pieces.encode(docs, pieces.Vocabulary.load(f"{TOKENIZERS}/piece_bpe_32k.model"), n=4)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("personal data", replace_personal_data),
    ("pieces", encode_pieces),
]
#: SQL expresses neither the learned language nor the lattice; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
