"""Scans: metric families, ready-made series, requests, and streams of the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesship.functions.text import let
from seriesship.schema import FAMILIES, REQUESTS, SERIES


def explode_families(families: DataFrame) -> DataFrame:
    """One row per metric; families without metrics yield none."""
    return families.select(
        "push_key",
        "family_ord",
        "name",
        "type",
        F.posexplode("metrics").alias("metric_ord", "m"),
    ).select(
        "push_key",
        "family_ord",
        F.col("metric_ord").cast("bigint").alias("metric_ord"),
        "name",
        "type",
        "m.labels",
        "m.timestamp_ms",
        "m.value",
        "m.histogram",
        "m.summary",
    )


def _read(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def read_families(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Metrics of stored family snapshots. A missing path is an error, an empty one is not."""
    return explode_families(_read(spark, path, fmt, FAMILIES))


def read_series(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, SERIES)


def read_requests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, REQUESTS)


def _stream(spark: SparkSession, path: str, fmt: str, schema: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_families_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Metrics of snapshot files, or of commits to a folder of ``metric_families``, as they arrive."""
    return explode_families(_stream(spark, path, fmt, FAMILIES, files_per_trigger))


def read_series_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    return _stream(spark, path, fmt, SERIES, files_per_trigger)


def read_requests_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    return _stream(spark, path, fmt, REQUESTS, files_per_trigger)


# --- record files left by a spool ------------------------------------------------------------------


def list_record_files(spark: SparkSession, folder: str) -> DataFrame:
    """File listing of a spool folder: path and length, contents not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def record_id(path: Column) -> Column:
    """Id in a record file's name, unsigned 64 bits; null for other names."""
    digits = F.nullif(F.regexp_extract(path, r"(?:^|/)([0-9A-Fa-f]+)\.record$", 1), F.lit(""))

    def read(short: Column) -> Column:
        value = F.conv(F.when(short == "", "0").otherwise(short), 16, 10).cast("decimal(20,0)")
        return F.when(F.length(short) <= 16, value)

    return let(F.ltrim(digits, F.lit("0")), read)


def recover_records(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of a listing (path, length, optional is_dir) in id order, and their totals.

    Folders, half-written files and foreign names are left out.
    """
    listed = files.where(~F.col("is_dir")) if "is_dir" in files.columns else files
    records = listed.select(
        record_id(F.col("path")).alias("record_id"), "path", F.col("length").alias("size_bytes")
    ).where("record_id is not null")
    stats = records.agg(
        F.count("*").alias("records"),
        F.coalesce(F.max("record_id"), F.lit(0)).cast("decimal(20,0)").alias("max_id"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
    )
    return records.orderBy("record_id"), stats
