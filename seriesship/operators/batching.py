"""Size estimates and greedy batches: a batch closes once it holds enough series or bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.config import DEFAULT_MAX_BYTES, DEFAULT_MAX_SERIES
from seriesship.functions.labels import label_bytes
from seriesship.operators.ordered import NEVER, UNLIMITED, Greedy, greedy_cuts, split_ordered


def series_bytes(labels: Column, samples: Column | None = None) -> Column:
    """Estimated bytes of a series. Flattened series count labels only, ready-made ones samples too."""
    out = label_bytes(labels) + 16
    return out if samples is None else out + 16 * F.coalesce(F.size(samples), F.lit(0))


def _limits(max_series: int, max_bytes: int) -> tuple[int, int]:
    return (
        max_series if max_series > 0 else DEFAULT_MAX_SERIES,
        max_bytes if max_bytes > 0 else DEFAULT_MAX_BYTES,
    )


def batch_numbers(
    units: DataFrame,
    key: str,
    order: list[str],
    max_series: int = 0,
    max_bytes: int = 0,
    partitions: int | None = None,
    fan: int = 64,
) -> DataFrame:
    """Number the batches (from 0, per key) of units that are never split.

    ``units`` holds key, order and the unit's ``n`` series and ``b`` bytes. Units without series belong to
    no batch.
    """
    max_n, max_b = _limits(max_series, max_bytes)
    rows = units.where("n > 0").select(
        key,
        *order,
        F.col("n").cast("bigint"),
        F.col("b").cast("bigint"),
        F.lit(0).cast("bigint").alias("r"),
        F.lit(1).cast("bigint").alias("c"),
        F.lit(NEVER).cast("bigint").alias("m"),
    )
    split = split_ordered(rows, key, order, partitions=partitions)
    cuts = greedy_cuts(split, Greedy(max_n, max_b), [*order, "n", "b"], fan)
    # A batch closes after the row that reaches the limit, so that row still belongs to it.
    return cuts.select(
        key, *order, "n", "b", (F.col("t") - F.col("cut").cast("int")).alias("batch_no")
    )


def batch_numbers_by_count(
    units: DataFrame, key: str, order: list[str], max_series: int, partitions: int | None = None
) -> DataFrame:
    """Batches of single series where bytes cannot bind: whole division of the rank in the key."""
    return batch_numbers(
        units.select(key, *order, F.lit(1).alias("n"), F.lit(0).alias("b")),
        key,
        order,
        max_series,
        UNLIMITED,
        partitions,
    )


def assign_batches(
    series: DataFrame,
    key: str = "push_key",
    order: list[str] | str = "family_ord",
    max_series: int = 0,
    max_bytes: int = 0,
    atomic: str = "family",
    partitions: int | None = None,
    fan: int = 64,
) -> DataFrame:
    """Add ``batch_no`` to series. Limits of zero or less take the defaults.

    ``atomic='family'`` keeps all rows with the same order value together, ``'series'`` checks after every
    row; of series with the same key and order value, which a list of series cannot have, none is lost and all
    stay together. Null keys, and null order values, count as one value that comes first. Only (key, order,
    count, bytes) takes part in the ordered work; the labels themselves meet the result in one sort-merge join,
    whose keys are spread evenly.
    """
    order = [order] if isinstance(order, str) else list(order)
    samples = F.col("samples") if "samples" in series.columns else None
    sized = series.select(key, *order, series_bytes(F.col("labels"), samples).alias("bytes"))
    if atomic not in ("family", "series"):
        raise ValueError(f"unknown unit: {atomic!r}")
    units = sized.groupBy(key, *order).agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    numbered = batch_numbers(units, key, order, max_series, max_bytes, partitions, fan)
    # Planning cannot tell how large generated series are, so neither side may be taken for a small one.
    numbers = numbered.select(*[F.col(c).alias(f"_{c}") for c in (key, *order)], "batch_no").hint("merge")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (key, *order)]
    return series.join(numbers, same).select(*[F.col(f"`{c}`") for c in series.columns], "batch_no")


def batch_stats(batched: DataFrame, key: str = "push_key", order: str = "family_ord") -> DataFrame:
    """Per batch: series, estimated bytes, first and last ordinal."""
    samples = F.col("samples") if "samples" in batched.columns else None
    return batched.groupBy(key, "batch_no").agg(
        F.count("*").alias("n_series"),
        F.sum(series_bytes(F.col("labels"), samples)).alias("est_bytes"),
        F.min(order).alias("first_ord"),
        F.max(order).alias("last_ord"),
    )
