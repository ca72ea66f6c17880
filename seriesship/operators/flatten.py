"""Metric families to labelled points: one generate over one scan for all five metric types."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.functions import labels as L
from seriesship.functions.text import format_bound

POINT_LIST = "array<struct<suffix:string,tag:string,bound:double,value:double>>"


def _point(suffix: str, tag: str | None, bound: str, value: str) -> str:
    tag = f"'{tag}'" if tag else "string(NULL)"
    return (
        f"named_struct('suffix', '{suffix}', 'tag', {tag}, 'bound', double({bound}), "
        f"'value', double({value}))"
    )


def _totals(column: str) -> str:
    total = _point("_sum", None, "NULL", f"{column}.sample_sum")
    return f"array({total}, {_point('_count', None, 'NULL', f'{column}.sample_count')})"


def _each(items: str, point: str) -> str:
    return f"coalesce(transform({items}, x -> {point}), CAST(array() AS {POINT_LIST}))"


# The ordered points of one metric; null when the value for its type is missing.
POINTS = f"""
CASE
  WHEN type IN ('COUNTER', 'GAUGE', 'UNTYPED') AND value IS NOT NULL THEN
    array({_point('', None, 'NULL', 'value')})
  WHEN type = 'HISTOGRAM' AND histogram IS NOT NULL THEN concat(
    {_each('histogram.buckets', _point('_bucket', 'le', 'x.upper_bound', 'x.cumulative_count'))},
    if(coalesce(exists(histogram.buckets, x -> x.upper_bound = double('Infinity')), false),
      CAST(array() AS {POINT_LIST}),
      array({_point('_bucket', 'le', "'Infinity'", 'histogram.sample_count')})),
    {_totals('histogram')})
  WHEN type = 'SUMMARY' AND summary IS NOT NULL THEN concat(
    {_each('summary.quantiles', _point('', 'quantile', 'x.quantile', 'x.value'))},
    {_totals('summary')})
END"""


def flatten(
    df: DataFrame,
    external: dict[str, str] | Column | None = None,
    now_ms: int | None = None,
) -> DataFrame:
    """Rows of ``FAMILY_METRICS`` to one row per series, in the order of the ordinals.

    ``external`` is a fixed set of labels or an array column (say, joined in per tenant). Labels that
    do not depend on the point are merged once per metric, before the generate.
    """
    now = int(time.time() * 1000) if now_ms is None else now_ms
    if isinstance(external, dict):
        # The metric name is always set, so an external one never applies.
        ext = L.literal_labels({k: v for k, v in external.items() if k != "__name__"})
        named = external.keys() & {"le", "quantile"}
    elif external is None:
        ext, named = None, set()
    else:
        ext, named = external, {"le", "quantile"}

    keys = [c for c in ("push_key", "family_ord", "metric_ord") if c in df.columns]
    own = L.present(F.col("labels"))
    if ext is not None and not named:
        own = F.concat(own, L.missing_from(own, ext))
    carried = [] if ext is None or not named else [ext.alias("ext")]
    per_point = df.select(
        *keys,
        "name",
        own.alias("own"),
        *carried,
        F.coalesce(F.col("timestamp_ms"), F.lit(now)).cast("bigint").alias("timestamp"),
        F.posexplode(F.expr(POINTS)).alias("point_ord", "point"),
    )
    # The bound's text sits in its own projection, so it is formed once per point.
    texted = per_point.select(
        *keys,
        "point_ord",
        F.concat("name", "point.suffix").alias("name"),
        F.when(
            F.col("point.tag").isNotNull(),
            F.array(L.pair(F.col("point.tag"), format_bound("point.bound"))),
        )
        .otherwise(L.no_labels())
        .alias("tag"),
        "own",
        *[F.col("ext") for _ in carried],
        F.col("point.value").alias("value"),
        "timestamp",
    )
    full = F.concat(F.array(L.pair("__name__", F.col("name"))), F.col("tag"), F.col("own"))
    merged = L.merge_external(full, F.col("ext")) if carried else L.sort_labels(full)
    return texted.select(*keys, "point_ord", merged.alias("labels"), "value", "timestamp")
