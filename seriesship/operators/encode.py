"""Batches to compressed write requests and back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesship.config import CONTENT_ENCODING, CONTENT_TYPE, PROTOCOL_VERSION
from seriesship.functions import wire
from seriesship.schema import LABELS, SAMPLES

ROWS_PER_SLICE = 32
#: Encoded bodies leave a task together: so many, or so many bytes, whichever comes first.
BODIES, BODY_BYTES = 1000, 4 << 20


def encode_batches(
    batched: DataFrame, key: str = "push_key", order: list[str] | str = "family_ord"
) -> DataFrame:
    """One request row per (key, batch_no), its series in order.

    Rows are placed by batch, so one key's batches spread over the cluster, and a task holds the series of one body
    at a time, beside a few small finished ones. Label bytes are made by Spark expressions; the task adds samples and
    compresses.
    """
    order = [order] if isinstance(order, str) else list(order)
    samples = (
        F.col("samples")
        if "samples" in batched.columns
        else F.array(F.struct(F.col("value"), F.col("timestamp")))
    )
    by = [key, "batch_no"]
    placed = (
        batched.select(*by, *order, "labels", samples.alias("samples"))
        .repartition(*by)
        .sortWithinPartitions(*by, *order)
        .select(
            *by,
            wire.labels_wire("labels").alias("label_bytes"),
            F.col("samples.value").alias("values"),
            F.col("samples.timestamp").alias("stamps"),
        )
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, done, size = [], None, [], 0

        def finish():
            raw = b"".join(held)
            done.append((*current, len(held), len(raw), wire.compress(raw)))
            return len(done[-1][-1])

        def finished():
            types = [key_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        names = [key, "batch_no", "n_series", "raw_bytes", "body"]
        for batch in batches:
            key_type = batch.schema.field(0).type
            cols = [batch.column(i).to_pylist() for i in range(5)]
            for k, no, labels, values, stamps in zip(*cols):
                if (k, no) != current:
                    if current is not None:
                        size += finish()
                        if len(done) >= BODIES or size >= BODY_BYTES:
                            yield finished()
                            done, size = [], 0
                    held, current = [], (k, no)
                held.append(wire.series_wire(labels, zip(values or (), stamps or ())))
        if current is not None:
            finish()
            yield finished()

    kind = dict(batched.dtypes)[key]
    schema = f"`{key}` {kind}, batch_no bigint, n_series bigint, raw_bytes bigint, body binary"
    return placed.mapInArrow(encode, schema).select(
        "*",
        F.lit(CONTENT_TYPE).alias("content_type"),
        F.lit(CONTENT_ENCODING).alias("content_encoding"),
        F.lit(PROTOCOL_VERSION).alias("protocol_version"),
    )


def _per_body(
    names: list[str], rows: Callable[[bytes], list[tuple]], types: list[tuple[str, pa.DataType]]
):
    """A task that keeps the given columns and adds the rows a body turns into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few bodies at a time, because each may hold thousands of series.
            for lo in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(lo, ROWS_PER_SLICE)
                index, out = [], []
                bodies = part.column(part.schema.get_field_index("body")).to_pylist()
                for i, body in enumerate(bodies):
                    got = rows(body)
                    index.extend([i] * len(got))
                    out.extend(got)
                kept = part.select(names).take(pa.array(index, pa.int64()))
                cols = list(zip(*out)) if out else [()] * len(types)
                added = [pa.array(c, t) for c, (_, t) in zip(cols, types)]
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *added], names=[*names, *[n for n, _ in types]]
                )

    return run


LABEL_LIST = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
SAMPLE_LIST = pa.list_(pa.struct([("value", pa.float64()), ("timestamp", pa.int64())]))


def _kept_schema(df: DataFrame, names: list[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{n}` {types[n]}" for n in names)


def decode_payloads(df: DataFrame) -> DataFrame:
    """Series of every intact body, numbered in order; corrupt bodies yield no rows."""
    names = [c for c in df.columns if c != "body"]

    def rows(body):
        try:
            return [(i, a, b) for i, (a, b) in enumerate(wire.decode_body(body))]
        except (ValueError, OSError, TypeError):
            return []

    types = [("series_ord", pa.int64()), ("labels", LABEL_LIST), ("samples", SAMPLE_LIST)]
    schema = f"{_kept_schema(df, names)}, series_ord bigint, labels {LABELS}, samples {SAMPLES}"
    return df.mapInArrow(_per_body(names, rows, types), schema)


def with_body_error(df: DataFrame) -> DataFrame:
    """Add ``error``: null when the body decodes, otherwise what is wrong with it."""
    names = list(df.columns)

    def rows(body):
        try:
            wire.decode_body(body)
        except (ValueError, OSError, TypeError) as e:
            return [(str(e) or type(e).__name__,)]
        return [(None,)]

    run = _per_body(names, rows, [("error", pa.string())])
    return df.mapInArrow(run, f"{_kept_schema(df, names)}, error string")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Intact records and corrupt ones with their ``error``.

    Persist ``with_body_error`` and filter it instead where both sides are used.
    """
    checked = with_body_error(df)
    return checked.where("error is null").drop("error"), checked.where("error is not null")
