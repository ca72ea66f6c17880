"""The write-request wire form: protocol-buffer fields built in the JVM, samples framed per batch."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the public write-request schema: field tags (number and wire type in one byte).
TAG_SERIES = 0x0A
TAG_LABEL = 0x0A
TAG_SAMPLE = 0x12
TAG_NAME = 0x0A
TAG_VALUE = 0x12
TAG_SAMPLE_VALUE = 0x09
TAG_SAMPLE_TIME = 0x10


def varint_sql(n: str) -> str:
    """Base-128 varint of a non-negative length, as text that holds the bytes."""
    more = f"if({n} < 16384, 1, if({n} < 2097152, 2, if({n} < 268435456, 3, 4)))"
    low = f"(shiftright({n}, 7 * i) & 127) + if(i < {more}, 128, 0)"
    wide = f"array_join(transform(sequence(0, {more}), i -> lpad(hex({low}), 2, '0')), '')"
    return f"if({n} < 128, char({n}), string(unhex({wide})))"


def _field(tag: int, body: str) -> str:
    """A length-prefixed field."""
    return f"concat(char({tag}), {varint_sql(f'octet_length({body})')}, {body})"


def _text_field(tag: int, c: str) -> str:
    """A text field; empty text is left out."""
    return f"if({c} = '', '', {_field(tag, c)})"


def labels_wire(labels: str) -> Column:
    """The label fields of one series, given the column's name.

    They are put together as text, whose bytes need not be valid characters, and turned into binary last.
    """
    body = f"concat({_text_field(TAG_NAME, 'x.name')}, {_text_field(TAG_VALUE, 'x.value')})"
    bodies = f"transform({labels}, x -> {body})"
    return F.expr(
        f"binary(array_join(transform({bodies}, b -> {_field(TAG_LABEL, 'b')}), ''))"
    )


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def sample_wire(value: float, timestamp: int) -> bytes:
    """One sample field; zero members are left out."""
    body = b"" if value == 0 else bytes([TAG_SAMPLE_VALUE]) + struct.pack("<d", value)
    if timestamp:
        body += bytes([TAG_SAMPLE_TIME]) + varint(timestamp)
    return bytes([TAG_SAMPLE, len(body)]) + body


def series_wire(labels: bytes, samples: Iterable[tuple[float, int]]) -> bytes:
    body = labels + b"".join(sample_wire(v, t) for v, t in samples)
    return bytes([TAG_SERIES]) + varint(len(body)) + body


def compress(raw: bytes) -> bytes:
    return pa.Codec("snappy").compress(raw, asbytes=True)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("bad varint")
        byte = data[at]
        at += 1
        n |= (byte & 127) << shift
        if byte < 128:
            return n, at
        shift += 7


def decompress(body: bytes) -> bytes:
    size, _ = read_varint(body, 0)
    # No input byte yields more than 64 output bytes, so a larger claim is corrupt.
    if size > 64 * len(body):
        raise ValueError("claimed size is too large")
    return pa.Codec("snappy").decompress(body, size, asbytes=True)


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a message as (number, value)."""
    at, end = 0, len(data)
    while at < end:
        # Tags and lengths are mostly of one byte.
        tag, at = (data[at], at + 1) if data[at] < 128 else read_varint(data, at)
        number, kind = tag >> 3, tag & 7
        if kind == 2:
            size, at = (data[at], at + 1) if at < end and data[at] < 128 else read_varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind == 0:
            value, at = read_varint(data, at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 5:
            value, at = data[at : at + 4], at + 4
        else:
            raise ValueError(f"bad wire type {kind}")
        if at > end:
            raise ValueError("truncated field")
        yield number, value


def _text(data: bytes) -> str:
    return data.decode("utf-8")


def _label(data: bytes) -> tuple[str, str]:
    got = dict(fields(data))
    return _text(got.get(1, b"")), _text(got.get(2, b""))


#: Labels up to this size mostly come again soon and are held; long ones are not.
SHORT = 64


@lru_cache(1 << 14)
def _short_label(data: bytes) -> tuple[str, str]:
    return _label(data)


def decode_series(data: bytes) -> tuple[list[dict], list[dict]]:
    labels, samples = [], []
    for number, value in fields(data):
        if number == 1:
            name, text = _short_label(value) if isinstance(value, bytes) and len(value) <= SHORT else _label(value)
            labels.append({"name": name, "value": text})
        elif number == 2:
            got = dict(fields(value))
            stamp = got.get(2, 0)
            samples.append(
                {
                    "value": struct.unpack("<d", got[1])[0] if 1 in got else 0.0,
                    "timestamp": stamp - (1 << 64) if stamp >> 63 else stamp,
                }
            )
    return labels, samples


def decode_body(body: bytes) -> list[tuple[list[dict], list[dict]]]:
    """All series of one compressed write request; raises when the body is corrupt."""
    return [decode_series(v) for n, v in fields(decompress(body)) if n == 1]
