import random

import pyarrow as pa
import pytest

from seriesship import decode_payloads, encode_batches
from seriesship.functions import wire
from seriesship.operators.encode import split_corrupt
from seriesship.schema import LABELS, SAMPLES

SCHEMA = f"push_key string, batch_no bigint, ord bigint, labels {LABELS}, samples {SAMPLES}"


def write_request():
    """The public message types, built at run time as an independent encoder."""
    protobuf = pytest.importorskip("google.protobuf")
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    assert protobuf
    file = descriptor_pb2.FileDescriptorProto(name="w.proto", package="w", syntax="proto3")
    kinds = {"string": 9, "double": 1, "int64": 3, "message": 11}
    for name, fields in {
        "Label": [("name", 1, "string", None), ("value", 2, "string", None)],
        "Sample": [("value", 1, "double", None), ("timestamp", 2, "int64", None)],
        "Series": [("labels", 1, "message", "Label"), ("samples", 2, "message", "Sample")],
        "Request": [("timeseries", 1, "message", "Series")],
    }.items():
        m = file.message_type.add(name=name)
        for field, number, kind, of in fields:
            f = m.field.add(name=field, number=number, type=kinds[kind], label=3 if of else 1)
            if of:
                f.type_name = f".w.{of}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("w.Request"))


def case(rng, i):
    labels = [(rng.choice(["__name__", "é", "a" * 200, ""]), rng.choice(["", "v", "x" * 20_000, "日本"]))
              for _ in range(rng.randint(0, 4))]
    samples = [(rng.choice([0.0, 1.5, -2e300, 42.5]), rng.choice([0, 1, -5, 1_700_000_000_000]))
               for _ in range(rng.randint(0, 3))]
    return ("p" if i % 2 else "q", i % 3, i, labels, samples)


def test_bytes_equal_a_plain_marshal_and_decode_back(spark):
    rng = random.Random(2)
    rows = [case(rng, i) for i in range(40)]
    rows.append(("r", 0, 0, [("__name__", "m"), ("a", "1"), ("b", "2")],
                 [(42.5, 1_700_000_000_000), (43.5, 1_700_000_010_000)]))
    df = spark.createDataFrame(rows, SCHEMA)
    encoded = encode_batches(df, order="ord").persist()
    request = write_request()
    for r in encoded.collect():
        want = request()
        for k, no, _, labels, samples in sorted(rows, key=lambda x: x[2]):
            if (k, no) == (r.push_key, r.batch_no):
                s = want.timeseries.add()
                for name, value in labels:
                    s.labels.add(name=name, value=value)
                for value, at in samples:
                    s.samples.add(value=value, timestamp=at)
        raw = wire.decompress(bytes(r.body))
        assert raw == want.SerializeToString(deterministic=True)
        assert (r.raw_bytes, r.n_series) == (len(raw), len(want.timeseries))
        assert (r.content_type, r.content_encoding, r.protocol_version) == (
            "application/x-protobuf", "snappy", "0.1.0",
        )
    back = decode_payloads(encoded).orderBy("push_key", "batch_no", "series_ord").collect()
    want = sorted(rows, key=lambda x: (x[0], x[1], x[2]))
    assert [
        (r.push_key, r.batch_no, [tuple(x) for x in r.labels], [tuple(x) for x in r.samples]) for r in back
    ] == [(k, no, labels, samples) for k, no, _, labels, samples in want]


class Frame:
    """Stands for placed rows: hands the task function batches of them and keeps what it yields."""

    def __init__(self, batch):
        self.batch, self.dtypes = batch, [("push_key", "string")]

    def __getattr__(self, name):
        return lambda *a, **k: self

    columns = ("samples",)

    def mapInArrow(self, run, schema):  # noqa: N802
        self.out = list(run(iter([self.batch])))
        return self


def test_small_bodies_leave_a_task_together(spark):
    n = 2_500
    names = ["push_key", "batch_no", "label_bytes", "values", "stamps"]
    columns = [["p"] * n, list(range(n)), [b""] * n, [[1.0]] * n, [[7]] * n]
    frame = Frame(pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names))
    encode_batches(frame, order="ord")
    assert [b.num_rows for b in frame.out] == [1000, 1000, 500]
    assert [no for b in frame.out for no in b.column("batch_no").to_pylist()] == list(range(n))


def test_flattened_rows_encode_their_one_sample(spark):
    df = spark.createDataFrame(
        [("p", 0, 0, [("__name__", "m")], 2.0, 7)],
        f"push_key string, batch_no bigint, family_ord bigint, labels {LABELS}, value double, timestamp bigint",
    )
    [r] = decode_payloads(encode_batches(df)).collect()
    assert [tuple(s) for s in r.samples] == [(2.0, 7)]


def test_corrupt_bodies_are_set_apart(spark):
    good = wire.compress(wire.series_wire(b"", [(1.0, 1)]))
    bad = [b"not-an-envelope", b"", good[:-1], wire.compress(b"\x0a\xff"), b"\xff" * 12,
           pa.Codec("snappy").compress(b"\x0a\x05abc", asbytes=True)]
    rows = [(i, b) for i, b in enumerate([good, *bad, None])]
    ok, corrupt = split_corrupt(spark.createDataFrame(rows, "i int, body binary"))
    assert [r.i for r in ok.collect()] == [0]
    assert sorted(r.i for r in corrupt.collect()) == list(range(1, len(rows)))
    assert all(r.error for r in corrupt.collect())
