import json

import pytest
from pyspark.errors import AnalysisException

from seriesship import ClientConfig, PushConfig, Rule, decode_payloads, push, push_series
from seriesship.operators.outbox import Outbox
from seriesship.schema import FAMILIES, SERIES
from seriesship.sources import tables as S
from seriesship.streaming.intake import stream_push


def family(key, ord, name, *values):
    metrics = [
        {"labels": [{"name": "i", "value": str(i)}], "value": v} for i, v in enumerate(values)
    ]
    return {"push_key": key, "family_ord": ord, "name": name, "type": "GAUGE", "metrics": metrics}


def write(path, *families):
    path.write_text("".join(json.dumps(f) + "\n" for f in families))


def test_families_from_json_and_parquet(spark, tmp_path):
    write(tmp_path / "a.json", family("p", 0, "a", 1.0, 2.0), family("p", 1, "none"))
    rows = S.read_families(spark, str(tmp_path / "a.json"), "json")
    assert [(r.name, r.metric_ord, r.value) for r in rows.collect()] == [("a", 0, 1.0), ("a", 1, 2.0)]
    stored = spark.read.schema(FAMILIES).json(str(tmp_path / "a.json"))
    stored.write.parquet(str(tmp_path / "pq"))
    assert S.read_families(spark, str(tmp_path / "pq")).count() == 2
    with pytest.raises(AnalysisException):
        S.read_families(spark, str(tmp_path / "missing"))


def test_empty_pushes_send_nothing(spark):
    none = S.explode_families(spark.createDataFrame([], FAMILIES))
    assert push(none, PushConfig()).count() == 0
    assert push_series(spark.createDataFrame([], SERIES), PushConfig()).count() == 0


def test_invalid_rules_stop_a_push_before_reading(spark):
    none = S.explode_families(spark.createDataFrame([], FAMILIES))
    with pytest.raises(ValueError):
        push(none, PushConfig(rules=(Rule(target_label="invalid-label!"),)))


def test_record_files(spark, tmp_path):
    folder = tmp_path / "records"
    folder.mkdir()
    files = {
        f"{5:016x}.record": 3, "0a.record": 4, f"{(1 << 64) - 1:x}.record": 1, f"{7:016x}.tmp": 9,
        "x.record": 9, ".record": 9, f"{3:016x}.record.tmp": 9, "1ffffffffffffffff.record": 9,
    }
    for name, size in files.items():
        (folder / name).write_bytes(b"x" * size)
    records, stats = S.recover_records(S.list_record_files(spark, str(folder)))
    assert [(int(r.record_id), r.size_bytes) for r in records.collect()] == [(5, 3), (10, 4), ((1 << 64) - 1, 1)]
    r = stats.first()
    assert (r.records, int(r.max_id), r.total_bytes) == (3, (1 << 64) - 1, 8)


CFG = PushConfig(external_labels={"env": "t"}, now_ms=1000, max_series=3)


def families():
    return [family(k, o, f"m{o}", *[float(i) for i in range(o % 3 + 1)]) for k in "pq" for o in range(6)]


def contents(df, key):
    rows = decode_payloads(df).collect()
    return sorted(
        (r[key], r.series_ord, [tuple(x) for x in r.labels], [tuple(x) for x in r.samples]) for r in rows
    )


def test_stream_equals_batch(spark, tmp_path):
    intake = tmp_path / "in"
    intake.mkdir()
    for key in "pq":
        write(intake / f"{key}.json", *[f for f in families() if f["push_key"] == key])
    box = Outbox(spark, str(tmp_path / "outbox"))
    stream = S.read_families_stream(spark, str(intake), "json", files_per_trigger=1)
    run = (
        stream_push(stream, box, CFG)
        .option("checkpointLocation", str(tmp_path / "marks"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    batch = push(S.read_families(spark, str(intake), "json"), CFG)
    assert contents(box.records(), "queue") == contents(batch, "push_key")
    queues = {r.queue: r.n for r in box.records().groupBy("queue").agg({"*": "count"}).toDF("queue", "n").collect()}
    assert queues == {k: batch.where(f"push_key = '{k}'").count() for k in "pq"}


def test_push_stops_at_its_first_failed_batch(spark, tmp_path):
    write(tmp_path / "f.json", *families())
    metrics = S.read_families(spark, str(tmp_path / "f.json"), "json")
    total = push(metrics, CFG).where("push_key = 'p'").count()
    client = ClientConfig("http://h/{tenant}")
    ok = push(metrics, CFG, client, lambda u, h, b: {"status": 200}).where("queue = 'p'")
    assert ok.count() == total > 1
    failed = push(metrics, CFG, client, lambda u, h, b: {"status": 400}).where("queue = 'p'").collect()
    assert [(r.record_id, r.status) for r in failed] == [(1, 400)]


def test_tenant_and_headers_of_a_push(spark, tmp_path):
    write(tmp_path / "a.json", family("p", 0, "a", 1.0))
    metrics = S.read_families(spark, str(tmp_path / "a.json"), "json")
    cfg = PushConfig(now_ms=1, tenant="t/1", headers={"X-Scope": ("a", "b")})
    client = ClientConfig("http://h/{tenant}/w", tenant_header="X-Tenant")

    def echo(url, headers, body):
        return {"status": 400, "body": f"{url} {headers['X-Scope']} {headers['X-Tenant']}".encode()}

    [r] = push(metrics, cfg, client, echo).collect()
    assert (r.queue, r.body.decode()) == ("p", "http://h/t%2F1/w ['a', 'b'] ['t/1']")
    with pytest.raises(ValueError, match="x-tenant"):
        push(metrics, PushConfig(headers={"x-tenant": ("z",)}), client)
