"""Committed folders: jobs show whole or not at all, streams read each commit once."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seriesship.schema import FAMILIES, REQUESTS, SERIES
from seriesship.sources import committed as C
from seriesship.sources import tables as S


@pytest.fixture
def path(spark, tmp_path):
    C.register(spark)
    return str(tmp_path / "folder")


def series(spark, *ords, key="k"):
    rows = [(key, o, [("__name__", f"m{o}")], [(float(o), o), (float("inf"), 1)]) for o in ords]
    return spark.createDataFrame(rows, SERIES)


def ords(df):
    return sorted(r.ord for r in df.select("ord").collect())


def stored(path):
    return [os.path.join(d, f) for d, _, files in os.walk(os.path.join(path, C.FILES)) for f in files if not f.startswith(".")]


def test_round_trip_of_all_three(spark, path):
    rows = {
        "metric_series": series(spark, 1, 2),
        "metric_families": spark.createDataFrame(
            [("p", 0, "n", "HISTOGRAM", [([("a", None)], None, None, ([(0.5, 3)], 1.5, 3), None)]), ("p", 1, "e", "GAUGE", []), (None, None, None, None, None)], FAMILIES
        ),
        "write_requests": spark.createDataFrame(
            [(1, "q", "t", b"\x00\xff", "a", "b", "c", {"h": ["1", "2"], "e": []}, 5, 2), (2, None, None, None, None, None, None, None, None, None)], REQUESTS
        ),
    }
    for name, df in rows.items():
        df.write.format(name).mode("append").save(path + name)
        back = spark.read.format(name).load(path + name)
        assert back.dtypes == df.dtypes
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert S.read_families(spark, path + "metric_families", "metric_families").count() == 1


def test_append_and_overwrite(spark, path):
    write = lambda mode, *o: series(spark, *o).write.format("metric_series").mode(mode).save(path)
    write("append", 1, 2)
    write("append", 3)
    write("append")  # no rows
    assert ords(spark.read.format("metric_series").load(path)) == [1, 2, 3]
    write("overwrite", 9)
    assert ords(spark.read.format("metric_series").load(path)) == [9]
    assert C.Folder(path).numbers() == [0, 1, 2, 3]


def test_a_failed_job_leaves_nothing(spark, path):
    series(spark, 1).write.format("metric_series").mode("append").save(path)
    before = stored(path)
    broken = spark.range(0, 40, numPartitions=4).select(
        F.lit("k").alias("push_key"), F.when(F.col("id") < 35, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("bigint").alias("ord"),
        F.lit(None).cast("array<struct<name:string,value:string>>").alias("labels"),
        F.lit(None).cast("array<struct<value:double,timestamp:bigint>>").alias("samples"),
    )
    with pytest.raises(PySparkException):
        broken.write.format("metric_series").mode("append").save(path)
    assert ords(spark.read.format("metric_series").load(path)) == [1]
    assert stored(path) == before and C.Folder(path).numbers() == [0]


def test_files_of_killed_tasks_are_never_read(spark, path):
    """A task that was killed after it wrote its file has no message; the commit of its job removes the file."""
    writer = C.BatchWriter(path, series(spark, 1).schema, False)
    lost = writer.write(series(spark, 8).toArrow().to_batches())
    kept = writer.write(series(spark, 1).toArrow().to_batches())
    assert len(stored(path)) == 2 and C.Folder(path).files() == []
    assert spark.read.format("metric_series").load(path).count() == 0  # nothing is committed yet
    writer.commit([kept, None])
    assert ords(spark.read.format("metric_series").load(path)) == [1]
    assert not os.path.exists(os.path.join(path, C.FILES, lost.name))


def test_commits_side_by_side_take_different_numbers(spark, path):
    writers = [C.BatchWriter(path, series(spark, 1).schema, False) for _ in range(3)]
    messages = [w.write(series(spark, i).toArrow().to_batches()) for i, w in enumerate(writers)]
    os.makedirs(os.path.join(path, C.COMMITS))
    folder = C.Folder(path)
    folder.numbers = list  # each believes that it comes first
    for w, m in zip(writers, messages):
        folder.commit(w.job, [m], False)
    assert C.Folder(path).numbers() == [0, 1, 2]
    assert ords(spark.read.format("metric_series").load(path)) == [0, 1, 2]


def run(stream, out, marks, name="metric_series", **options):
    writer = stream.writeStream.format(name).option("checkpointLocation", marks).options(**options)
    query = writer.trigger(availableNow=True).start(out)
    query.awaitTermination()


def test_a_stream_reads_each_commit_once(spark, path, tmp_path):
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    for turn, o in enumerate([(1, 2), (3,), (4, 5)]):
        series(spark, *o).write.format("metric_series").mode("append").save(path)
        run(spark.readStream.format("metric_series").load(path), out, marks)
        assert len(C.Folder(out).numbers()) == turn + 1
    assert ords(spark.read.format("metric_series").load(out)) == [1, 2, 3, 4, 5]


def test_a_micro_batch_written_again_changes_nothing(spark, path):
    schema = series(spark, 1).schema
    for _ in range(2):
        writer = C.StreamWriter(path, schema, False, "s")
        writer.commit([writer.write(series(spark, 1).toArrow().to_batches())], 0)
    other = C.StreamWriter(path, schema, False, "t")
    other.commit([other.write(series(spark, 2).toArrow().to_batches())], 0)
    assert ords(spark.read.format("metric_series").load(path)) == [1, 2] and len(stored(path)) == 2
    again = other.write(series(spark, 3).toArrow().to_batches())
    other.abort([again, None], 1)
    assert ords(spark.read.format("metric_series").load(path)) == [1, 2] and len(stored(path)) == 2


def test_wrong_columns_and_paths_are_refused(spark, path):
    with pytest.raises(PySparkException, match="takes the columns"):
        spark.range(3).write.format("metric_series").mode("append").save(path)
    with pytest.raises(PySparkException, match="FileNotFound"):
        spark.read.format("metric_series").load(path).count()


def test_small_files_share_a_task():
    files = [(f"f{i}", C.PART_BYTES // 4) for i in range(9)] + [("large", 3 * C.PART_BYTES), ("last", 1)]
    parts = [p.names for p in C._parts(files)]
    assert [len(p) for p in parts] == [4, 4, 1, 1, 1] and sum(parts, []) == [n for n, _ in files]
