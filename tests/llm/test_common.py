import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from seriesship.llm import common, jaccard, language, pieces
from seriesship.llm.queries import TOKENIZERS


def held_mb():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", f.read()))) / 1024


def use(pin):
    """150 MB in pieces that the allocator serves from its heap, and a small one above them that stays."""
    held = [np.ones(12_000) for _ in range(1600)]
    pin.append(np.ones(12_000))
    return pa.table({"n": [len(held)]})


@pytest.mark.parametrize("arity", ["batches", "group", "cogroup"])
def test_what_a_task_no_longer_holds_goes_back_to_the_system(arity):
    """Workers live on; without it each kept its most so far, beside the heap that the next stage needs."""
    pin = []

    def batches(many):
        for _ in many:
            yield use(pin)

    run = common.lean({"batches": batches, "group": lambda here: use(pin), "cogroup": lambda here, there: use(pin)}[arity])
    before = held_mb()
    out = list(run(iter([1]))) if arity == "batches" else [run(*range(1 + (arity == "cogroup")))]
    assert out[0].to_pylist() == [{"n": 1600}]
    assert held_mb() - before < 30
    use(pin)
    assert held_mb() - before > 100  # so an allocator would have kept it


def test_the_tasks_of_the_pipeline_give_memory_back(spark, monkeypatch):
    """Its stages share their workers, so what one stage's tasks kept was held through all the others."""
    docs = spark.createDataFrame([], "doc_id long, text string, grp long")
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, run, schema: run)
    share = spark.sparkContext.broadcast
    vocabulary = pieces.Vocabulary.load(f"{TOKENIZERS}/piece_bpe_32k.model")
    hot = share((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    runs = [language.annotate(docs, share(language.Model([]))), jaccard._survey(docs), jaccard._prefixes(docs, hot), pieces.encode(docs, vocabulary)]
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    for k, run in enumerate(runs):
        assert list(run(iter([]))) == [] and len(calls) == k + 1


def test_batches_for_the_workers_are_bounded_in_bytes(spark):
    """2000 texts of 20 KB came as one batch of 40 MB; a bound that the session has stays."""
    before = spark.conf.get(common._BATCH, None)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"bytes": [b.nbytes], "rows": [b.num_rows]})

    try:
        spark.conf.unset(common._BATCH)
        docs = spark.range(2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b "), 5000).alias("text"))
        language.annotate(docs, spark.sparkContext.broadcast(language.Model([])))
        found = docs.mapInArrow(sizes, "bytes long, rows long").collect()
        assert sum(r["rows"] for r in found) == 2000 and max(r["bytes"] for r in found) < 12 << 20
        spark.conf.set(common._BATCH, "1000000")
        common.bound_batches(spark)
        assert spark.conf.get(common._BATCH) == "1000000"
    finally:
        spark.conf.unset(common._BATCH) if before is None else spark.conf.set(common._BATCH, before)
