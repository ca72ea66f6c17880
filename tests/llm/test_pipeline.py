"""The pipeline against its parts done plainly, one text at a time."""

import os
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seriesship.llm import language, pieces, surrogates
from tests.llm import cases
from tests.llm.test_jaccard import brute as components
from tests.llm.test_winnow import brute as contaminated

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage, written and read again."""
    folder, out = str(tmp_path_factory.mktemp("stages")), []
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit(3), "_of": F.lit("x")})
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_and_names(spark, stages):
    assert [n for n, _ in stages] == ["language", "near copies", "benchmark", "personal data", "pieces"]
    want = spark.read.parquet(f"{SF}/documents.parquet").columns + ["score", "_of"]
    assert all(df.columns == want for _, df in stages[:-1])


def test_language(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = language.train(docs.where(corpus_pipeline.learned_from(docs)).select("text", "lang"))
    all_ = texts(docs)
    keep = {i for i, t in all_.items() if language.label(m, pa.array([t], pa.string()))[1][0] >= 0.5}
    assert set(texts(stages[0][1])) == keep and len(keep) > 0.9 * len(all_)


def test_near_copies(stages):
    before = texts(stages[0][1])
    want = {i for i, _, c in components(list(before.items())) if i == c}
    assert texts(stages[1][1]) == {i: before[i] for i in want}


def test_benchmark(spark, stages):
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(stages[1][1])
    assert texts(stages[2][1]) == {i: t for i, t in before.items() if not contaminated(t, items)[4]}


def test_personal_data(stages):
    before, after = texts(stages[2][1]), texts(stages[3][1])
    assert set(before) == set(after)
    for i, t in before.items():
        if re.search("[0-9@]", t):
            for value in re.findall(r"[\w.]+@[\w.]+\w|\b4[0-9]{15}\b|555-[0-9]{4}|AKIA[A-Z0-9]{16}", t):
                assert value not in after[i]
        else:
            assert after[i] == t
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3][1].collect())


def test_pieces(stages):
    v = pieces.Vocabulary.load(f"{corpus_pipeline.TOKENIZERS}/piece_bpe_32k.model")
    before = texts(stages[3][1])
    for r in stages[4][1].collect():
        assert r["decoded"] and v.decode(r["ids"]) == before[r["doc_id"]]


def test_odd_rows(spark):
    docs = cases.odd(spark)
    out = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert cases.ids(out.collect()) == [1, 3, 4, 5, 6, 7, 8, 9, None, None] and out.columns == docs.columns
    out = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert cases.ids(out.collect()) == cases.EXPECTED_IDS and out.columns == docs.columns
    out = corpus_pipeline.identify_language(spark, docs, SF)
    assert cases.ids(out.collect()) == [1, 1, 2, 7, 8, 9, None] and out.columns == docs.columns


def test_empty(spark):
    docs = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
