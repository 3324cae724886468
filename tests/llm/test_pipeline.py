"""The pipeline: every stage's decisions take effect and hold against plain versions."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ngram_join, quality
from tests.llm.test_text_operators import LOWER, _components, _contamination, _sets


def test_stages_are_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        docs = spark.createDataFrame(docs.toArrow(), schema=docs.schema)
        out.append(docs)
    return out


def _rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_all_stages_but_the_last_return_the_columns_of_documents(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_stages_against_plain_versions(spark, small, stages):
    given, good, distinct, clean, redacted, packed = stages
    labels = spark.read.parquet(f"{small}/labels.parquet")
    accepted = {r["doc_id"] for r in quality.classify(given, labels).where("predicted = 1").collect()}
    assert set(_rows(good)) == accepted
    groups = _components(_sets(_rows(good).items(), ngram_join.WIDTH), ngram_join.PERCENT)
    assert set(_rows(distinct)) == {i for i, (_, c, _) in groups.items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, v in _contamination(_rows(distinct).items(), items, 13, 20).items() if v[4]}
    assert set(_rows(clean)) == set(_rows(distinct)) - bad
    before, after = _rows(clean), _rows(redacted)
    assert before.keys() == after.keys()
    for i, text in after.items():
        parts = text.split("[SECRET]")
        assert before[i].startswith(parts[0]) and before[i].endswith(parts[-1])
        assert not re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", text)
    assert packed.where(F.length("ids_crc32") == 0).count() == 0
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(after)
    assert LOWER


def test_run_gives_the_pieces_of_all_kept_documents(spark, small, stages):
    got = corpus_pipeline.run(spark, small)
    assert got.agg(F.sum("length")).first()[0] == stages[-1].agg(F.sum("length")).first()[0]
