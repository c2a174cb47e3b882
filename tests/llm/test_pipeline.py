"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import os

import pytest

import corpus_pipeline
from daymart.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages(spark, tmp_path):
    docs, kept = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept.append((name, before, docs))
    for name, before, after in kept[:-1]:
        assert after.columns == before.columns
        assert after.exceptAll(before).count() == 0
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    _, before, after = kept[1]
    want = {i for i, (_, _, keep) in brute.near_duplicates(list(texts(before).items()), 5).items() if keep}
    assert set(texts(after)) == want
    _, before, after = kept[2]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {i for i, *_ in brute.contamination(list(texts(before).items()), items)}
    assert set(texts(after)) == set(texts(before)) - bad and bad
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(texts(after))


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(4, long), (2, long + " more"), (None, long), (None, "another text without any id"), (7, None), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as set_id", "2 as hashes")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert left.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in left.collect() if r.text is not None)
    assert got == sorted([("2", long + " more"), ("None", "another text without any id"), ("8", "")])
    assert left.where("doc_id = 7").count() == 1
