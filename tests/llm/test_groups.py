"""Large groups of near copies around the threshold, and the pipeline's stages on odd rows."""

import random

import pytest

import corpus_pipeline
from daymart.llm import minhash_join, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def copies(n, edits, seed):
    """Texts around one base, each with its own changed words; some further apart than others."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(120)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        if k % 4 == 0:
            words = words[:rnd.randint(90, 120)]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [1024, 7])
def test_borderline_groups_lose_no_link(spark, monkeypatch, block):
    queries.settle(spark)
    monkeypatch.setattr(minhash_join, "BLOCK_SETS", block)
    texts = copies(150, 12, 1) + copies(60, 8, 2) + copies(40, 30, 3) + ["common words here"] * 5 + [None, "", "one"]
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_join.near_duplicates(df, words=2).collect()
    want = brute.near_duplicates(rows, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    assert len({c for _, c, _ in want.values()}) > 5


def test_blocks_join_classes_that_leaders_missed(spark, monkeypatch):
    """Without any leader link, blocks alone find the classes."""
    queries.settle(spark)
    monkeypatch.setattr(minhash_join, "BLOCK_SETS", 9)
    real = minhash_join._confirm
    monkeypatch.setattr(minhash_join, "_confirm", lambda *a: real(*a).where("false"))
    rows = list(enumerate(copies(80, 10, 4)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df, words=2).collect()}
    assert got == brute.near_duplicates(rows, 2)


LONG = " ".join(f"w{i}" for i in range(30))
ODD = [(4, LONG), (2, LONG + " more"), (2, "a different text under the same id that nobody copies"), (None, LONG),
       (None, "without any id"), (7, None), (8, ""), (9, "x " * 20_000), (9, "x " * 20_000)]
CLASH = ["'mine' as _id", "'mine' as _text", "'mine' as _doc", "9.5 as toxic_score", "0.1 as toxic_cut", "1 as row",
         "2 as doc", "3 as text_hash", "4 as kept_id", "'y' as set_id"]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("doc_id", "text", "cast(null as string) lang", *CLASH)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:3]])
def test_stages_keep_columns_of_any_name(spark, stage):
    docs = odd(spark)
    left = stage(spark, docs, SF)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    assert left.exceptAll(docs).count() == 0 and left.count() >= 5
    assert left.select("_id", "_doc", "toxic_score", "row").distinct().count() == 1
    assert stage(spark, docs.where("false"), SF).count() == 0


def test_texts_under_one_id_are_judged_alone(spark):
    left = corpus_pipeline.drop_near_duplicates(spark, odd(spark), SF).select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), (r.text or "")[:12]) for r in left) == sorted(
        [("2", (LONG + " more")[:12]), ("2", "a different "), ("None", "without any "), ("7", ""), ("8", ""), ("9", "x x x x x x ")])


def test_packing_takes_odd_rows(spark):
    got = corpus_pipeline.pack(spark, odd(spark), SF).collect()
    ends = {}
    for r in got:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    assert sum(r.length for r in got) == sum(ends.values())  # gapless
    assert sorted(r.length for r in got if r.doc_id in (7, 8)) == [1, 1]
    assert corpus_pipeline.pack(spark, odd(spark).where("false"), SF).count() == 0
