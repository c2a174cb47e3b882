"""Training reads every labelled row."""

from pyspark.sql import functions as F

from daymart.llm import toxicity


def test_words_of_late_rows_are_learnt(spark):
    """The toxic rows behind the 2000 of smallest hash carry a word that no other row has."""
    ids = spark.range(8000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    order = [r.doc_id for r in ids.where("toxic = 1").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").collect()]
    late = set(order[2000:])
    rows = [(k, f"plain words of row {k} " + ("fine" if k % 2 == 0 else "vile" if k in late else "awful"), "en")
            for k in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = toxicity.score(docs, toxicity.train(docs, ids)).collect()
    assert sum(r.toxic_score >= 0.7 for r in got if r.doc_id in late) >= 0.95 * len(late)
    assert sum(r.toxic_score >= 0.7 for r in got if r.doc_id % 2 == 0) <= 200


def test_rows_and_repeats(spark):
    """Every labelled row is dealt to one block, and repeats are one row with a count."""
    docs = spark.createDataFrame([(k % 300, f"row {k % 300} " + "a b c " * (k % 300), None) for k in range(900)],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 3 % 2) for k in range(200)], "doc_id long, toxic int")
    known = toxicity.known_rows(docs, labels, "doc_id", "text", "lang")
    assert known.count() == 600
    taken = [(len(texts), times.tolist()) for _, texts, _, times in toxicity.block_rows(known.toArrow().to_batches())]
    assert sum(n for n, _ in taken) == 200 and all(t == [3.0] * n for n, t in taken)
    model = toxicity.train(docs, labels)
    assert toxicity.output_counts(known, model)[["toxic", "clean"]].sum().sum() == 600
