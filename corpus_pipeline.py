"""Corpus pipeline: toxicity, near-duplicates, benchmark passages, packing. Stages read and write Parquet tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm import decontaminate, minhash_join, packing, toxicity
from daymart.llm.common import checkpoint_dir, table
from daymart.llm.queries import settle, tokenizer, training_rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold stay, with all their columns, whatever these are named. The model is
    learnt from the labelled rows that are not held out; without enough labels nothing is dropped. Null and empty texts
    have a score and stay unless it reaches the threshold; a null or unknown language has the common threshold;
    repeated rows are judged alike and all kept or dropped; an empty table stays empty."""
    settle(spark)
    model = toxicity.train(training_rows(docs), training_rows(table(spark, sf_dir, "labels")))
    whole = docs.select(F.struct("*").alias("row"), docs["text"].alias("text"), docs["lang"].alias("lang"))
    return toxicity.score(whole, model).where("toxic_score < toxic_cut").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8): its smallest id, and
    of several texts under that id one; documents without an id count as larger than all ids. Different texts under one
    id that are no near copies of others all stay. Rows equal in id and text stay once. Documents without words (null
    and empty texts among them) belong to no group and stay. Columns of any name are kept as they are; an empty table
    stays empty."""
    settle(spark)
    whole = docs.select(F.struct("*").alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
                        F.xxhash64(docs["text"].cast("string")).alias("text_hash")).dropDuplicates(["doc_id", "text_hash"])
    kept = minhash_join.near_duplicates(docs, words=5).where("first") \
        .select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    same = whole["doc_id"].eqNullSafe(kept["kept_id"]) & (whole["text_hash"] == kept["kept_hash"])
    return whole.join(kept, same, "left_semi").select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item stay, with all their columns, whatever these are named. Null and empty
    texts, texts shorter than an item, and all documents if there are no items, stay; repeated rows are judged alike
    and all kept or dropped; an empty table stays empty."""
    settle(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of at most 1024 ids. A null text is empty, and an empty text is its end
    id alone; a null id stays null; repeated rows are packed each; other columns are not read; an empty table gives no
    pieces."""
    settle(spark)
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("benchmark", drop_benchmark),
          ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep; every stage's rows are a table in the shared folder."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
