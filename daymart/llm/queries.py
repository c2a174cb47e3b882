"""One query per training-data operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm import (chat, decontaminate, html_extract, line_dedup, minhash_join, packing, permuterm, ppm,
                         token_counts, toxicity, turn_repair, vector_join, warc)
from daymart.llm.common import table
from daymart.session import configure

ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def settle(spark: SparkSession) -> None:
    """Engine settings; batches of whole texts stay small next to a worker's memory."""
    configure(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def training_rows(docs: DataFrame, held_out: bool = False) -> DataFrame:
    fold = F.pmod(F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), F.lit(3)) == 1
    return docs.where(fold if held_out else ~fold)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(training_rows(docs), training_rows(table(spark, sf_dir, "labels")))
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == 1
    return toxicity.score(docs.select("doc_id", "text", "lang"), model).select(
        "doc_id", held.alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.CUT).cast("int").alias("predicted"),
        (F.col("toxic_score") >= F.col("toxic_cut")).alias("rejected"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), words=2) \
        .select("doc_id", "n_shingles", "component_id", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


EXTRA = [(0, "user"), (1, "assistant")]


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer("byte_bpe_50k.json")
    said = f"{chat.END}{chat.START}assistant ok"
    extra = spark.createDataFrame([(-1, turn, role, said) for turn, role in EXTRA],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    nodes, members = chat.format_chats(rows, vocabulary)
    read = chat.read_back(nodes, vocabulary)
    return members.join(read, "path").drop("path")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.group_variants(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_html_extraction, op3_warc, op4_packing, op5_toxicity, op6_minhash_near_dedup,
    op7_token_counts, op8_decontamination, op9_lm_scoring, op10_chat_formatting,
    op11_conversation_repair, op12_spelling_variants, op13_line_dedup)}
ORACLE = {"op8_decontamination": decontaminate.ORACLE, "op13_line_dedup": line_dedup.ORACLE}


def _settled(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {name: _settled(fn) for name, fn in QUERIES.items()}
