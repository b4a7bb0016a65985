"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from climagrid.llm import (
    chat, decontamination, exact_dedup, lm_scoring, merkle, mixing, ngram_join, repair, secret_scan, token_counts, token_files, toxicity, warc,
)
from climagrid.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(_table(spark, folder, "documents"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.report(_table(spark, folder, "documents"))


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(_table(spark, folder, "documents"))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.report(_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    return token_counts.maintain(_table(spark, folder, "documents"), rollup)


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = chat.with_conflict(_table(spark, folder, "conversations"), spark)
    return chat.digests(chat.format_conversations(conversations))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """The derived records of every page; texts and bytes as digests and lengths."""
    records = warc.derivatives(warc.response_records(_table(spark, folder, "pages")))
    return records.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest",
        F.length("content").cast("long").alias("content_chars"), F.sha2("record", 256).alias("record_sha256"),
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.report(_table(spark, folder, "conversations"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.report(_table(spark, folder, "documents"))


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the token files of all documents to the shared folder and reads them back."""
    path = scratch_path(spark, "tokens")
    token_files.write(_table(spark, folder, "documents"), path)
    return token_files.report(spark, path)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py`` on all documents."""
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_exact_dedup, op3_secret_scans, op4_ngram_join, op5_token_counts, op6_chat_formatting,
        op7_decontamination, op8_warc_derivatives, op9_toxicity, op10_mixing,
        op11_conversation_repair, op12_merkle_manifest, op13_token_files, pipeline,
    )
}
ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE, "op7_decontamination": decontamination.ORACLE, "op10_mixing": mixing.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
