"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of ``documents``; the last returns them with the mix:
size, source_size, target and taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from climagrid.llm import decontamination, exact_dedup, mixing, ngram_join, toxicity
from climagrid.llm.common import scratch_scope
from climagrid.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to count as contaminated."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the number of words that the mix takes of them.

    A column that is called like one of the mix's own four is kept with an underscore behind its name.
    """
    return mixing.mix(docs, keep=[c for c in docs.columns if c.lower() != "doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# A trained model and MinHash candidates have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the documents of a folder. What a stage stores on its way goes when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
