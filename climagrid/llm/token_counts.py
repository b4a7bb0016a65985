"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A ``Rollup`` is a folder with delta tables and numbered versions of a list of the batches in force. A batch of changes (inserts with +,
deletes with -, revised counts as the difference) is summed by key and written once; the next version, which only one writer can make, commits
it. A writer that comes second looks again: a batch id counts once, and a compaction whose batches another one has replaced is
refused. Files that no version names are never read. Totals are sums over the deltas in force; ``compact`` folds them into one batch.

Counting runs in Arrow batches next to the scan with a public tokenizer file, whose folder is a parameter.

Defined results: NULL text has no tokens; NULL source and language are keys of their own; a key whose documents have all
gone is left out of the totals; empty batches can be committed; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climagrid.llm.common import bound_batches, stored, text_or_empty
from climagrid.sinks.manifest import Manifest

TOKENIZERS = "/opt/tokenizers"
VERSION = "byte_bpe_50k"
# Published split pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "version"]
MEASURES = ["n_docs", "n_tokens"]
_RUN = re.compile(r"[ \t-\r]{2,}")


def tokenizer(folder: str = TOKENIZERS, version: str = VERSION):
    """A byte-level BPE encoding made from its rank file."""
    import tiktoken

    with open(f"{folder}/{version}.tiktoken", "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(version, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def collapse(text: str) -> str:
    """Runs of two or more white-space characters become one space."""
    return _RUN.sub(" ", text)


def ledger(docs: DataFrame, folder: str = TOKENIZERS, version: str = VERSION) -> DataFrame:
    """Per row: id, key, text digest, tokens of the text, and tokens of the collapsed text where that differs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(folder, version).encode_ordinary
        for batch in batches:
            tokens, revised = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                tokens.append(len(encode(text)) if text else 0)
                other = collapse(text) if text else text
                revised.append(None if other == text else len(encode(other)))
            arrays = [pa.array(tokens, pa.int64()), pa.array(revised, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], ["doc_id", "source", "lang", "digest", "tokens", "revised"])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.sha2(text_or_empty(), 256).alias("digest"), "text",
    )
    counted = source.mapInArrow(count, "doc_id long, source string, lang string, digest string, tokens long, revised long")
    return counted.withColumn("version", F.lit(version))


def signed(rows: DataFrame, tokens, sign: int = 1) -> DataFrame:
    """Deltas of one row each."""
    return rows.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (sign * tokens).cast("long").alias("n_tokens"))


class Rollup:
    """Additive totals in a folder that all executors reach."""

    deltas_schema = T.StructType([T.StructField(k, T.StringType()) for k in KEYS] + [T.StructField(m, T.LongType()) for m in MEASURES])

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        # ``parts`` has the folder of each batch in force, ``taken`` the ids that counted once.
        self.versions = Manifest(spark, f"{self.folder}/log", {"parts": {}, "taken": []})

    def _write(self, deltas: DataFrame) -> str:
        """The deltas summed by key, in a folder that no version names yet."""
        part = uuid.uuid4().hex
        deltas.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES]).write.parquet(f"{self.folder}/parts/{part}")
        return part

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch; False, and nothing changes, if its id counted already."""
        version, now = self.versions.newest()
        if batch in now["taken"]:
            return False
        part = self._write(deltas)
        while batch not in now["taken"]:
            following = {"parts": now["parts"] | {batch: part}, "taken": [*now["taken"], batch]}
            if self.versions.create(version + 1, following):
                return True
            version, now = self.versions.newest()  # another writer was first
        return False

    def committed(self) -> DataFrame:
        """All deltas in force."""
        return self._read(self.versions.newest()[1]["parts"])

    def _read(self, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.deltas_schema)
        return self.spark.read.schema(self.deltas_schema).parquet(*[f"{self.folder}/parts/{p}" for p in parts.values()])

    def totals(self) -> DataFrame:
        summed = self.committed().groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return summed.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def compact(self, batch: str) -> bool:
        """Put one batch with their sums in the place of all batches in force; their ids stay taken.

        False, and nothing changes, if the id is taken or if another compaction has replaced one of the batches meanwhile.
        Batches that were committed meanwhile stay beside the new one.
        """
        version, now = self.versions.newest()
        old = now["parts"]
        if batch in now["taken"]:
            return False
        part = self._write(self._read(old))
        while batch not in now["taken"] and old.items() <= now["parts"].items():
            left = {b: p for b, p in now["parts"].items() if b not in old}
            if self.versions.create(version + 1, {"parts": {batch: part} | left, "taken": [*now["taken"], batch]}):
                return True
            version, now = self.versions.newest()
        return False


def maintain(docs: DataFrame, rollup: Rollup, folder: str = TOKENIZERS, version: str = VERSION) -> DataFrame:
    """Load all documents, revise the counts of collapsed texts, delete copies, and give the totals.

    * ``load`` inserts every row;
    * ``revise`` adds the difference for texts whose collapsed form has another count;
    * ``dedupe`` takes all rows of a text off and puts the one with the smallest id back, which needs no join;
    * ``dedupe`` is delivered twice, as a retried job would; the second delivery changes nothing.
    """
    bound_batches(docs.sparkSession)
    rows = stored(ledger(docs, folder, version), "ledger")
    rollup.commit("load", signed(rows, F.col("tokens")))
    changed = rows.where(F.col("revised").isNotNull())
    rollup.commit("revise", signed(changed, F.col("revised") - F.col("tokens")).withColumn("n_docs", F.lit(0).cast("long")))
    now = rows.withColumn("now", F.coalesce("revised", "tokens"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEYS, "now")).alias("c")
    kept = now.groupBy("digest").agg(first).select(*[f"c.{k}" for k in KEYS], "c.now")
    removal = signed(now, F.col("now"), -1).unionAll(signed(kept, F.col("now")))
    rollup.commit("dedupe", removal)
    rollup.commit("dedupe", removal)
    return rollup.totals()
