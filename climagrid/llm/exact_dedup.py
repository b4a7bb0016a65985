"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when they are identical after each run of ASCII white space became one space.

1. Every row is listed with the key (a 64-bit hash) and the digest of its text. The directory comes from the distinct keys: it doubles (one
   more leading bit of the key) until no bucket holds more than ``bucket_entries`` keys; only overfull buckets split, the others keep
   their shorter prefix. Each directory cell points to its bucket.
2. Copies are combined where they are read (partial aggregation on key and text), so that a text held by a third of all rows
   leaves a map task once. The distinct texts go to the owner of their bucket: owner tasks have ranges of buckets and keys. An owner compares the
   bytes of all texts with one key and numbers those that differ: they are the chain of the key. It writes its buckets to the shared folder.
3. A document is looked up through its directory cell: the cell names the bucket, the bucket has the chain of the key, and in the
   chain the document's digest names the entry. Texts that hold over 1/1000 of the rows, at most 1000
   of them, are looked up in a broadcast table, all others in a shuffled join.

Only DataFrame functions are used. Defined results: NULL text counts as empty; a NULL doc_id is larger than
all others; rows with the same id and text are copies of each other, and the first by all its columns (as JSON) is kept;
empty tables give empty results; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.llm.common import broadcast_if_bounded, first_of_each, free, lookup, stored, text_or_empty

BUCKET_ENTRIES = 4096
HOT_SHARE = 1000
KEY_BITS = 64


def normal_text(name: str = "text") -> Column:
    """Each run of white space as one space; single spaces need no replacement."""
    return F.regexp_replace(text_or_empty(name), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def key_of(text: Column, bits: int = KEY_BITS) -> Column:
    """The leading ``bits`` of the hash of a text; the others are 0."""
    return F.xxhash64(text).bitwiseAND(F.lit(-(1 << (64 - bits))))


def _prefix(key: str | Column, depth: int) -> Column:
    """The leading ``depth`` bits of a key as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """(cell, local_depth, bucket, depth): the bucket of each cell that holds a key of ``keys`` (distinct ``key``).

    The directory is doubled until the fullest cell fits. A prefix of it is a bucket when it holds at most ``bucket_entries``
    keys and its parent holds more; ``bucket`` is the prefix and ``local_depth`` its bits.
    """
    depth = max(0, (keys.count() // bucket_entries).bit_length())
    while True:
        cells = stored(keys.groupBy(_prefix("key", depth).alias("cell")).agg(F.count(F.lit(1)).alias("n")), "cells")
        if depth == 64 or cells.where(F.col("n") > bucket_entries).isEmpty():
            break
        depth += 1
    ancestors = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth")).withColumn(
        "bucket", F.expr(f"shiftrightunsigned(cell, {depth} - local_depth)") if depth < 64 else F.expr("if(local_depth = 0, 0L, shiftrightunsigned(cell, 64 - local_depth))")
    )
    load = ancestors.groupBy("local_depth", "bucket").agg(F.sum("n").alias("load"))
    fits = ancestors.join(load, ["local_depth", "bucket"]).where((F.col("load") <= bucket_entries) | (F.col("local_depth") == depth))
    return (
        fits.groupBy("cell")
        .agg(F.min(F.struct("local_depth", "bucket")).alias("_b"))
        .select("cell", "_b.local_depth", "_b.bucket", F.lit(depth).alias("depth"))
    )


def _in_buckets(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` with the bucket that the directory gives for their key."""
    head = cells.select("depth").first()
    places = broadcast_if_bounded(cells.drop("depth"), 32)
    return rows.withColumn("cell", _prefix("key", head["depth"] if head else 0)).join(places, "cell").drop("cell")


def build_index(docs: DataFrame, cells: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """The stored index: bucket, key, place in the chain, digest, kept id and copies of each distinct text, in key order."""
    texts = (
        docs.select("doc_id", normal_text().alias("_text"))
        .withColumn("key", key_of(F.col("_text"), key_bits))
        .groupBy("key", "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    owner = ["bucket", "local_depth", "key"]
    owned = _in_buckets(texts, cells).repartitionByRange(*owner)
    # The window needs no further shuffle: an owner has all texts of its keys.
    chain = F.dense_rank().over(W.partitionBy(*owner).orderBy("_text"))
    return stored(
        owned.withColumn("chain", chain).select(*owner, "chain", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size"), "index"
    )


def report(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES, key_bits: int = KEY_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; one row per text is kept."""
    listed = docs.select("doc_id", normal_text().alias("_text")).select(
        "doc_id", key_of(F.col("_text"), key_bits).alias("key"), F.sha2("_text", 256).alias("text_sha256")
    )
    listed = stored(listed, "listed")
    cells = stored(directory(listed.select("key").distinct(), bucket_entries), "directory")
    index = build_index(docs, cells, key_bits)
    entry = index.select("bucket", "local_depth", "key", "text_sha256", "keep_id", "group_size")
    where = ["bucket", "local_depth", "key", "text_sha256"]
    rows = lookup(_in_buckets(listed, cells), entry, where, "group_size", listed.count(), F.xxhash64("doc_id"), HOT_SHARE)
    same_id = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Rows with one id and one text: one of them stays.
    again = W.partitionBy("text_sha256", "doc_id").orderBy(F.lit(0))
    firsts = rows.where(same_id).withColumn("kept", F.row_number().over(again) == 1)
    others = rows.where(~same_id).withColumn("kept", F.lit(False))
    return firsts.unionByName(others).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicated(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The kept rows with all columns of ``docs``.

    The list of kept (id, digest) is broadcast when it is small enough; texts move only if it is not.
    """
    ids = stored(report(docs, bucket_entries), "decisions")
    own_id, own_digest = free("dedup_id", docs), free("dedup_sha256", docs)
    names = [F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_digest)]
    digest = F.sha2(normal_text(), 256)
    same = (digest == F.col(own_digest)) & F.col("doc_id").eqNullSafe(F.col(own_id))
    rows = docs.join(broadcast_if_bounded(ids.where("kept").select(*names), 96), same, "left_semi")
    repeated = ids.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(repeated.select(*names), "repeated")
    if repeated.isEmpty():
        return rows
    # Only for rows that repeat both id and text: one row of each, the first by its columns.
    once = first_of_each(rows.join(repeated, same, "left_semi"), F.col("doc_id"), digest)
    return rows.join(repeated, same, "left_anti").unionByName(once)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""
