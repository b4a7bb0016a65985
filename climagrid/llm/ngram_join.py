"""Similarity join of documents on five-word n-grams: MinHash banding, then exact verification.

1. Each text becomes its set of hashed five-word sequences, a MinHash signature and its band hashes. Bands and rows per
   band are chosen for a target recall at the threshold (``choose_bands``). Texts with one and the same set are one node with a
   number of copies from here on; copies never meet each other.
2. Nodes are shuffled on their band hashes. In a bucket, nodes are compared with its pivots only, by signature: a node becomes a
   pivot unless one is very near, and is connected with all pivots that are not far. By the triangle inequality two nodes above the
   threshold share a pivot's neighbourhood. At most two links are written per node; buckets of more than ``SALT_ROWS`` nodes are cut by a
   salt, and the pivots of the parts meet in a second round.
3. Connected candidates are verified on their full n-gram sets: all pairs of a component are compared inside tasks, in blocks of
   bounded size when it is large. What leaves a task is a number of links and a root per node, never a list of pairs.

Every document gets the class of its connected links (the smallest doc_id in it) and its number of links: other documents,
copies included, with a Jaccard similarity of at least the threshold.

Words are those of letters, digits and non-ASCII, A-Z lowered. Texts of fewer than five words have one n-gram of all their words; texts
without words (NULL, empty) link to nothing. Rows with one id and text are copies; a NULL id is larger than all others; equal similarities
at the threshold count; an empty table gives an empty result; other columns are ignored. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.llm import tokens
from climagrid.llm.common import bound_batches, broadcast_if_bounded, components, first_of_each, free, lookup, stored, text_or_empty

THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
# Signature similarities; the noise of an estimate is about 0.04.
TIGHT, LOOSE = 0.8, 0.4
SALT_ROWS = 20_000
BLOCK_NODES = 1_024
BLOCK_GRAMS = 400_000
_U = np.uint64


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the most rows whose bands reach ``recall`` at the threshold within ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches the recall with so few hashes")
    return best


def minhash(grams: np.ndarray, count: int) -> np.ndarray:
    """``count`` minima of differently scrambled 32-bit hashes."""
    seeds = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)[:, None]
    low = np.full(count, 0xFFFFFFFF, np.uint32)
    x = (grams >> _U(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), 2048):
            y = (x[i : i + 2048] ^ seeds) * np.uint32(0x85EBCA6B)
            y ^= y >> np.uint32(15)
            y *= np.uint32(0xC2B2AE35)
            y ^= y >> np.uint32(13)
            np.minimum(low, y.min(1), out=low)
    return low


def _identity(grams: np.ndarray) -> int:
    """One number of a set of n-grams, whatever their order."""
    with np.errstate(over="ignore"):
        both = tokens.mix(grams).sum(dtype=np.uint64) ^ (tokens.mix(grams ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64) * _U(3))
        return int(tokens.mix(np.array([both + _U(len(grams))]))[0].astype(np.int64))


def gram_sets(texts: list, n: int) -> Iterator[np.ndarray]:
    for part in tokens.chunks(texts):
        words, first, _ = tokens.hashes(part, tokens.BY_LETTER)
        for i in range(len(part)):
            yield tokens.shingles(words[first[i] : first[i + 1]], n)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row_key, node, grams, sig (a byte of each hash) and band hashes of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(1, bands + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
        for batch in batches:
            node, grams, sig, band = [], [], [], []
            for found in gram_sets(batch.column(2).to_pylist(), n):
                grams.append(len(found))
                if not len(found):
                    node.append(None), sig.append(None), band.append([])
                    continue
                low = minhash(found, bands * rows)
                node.append(_identity(found))
                sig.append((low & np.uint32(255)).astype(np.uint8).tobytes())
                value = number.copy()
                with np.errstate(over="ignore"):
                    for column in low.reshape(bands, rows).T:
                        value = tokens.mix(value * _U(3) + column)
                band.append(value.view(np.int64))
            arrays = [pa.array(node, pa.int64()), pa.array(grams, pa.int64()), pa.array(sig, pa.binary()), pa.array(band, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], ["doc_id", "row_key", "node", "grams", "sig", "bands"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), "text")
    return source.mapInArrow(sign, "doc_id long, row_key long, node long, grams long, sig binary, bands array<long>")


def row_key():
    return F.xxhash64("doc_id", text_or_empty())


def _canopies(members: DataFrame, tight: float, loose: float, partitions: int) -> DataFrame:
    """(bucket, a, b) from (bucket, salt, node, large, sig): links that connect nodes and pivots of one bucket.

    A node is linked to the first pivot that is not far; further ones are linked to that pivot unless the bucket's links connect them
    already, so a bucket has at most two links per node. For large buckets (pivot, pivot) rows name the pivots.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, pivots = None, 0, []
        table, label = np.empty((0, 0), np.uint8), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            buckets, salts, nodes, large = (batch.column(i).to_pylist() for i in range(4))
            sigs = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            out: list[tuple[int, int, int]] = []
            for i in range(batch.num_rows):
                if key != (buckets[i], salts[i]):
                    key, count, pivots = (buckets[i], salts[i]), 0, []
                group, is_pivot = count, True
                if count:
                    same = (table[:count] == sigs[i]).mean(1)
                    near = np.flatnonzero(same >= loose)
                    if len(near):
                        first = near[0]
                        group = label[first]
                        out.append((key[0], nodes[i], pivots[first]))
                        others, places = np.unique(label[near], return_index=True)
                        for other, place in zip(others, places):
                            if other != group:
                                out.append((key[0], pivots[near[place]], pivots[first]))
                                label[:count][label[:count] == other] = group
                        is_pivot = same[near].max() < tight
                if not is_pivot:
                    continue
                if count >= len(table):
                    size = max(8, 2 * count)
                    grown, labels = np.empty((size, sigs.shape[1]), np.uint8), np.empty(size, np.int64)
                    if count:
                        grown[:count], labels[:count] = table[:count], label[:count]
                    table, label = grown, labels
                table[count], label[count] = sigs[i], group
                count += 1
                pivots.append(nodes[i])
                if large[i]:
                    out.append((key[0], nodes[i], nodes[i]))
            columns = [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "a", "b"])

    dealt = members.repartition(partitions, "bucket", "salt").sortWithinPartitions("bucket", "salt", "node")
    return dealt.select("bucket", "salt", "node", "large", "sig").mapInArrow(run, "bucket long, a long, b long")


def candidate_links(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes that may be similar, linear in the sizes of the buckets; ``nodes`` is (node, sig, bands)."""
    spark = nodes.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    salts = F.ceil(F.col("n") / SALT_ROWS)
    members = rows.join(several, "bucket").select(
        "bucket", "node", F.pmod(F.xxhash64("node"), salts).alias("salt"), (F.col("n") > SALT_ROWS).alias("large")
    )
    sigs = nodes.select("node", "sig")
    near = stored(_canopies(members.join(sigs, "node"), TIGHT, LOOSE, partitions), "near")
    # Pivots of the parts of a large bucket meet each other; the bound allows for one more step of distance.
    pivots = near.where("a = b").select(
        "bucket", F.col("a").alias("node"), F.lit(0).cast("long").alias("salt"), F.lit(False).alias("large")
    ).distinct()
    links = near.where("a <> b").select("a", "b")
    if not pivots.isEmpty():
        far = _canopies(pivots.join(sigs, "node"), TIGHT, LOOSE - 0.15, partitions)
        links = links.unionAll(far.where("a <> b").select("a", "b"))
    return links.distinct()


def _verify(threshold: float):
    types = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("alone", pa.bool_())])

    def run(table: pa.Table) -> pa.Table:
        left, right = table["i"][0].as_py(), table["j"][0].as_py()
        nodes, firsts = np.unique(table["node"].to_numpy(), return_index=True)
        block, copies = table["block"].to_numpy()[firsts], table["copies"].to_numpy()[firsts]
        sets = [np.frombuffer(table["set"][int(f)].as_buffer(), np.uint64) for f in firsts]
        sizes = np.array([len(s) for s in sets])
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        a = np.flatnonzero(block == left)
        b = a if left == right else np.flatnonzero(block == right)
        links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        if len(a) and len(b):
            inside = np.concatenate([ids[starts[k] : starts[k] + sizes[k]] for k in b])
            offsets = np.concatenate(([0], np.cumsum(sizes[b])[:-1]))
            marks = np.zeros(ids.max() + 1, bool)
            for k in a:
                own = ids[starts[k] : starts[k] + sizes[k]]
                marks[own] = True
                common = np.add.reduceat(marks[inside], offsets, dtype=np.int64)
                marks[own] = False
                near = b[(common >= threshold * (sizes[k] + sizes[b] - common) - 1e-9) & (b != k)]
                if len(near):
                    links[k] += copies[near].sum()
                    if left != right:
                        links[near] += copies[k]
                    joined = np.unique(label[np.append(near, k)])
                    if len(joined) > 1:
                        label[np.isin(label, joined)] = joined[0]
        alone = np.full(len(nodes), table["blocks"][0].as_py() == 1)
        return pa.Table.from_arrays([pa.array(nodes), pa.array(links), pa.array(nodes[label]), pa.array(alone)], schema=types)

    return run


def linked(docs: DataFrame, threshold: float = THRESHOLD, n: int = 5, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): the rows with their node, and per node its copies, class (smallest id and its row key) and links."""
    bound_batches(docs.sparkSession)
    bands, per_band = choose_bands(threshold, recall, max_hashes)
    rows = stored(signatures(docs, n, bands, per_band), "signatures")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    nodes = stored(
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(first).alias("first"), F.min("row_key").alias("text_key"), F.max("grams").alias("grams"), F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "nodes",
    )
    roots = components(candidate_links(nodes.select("node", "sig", "bands")), "candidates")
    sized = roots.join(nodes.select("node", "copies", "grams", "text_key"), "node")
    group = sized.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("grams").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_GRAMS)).cast("long")
    members = stored(
        sized.join(group, "root").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .select("node", "root", "copies", "text_key", "blocks", "block"),
        "members",
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            wanted = batch.column(names.index("node")).to_pylist()
            packed = [g.tobytes() if len(g) and _identity(g) == w else None for g, w in zip(gram_sets(batch.column(names.index("text")).to_pylist(), n), wanted)]
            rest = [batch.column(i) for i, c in enumerate(names) if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(packed, pa.binary())], [c for c in names if c != "text"] + ["set"])

    keyed = docs.select(row_key().alias("text_key"), "text").join(broadcast_if_bounded(members, 48), "text_key")
    fields = "node long, root long, copies long, blocks long, block long"
    texts = keyed.select(*[f.split()[0] for f in fields.split(", ")], "text")
    packed = texts.mapInArrow(sets, fields + ", set binary").where(F.col("set").isNotNull())
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    pairs = packed.select("*", others).select(
        "node", "root", "copies", "blocks", "block", "set",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    partial = stored(
        pairs.groupBy("root", "i", "j").applyInArrow(_verify(threshold), "node long, links long, root long, alone boolean"), "verified"
    )
    several = partial.where(~F.col("alone") & (F.col("node") != F.col("root"))).select(F.col("node").alias("a"), F.col("root").alias("b"))
    final = components(several, "classes")
    # A node of a large component gets its root from all its blocks, any other node from its only task.
    single = partial.groupBy("node").agg(F.sum("links").alias("links"), F.min(F.when(F.col("alone"), F.col("root"))).alias("own"))
    verified = single.join(final, "node", "left").select("node", "links", F.coalesce("own", "root", "node").alias("class"))
    known = nodes.select("node", "copies", "first").join(verified, "node", "left").select(
        "node", "copies", "first", F.coalesce("class", "node").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    known = stored(known, "known")
    head = known.groupBy("class").agg(F.min("first").alias("head"))
    named = known.join(head, "class").select(
        "node", "copies", F.col("head.doc_id").alias("class_id"), F.col("head.row_key").alias("class_key"), "n_links"
    )
    return rows.select("doc_id", "row_key", "node", "grams"), stored(named, "classes")


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links, n_grams and kept of every row; one row of each class is kept."""
    rows, nodes = linked(docs.select("doc_id", "text"), threshold)
    found = lookup(rows, nodes, ["node"], "copies", rows.count(), F.xxhash64("row_key"))
    wordless = F.col("node").isNull()
    first = F.when(wordless, F.lit(True)).otherwise(F.col("row_key") == F.col("class_key"))
    again = W.partitionBy("row_key").orderBy(F.lit(0))
    place = found.where(first & ~wordless).withColumn("kept", F.row_number().over(again) == 1)
    others = found.where(~first | wordless).withColumn("kept", wordless)
    return place.unionByName(others).select(
        "doc_id", F.when(wordless, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("grams").alias("n_grams"), "kept",
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class and all documents without words, with all columns of ``docs``, whatever their names.

    Of rows with one id and one text, the first by all its columns (as JSON) stays.
    The keys of the rows that go are broadcast when they are few enough.
    """
    rows, nodes = linked(docs.select("doc_id", "text"), threshold)
    own = free("ngram_key", docs)
    kept = nodes.select("class_key").distinct()
    gone = rows.where(F.col("node").isNotNull()).join(kept, F.col("row_key") == F.col("class_key"), "left_anti")
    gone = stored(gone.select(F.col("row_key").alias(own)).distinct(), "gone")
    same = row_key() == F.col(own)
    left = docs.join(broadcast_if_bounded(gone, 16), same, "left_anti")
    repeated = rows.where(F.col("node").isNotNull()).groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(repeated.select(F.col("row_key").alias(own)), "repeated")
    if repeated.isEmpty():
        return left
    once = first_of_each(left.join(repeated, same, "left_semi"), row_key())
    return left.join(repeated, same, "left_anti").unionByName(once)
