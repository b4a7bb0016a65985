"""Merkle manifest of a dataset: one digest for all rows, and a proof per row.

A leaf is the SHA-256 of a row's fields, each with its length. Per source, leaves ascend by doc_id; every ``FAN_OUT`` consecutive nodes
become the digest of their concatenated hex digests until one node, the subroot, remains. Subroots in order of their sources form the
top tree in the same way, whose last node is the root.

* Nodes get their place in their group without a window over the group: they are sorted by ranges, rows are counted per group
  and range partition, and a row's place is what the partitions before it hold plus its place in its own.
* Nodes of an aligned block of ``BLOCK`` places (a power of the fan-out) become one row that keeps every level of the block as one string of
  concatenated hex digests. Parents are digests of its fixed-width substrings. A node's siblings on a level are the two
  substrings that flank it in its run, so paths are cut from the level strings and no node is joined with its siblings.
* The last digests of the blocks are the nodes of the next round, which climbs in the same way; a round divides the number
  of nodes by ``BLOCK``. A group with one block takes no more levels than leave one node.

Level strings are kept as bytes, so that a substring is cut without counting characters from the start. A row of a block holds
at most ``BLOCK`` nodes, whatever the size of a source; texts are hashed where they are read and never shuffled.

Defined results: NULL fields are written as ``-``, so they differ from empty ones; NULL is the first source and the first doc_id; rows
with one doc_id are ordered by their leaf, and equal rows are interchangeable (they are spread by their place in the input); a row without a
doc_id is never tampered with; an empty table gives an empty result; other columns are neither read nor hashed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.llm.common import broadcast_if_bounded, lower_ascii, stored

FAN_OUT = 16
LEVELS = 3  # of a block
BLOCK = FAN_OUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_RUN = _HEX * FAN_OUT
_NO_PATH = "array<struct<left:binary,right:binary>>"


def field_bytes(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(v) for v in values]), 256)


def in_order(nodes: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` with ``pos``, the place of each in its group from 0, and ``size``, the nodes of the group."""
    keys = [group, *order, "_place"]
    placed = nodes.withColumn("_place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    rows = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", 33)
    runs = rows.groupBy(group, part.alias("_part")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per group and partition that holds it.
    whole = W.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select(
        F.col(group).alias("_group"), "_part", F.sum("_n").over(whole).alias("size"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part"))
    offsets = _small(offsets, "_group", 32, f"{name}-offsets")
    return rows.join(offsets, same).withColumn("pos", F.col("_id") + F.col("_shift")).drop("_id", "_group", "_part", "_shift")


def _small(table: DataFrame, group: str, others: int, name: str) -> DataFrame:
    """Stored, and broadcast if rows of the widest group and ``others`` more bytes fit."""
    table = stored(table, name)
    width = table.agg(F.coalesce(F.max(F.octet_length(F.col(group).cast("string"))), F.lit(0))).first()[0]
    return broadcast_if_bounded(table, width + others)


def parents(level: Column) -> Column:
    """The level above: the digest of every run of the fan-out's width."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / _RUN).cast("int"))
    digests = F.transform(runs, lambda i: F.sha2(F.substring(level, i * _RUN + 1, F.lit(_RUN)), 256))
    return F.array_join(digests, "").cast("binary")


def block_rows(nodes: DataFrame, group: str, keep: Sequence[str], name: str) -> DataFrame:
    """(group, block, members, levels, several) from (group, pos, size, hash, keep): a row for each aligned block."""
    block = F.floor(F.col("pos") / BLOCK).cast("long")
    member = F.struct("pos", "hash", *keep)
    blocks = nodes.groupBy(group, block.alias("block")).agg(
        F.array_sort(F.collect_list(member)).alias("members"), (F.max("size") > BLOCK).alias("several")
    )
    leaves = F.array_join(F.transform("members", lambda m: m["hash"]), "").cast("binary")
    rows = blocks.withColumn("levels", F.array(leaves))
    for _ in range(LEVELS):
        last = F.element_at("levels", -1)
        grown = F.concat("levels", F.array(parents(last)))
        rows = rows.withColumn("levels", F.when(F.col("several") | (F.octet_length(last) > _HEX), grown).otherwise(F.col("levels")))
    return stored(rows, f"{name}-blocks")


def with_tops(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Block rows with ``top``, the last node of the group, and ``above``, the siblings from the block up to it."""
    last = F.element_at("levels", -1).cast("string")
    alone = rows.where("not several").withColumn("top", last).withColumn("above", F.array().cast(_NO_PATH))
    nodes = stored(rows.where("several").select(group, F.col("block").alias("pos"), last.alias("hash")), f"{name}-tops")
    if nodes.isEmpty():
        return alone
    sizes = nodes.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("size"))
    sized = nodes.join(_small(sizes, "_group", 8, f"{name}-sizes"), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    upper = paths(with_tops(block_rows(sized, group, [], f"{name}-up"), group, f"{name}-up"), group, [], ["top"])
    found = upper.select(F.col(group).alias("_group"), F.col("pos").alias("_block"), "top", F.col("path").alias("above"))
    mine = F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block"))
    return alone.unionByName(rows.where("several").join(found, mine).drop("_group", "_block"))


def _flanks(run: Column, at: Column) -> Column:
    """What is left and right of place ``at`` of a run."""
    left, right = F.substring(run, F.lit(1), at * _HEX), F.substring(run, (at + 1) * _HEX + 1, F.lit(_RUN))
    return F.named_struct(F.lit("left"), left, F.lit("right"), right)


def paths(blocks: DataFrame, group: str, keep: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """(group, pos, hash, keep, carry, path) of every member of block rows with ``above``.

    ``path`` holds the siblings of each level, as what is left and what is right of the node in its run. The
    members of a run share all levels but the first, so those are cut once per run.
    """
    inner = F.slice("levels", 2, F.greatest(F.size("levels") - 2, F.lit(0)))

    def of_run(run: Column) -> Column:
        def upper(level: Column, depth: Column) -> Column:
            at = F.floor(run / F.pow(F.lit(float(FAN_OUT)), depth)).cast("int")
            return _flanks(F.substring(level, F.floor(at / FAN_OUT).cast("int") * _RUN + 1, F.lit(_RUN)), F.pmod(at, F.lit(FAN_OUT)))

        first = F.substring(F.element_at("levels", 1), run * _RUN + 1, F.lit(_RUN))
        return F.named_struct(
            F.lit("members"), F.slice("members", run * FAN_OUT + 1, F.lit(FAN_OUT)),
            F.lit("first"), F.when(F.size("levels") > 1, first),
            F.lit("rest"), F.concat(F.transform(inner, upper), F.col("above")),
        )

    # What a run needs is cut before the rows are multiplied, so that no row carries the strings of its block along.
    numbers = F.sequence(F.lit(0), F.floor((F.size("members") - 1) / FAN_OUT).cast("int"))
    runs = blocks.select(group, *carry, F.transform(numbers, of_run).alias("_runs")).select(group, *carry, F.explode("_runs").alias("_run"))
    cut = runs.select(
        group, *carry, F.posexplode("_run.members").alias("_at", "_m"), F.col("_run.first").alias("_first"), F.col("_run.rest").alias("_rest")
    )
    path = F.when(F.col("_first").isNull(), F.col("_rest")).otherwise(F.concat(F.array(_flanks(F.col("_first"), F.col("_at"))), F.col("_rest")))
    return cut.select(group, F.col("_m.pos").alias("pos"), F.col("_m.hash").alias("hash"), *[F.col(f"_m.{c}").alias(c) for c in keep], *carry, path.alias("path"))


def fold(start: Column, path: Column) -> Column:
    """The last node, recomputed from a leaf and its siblings."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node.cast("binary"), s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string")), ""), 256)


def manifest(docs: DataFrame, also: Sequence[Column] = ()) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path) of every row, and the values ``also`` computed from it.

    ``path`` is the proof: the siblings of every level from the leaf to the root.
    """
    leaf = leaf_digest([F.col(c) for c in FIELDS]).alias("hash")
    chosen = docs.select(*FIELDS).select("doc_id", "source", leaf, *also)
    keep = [c for c in chosen.columns if c not in ("source", "hash")]
    ordered = in_order(stored(chosen, "leaves"), "source", ["doc_id", "hash"], "ordered")
    blocks = with_tops(block_rows(ordered, "source", keep, "source"), "source", "source").withColumnRenamed("top", "subroot")
    subroots = stored(blocks.where("block = 0").select("source", F.col("subroot").alias("hash"), F.lit(0).alias("_all")), "subroots")
    top = paths(with_tops(block_rows(in_order(subroots, "_all", ["source"], "sources"), "_all", ["source"], "all"), "_all", "all"), "_all", ["source"], ["top"])
    top = top.select(F.col("source").alias("_source"), F.col("top").alias("root"), F.col("path").alias("_top_path"))
    levels = top.agg(F.coalesce(F.max(F.size("_top_path")), F.lit(0))).first()[0]
    roots = _small(top, "_source", _HEX + levels * (_RUN + 32), "roots")
    joined = blocks.join(roots, F.col("source").eqNullSafe(F.col("_source"))).withColumn("above", F.concat("above", "_top_path"))
    rows = paths(joined, "source", keep, ["subroot", "root"])
    return rows.select("doc_id", "source", F.col("hash").alias("leaf"), "subroot", "root", "path", *[c for c in keep if c != "doc_id"])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row, some of them tampered with.

    Tampering lower-cases A-Z of the texts whose id's crc32 is divisible by 5.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = leaf_digest([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    rows = manifest(docs, [F.when(tampered, changed).alias("changed")])
    rows = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# The same trees level by level: nodes are grouped, and every row is joined with the nodes of its runs.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
    sha256(f(CAST(doc_id AS VARCHAR)) || f(source) || f(lang) || f(CAST(n_chars AS VARCHAR)) || f(text)) AS leaf,
    sha256(f(CAST(doc_id AS VARCHAR)) || f(source) || f(lang) || f(CAST(n_chars AS VARCHAR)) ||
      f(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS lowered,
    xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, v: xor(xor(a, v) // 2, 3988292384 * (xor(a, v) % 2))), 4294967295) % 5 = 0 AS tampered
  FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS cnt FROM d),
lv AS (
  SELECT source, 0 AS lvl, pos, leaf AS h, cnt FROM n
  UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), max((cnt + 15) // 16) FROM lv WHERE cnt > 1 GROUP BY source, lvl, pos // 16),
sub AS (
  SELECT source, h AS subroot, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS cnt FROM lv WHERE cnt = 1),
tv AS (
  SELECT 0 AS lvl, place AS pos, subroot AS h, cnt FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), max((cnt + 15) // 16) FROM tv WHERE cnt > 1 GROUP BY lvl, pos // 16),
seg AS (
  SELECT n.rid, lv.lvl AS step, lv.pos, lv.h, sign(lv.pos - n.pos // CAST(pow(16, lv.lvl) AS BIGINT)) AS side
  FROM n JOIN lv ON lv.source IS NOT DISTINCT FROM n.source AND lv.cnt > 1 AND lv.pos // 16 = n.pos // CAST(pow(16, lv.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT n.rid, sub.height + tv.lvl, tv.pos, tv.h, sign(tv.pos - sub.place // CAST(pow(16, tv.lvl) AS BIGINT))
  FROM n JOIN sub ON sub.source IS NOT DISTINCT FROM n.source JOIN tv ON tv.cnt > 1 AND tv.pos // 16 = sub.place // CAST(pow(16, tv.lvl + 1) AS BIGINT)),
step AS (
  SELECT rid, step, coalesce(string_agg(h, '' ORDER BY pos) FILTER (side < 0), '') AS l, coalesce(string_agg(h, '' ORDER BY pos) FILTER (side > 0), '') AS r
  FROM seg GROUP BY rid, step),
fold AS (
  SELECT rid, 0 AS step, CASE WHEN tampered AND text IS NOT NULL THEN lowered ELSE leaf END AS h FROM d
  UNION ALL
  SELECT fold.rid, fold.step + 1, sha256(l || h || r) FROM fold JOIN step ON step.rid = fold.rid AND step.step = fold.step),
proof AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, max(step) + 1 AS steps FROM step GROUP BY rid)
SELECT n.doc_id, n.leaf, sub.subroot, tv.h AS root, coalesce(proof.proof, sha256('')) AS proof_sha256, fold.h AS folded_root, fold.h = tv.h AS verified
FROM n JOIN sub ON sub.source IS NOT DISTINCT FROM n.source JOIN tv ON tv.cnt = 1
LEFT JOIN proof ON proof.rid = n.rid JOIN fold ON fold.rid = n.rid AND fold.step = coalesce(proof.steps, 0)
"""
for _value in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "text"):
    ORACLE = ORACLE.replace(f"f({_value})", f"coalesce(CAST(strlen({_value}) AS VARCHAR) || ':' || {_value}, '-')")
_lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = ORACLE.replace(f"f({_lowered})", f"coalesce(CAST(strlen({_lowered}) AS VARCHAR) || ':' || {_lowered}, '-')")
