"""Mix sources to target weights by weighted fair queueing.

Every source gets a share of a word budget. Documents queue inside their source in a
shuffled, repeatable order; the virtual finish time of a document is the source's words up to
and including it, divided by the source's target. Taking documents by finish time until the
budget is used serves all sources at the rate of their targets.

Sums along a queue never run through one task: a queue is cut into about sqrt(n) stretches by
the shuffle key, sums of stretches are added up first, and a window runs inside a stretch. The
same is done for the cut by the budget: finish times are counted in about sqrt(n) slots, and rows
are ordered one by one only inside the slot in which the budget ends.

Defined results: NULL text has size 0; size 0 is never taken; NULL is a source of its own, after
all others; a NULL id is shuffled by its text; equal shuffle keys (repeated rows) are ordered by id and size, and equal rows are
interchangeable; an empty table gives an empty result; other columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.llm.common import broadcast_if_bounded, free, stored, text_or_empty, words_by_space


def word_count(name: str = "text") -> Column:
    return F.size(words_by_space(text_or_empty(name))).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: int = 2
) -> DataFrame:
    """(source_rank, source, source_size, target) from rows of (source, size).

    Sources in code point order, NULL last, take ``weights`` in turn. ``share`` of all words is dealt by
    weight; no target exceeds ``cap`` times its source's size, and what is above goes to the others by weight.
    That is a water level: the sources that fill up first are those with the smallest size per weight.
    One row per source, so the windows over all rows see as many rows as there are sources.
    """
    everything = W.partitionBy()
    by_name = everything.orderBy(F.asc_nulls_last("source"))
    turn = F.array(*[F.lit(int(w)) for w in weights])
    table = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("_weight", F.get(turn, F.pmod(F.col("source_rank") - 1, F.lit(len(weights)))))
        .withColumn("_cap", F.col("source_size") * cap)
        .withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    )
    by_level = everything.orderBy("_full_at", "source_rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    budget = F.sum("source_size").over(everything) * F.lit(share)
    left = budget - (F.sum("_cap").over(by_level) - F.col("_cap"))
    weight_left = F.sum("_weight").over(everything) - (F.sum("_weight").over(by_level) - F.col("_weight"))
    levelled = table.withColumn("_level", left / weight_left)
    is_open = F.col("_full_at") > F.col("_level")
    level = F.min(F.when(is_open, F.struct("_full_at", "source_rank", "_level"))).over(everything)["_level"]
    target = F.when(is_open, level * F.col("_weight")).otherwise(F.col("_cap").cast("double"))
    return levelled.select("source_rank", "source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row, and the columns in ``keep``.

    ``taken`` counts words with repeats: a document is taken 0 to ``cap`` times. Each
    repeat of a queue goes through it in the same order, one after the other. A kept column that is called
    like one of the five is returned with an underscore behind its name.
    """
    if keep:
        # The columns to keep travel in a struct, where no name can clash.
        chosen = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept_columns"))
        mixed = _mix(chosen, weights, share, cap, ["kept_columns"])
        own = ["doc_id", "size", "source_size", "target", "taken"]
        return mixed.select(*own, *[F.col("kept_columns").getField(c).alias(free(c, mixed.select(*own))) for c in keep])
    return _mix(docs, weights, share, cap, [])


def _mix(docs: DataFrame, weights: Sequence[int], share: float, cap: int, keep: Sequence[str]) -> DataFrame:
    # Rows without an id are shuffled by their text, so that many of them do not meet in one stretch.
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text_or_empty())).cast("binary"))
    sized = stored(
        docs.select("doc_id", "source", *keep, word_count().alias("size"), key.alias("_key")), "sized"
    )
    rows = sized.count()
    cuts = math.isqrt(rows) + 1
    targets = stored(source_targets(sized.select("source", "size"), weights, share, cap), "targets")
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * share

    t = broadcast_if_bounded(targets, 1024)
    place = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    queued = (
        sized.join(t.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_stretch", F.shiftright(place * cuts, 32))
    )
    stretches = queued.groupBy("source_rank", "_stretch").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("source_rank").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = stretches.select(
        "source_rank", "_stretch", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("source_rank", "_stretch").orderBy("_key", "doc_id", "size")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    cum = F.col("_offset") + F.sum("size").over(upto)
    lined = stored(
        queued.join(offsets, ["source_rank", "_stretch"])
        .withColumn("_cum", cum)
        .withColumn("_row", F.row_number().over(inside))
        .drop("_offset"),
        "lined",
    )

    def finish(turn: Column | int) -> Column:
        return (F.col("_cum") + F.lit(turn) * F.col("source_size")) / F.col("target")

    # Finish times past 1 are past the targets; they share the last slots.
    def slot(time: Column) -> Column:
        return F.least(F.floor(time * cuts), F.lit(2 * cuts)).cast("long")

    identity = ["source_rank", "_stretch", "_row"]
    some = (F.col("size") > 0) & (F.col("target") > 0)
    turns = lined.where(some).select(
        *identity, "size", F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), finish(i).alias("time")) for i in range(cap)])).alias("_t")
    ).select(*identity, "size", "_t.*")
    slots = turns.groupBy(slot(F.col("time")).alias("_slot")).agg(F.sum("size").alias("_sum"))
    so_far = F.sum("_sum").over(W.partitionBy().orderBy("_slot"))
    edge = (
        slots.withColumn("_upto", so_far)
        .where(F.col("_upto") > budget)
        .orderBy("_slot")
        .select("_slot", (F.col("_upto") - F.col("_sum")).alias("_used"))
        .first()
    )
    if edge is None:
        times = sum((F.when(some, 1).otherwise(0) for _ in range(cap)), F.lit(0))
        chosen = lined.withColumn("taken", F.col("size") * times)
        return chosen.select("doc_id", "size", "source_size", "target", "taken", *keep)
    order = W.partitionBy().orderBy("time", "source_rank", "_stretch", "_row", "turn")
    used = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) + edge["_used"]
    fitting = (
        turns.where(slot(F.col("time")) == edge["_slot"])
        .withColumn("_used", used)
        .where(F.col("_used") <= budget)
        .groupBy(*identity)
        .agg(F.count(F.lit(1)).alias("_extra"))
    )
    fitting = broadcast_if_bounded(stored(fitting, "edge"), 64)
    whole = sum(
        (F.when(some & (slot(finish(i)) < edge["_slot"]), 1).otherwise(0) for i in range(cap)), F.lit(0)
    )
    taken = F.col("size") * (whole + F.coalesce(F.col("_extra"), F.lit(0)))
    return (
        lined.join(fitting, identity, "left")
        .withColumn("taken", taken)
        .select("doc_id", "size", "source_size", "target", "taken", *keep)
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))) AS k,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
  FROM d GROUP BY source),
w AS (SELECT *, list_value(3, 1, 2)[CAST((source_rank - 1) % 3 AS INTEGER) + 1] AS wt, 2 * source_size AS cap FROM s),
f AS (SELECT *, cap / CAST(wt AS DOUBLE) AS full_at FROM w),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - CAST(sum(cap) OVER o - cap AS DOUBLE))
    / CAST(sum(wt) OVER () - (sum(wt) OVER o - wt) AS DOUBLE) AS lev
  FROM f WINDOW o AS (ORDER BY full_at, source_rank ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT source, source_rank, source_size,
    CASE WHEN full_at > lev THEN (SELECT arg_min(lev, full_at) FROM l WHERE full_at > lev) * wt ELSE CAST(cap AS DOUBLE) END AS target
  FROM l),
q AS (
  SELECT d.doc_id, d.size, d.k, t.source_rank, t.source_size, t.target,
    sum(d.size) OVER (PARTITION BY t.source_rank ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (
  SELECT doc_id, source_rank, k, size, turn, CAST(cum + turn * source_size AS DOUBLE) / target AS fin
  FROM q, (VALUES (0), (1)) v(turn) WHERE size > 0 AND target > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY fin, source_rank, k, doc_id, turn ROWS UNBOUNDED PRECEDING) AS used FROM i),
n AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM c
  WHERE used <= (SELECT 1.5 * CAST(sum(size) AS DOUBLE) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(n.taken, 0) AS taken FROM q LEFT JOIN n USING (doc_id)
"""
