"""Ranked picks, neighbours in order, and storage order, safe for hot groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows written out per generated array when copies are expanded again.
REPEAT_CHUNK = 65_536

# Slices per shuffle partition: several, so that hashing them spreads evenly.
SLICES_PER_PARTITION = 4
# Rows whose hashes are the smallest of a table say which groups are cut into slices and where: at least so many rows, and
# so many for each slice. This sets the balance, not the result.
SAMPLE_ROWS = 10_000
SAMPLE_PER_SLICE = 20


def top1_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of every group in the given order.

    The rank filter sits directly on the window, so every map task already keeps
    one row per group and a hot group never reaches a single task as a whole.
    Give ``order_by`` a tie-break for a repeatable result.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order_by)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def deduplicate(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], keep_nulls: bool = True
) -> DataFrame:
    """One row per key; NULL keys form one group.

    Without ``keep_nulls`` a chosen row that holds a NULL anywhere is dropped, which is what
    picking it by a natural join of the table with itself amounts to.
    """
    chosen = top1_per_group(df, partition_by, order_by)
    if keep_nulls:
        return chosen
    return chosen.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in df.columns]))


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Write each row out ``count`` times and drop the count.

    Counts are cut into chunks that are dealt to all tasks before they are written
    out, so that a value holding a third of a table is not written by one of them.
    What is shuffled are counted rows, or for a check only its failing ones.
    """
    columns = [c for c in df.columns if c != count]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last_chunk = F.expr(f"(`{count}` - 1) div {REPEAT_CHUNK}")
    chunks = (
        df.where(F.col(count) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .repartition(tasks, *columns, "_chunk")
    )
    size = F.least(F.lit(REPEAT_CHUNK).cast("long"), F.col(count) - F.col("_chunk") * REPEAT_CHUNK)
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(*columns)


def _order_key(order: Sequence[str]) -> Column:
    """A struct that compares like the columns in order with NULLs last."""
    parts = [(F.col(c).isNull().alias(f"null_{i}"), F.col(c).alias(f"value_{i}")) for i, c in enumerate(order)]
    return F.struct(*[part for pair in parts for part in pair])


def _cuts(tuples: DataFrame, order: Sequence[str], group: Sequence[str], count: str, slices: int) -> DataFrame:
    """(group keys, blocks, heads): where the groups that hold more than one slice's share of all tuples are cut.

    The tuples with the smallest hashes are a sample that every run repeats. A group gets as many cuts as whole slices fit
    into its share of it, at quantiles; so all groups together have at most ``slices`` cuts. They come in blocks of about the
    square root of their number, with the last cut of each block but the final one in ``heads``.
    """
    rows = max(SAMPLE_ROWS, SAMPLE_PER_SLICE * slices)
    by_hash = tuples.where(F.col(count) > 0).orderBy(F.xxhash64(*group, *order), *group, *order).limit(rows)
    keys = [F.col(g).alias(f"_group_{i}") for i, g in enumerate(group)]
    found = by_hash.select(*keys, _order_key(order).alias("_key")).groupBy(*[f"_group_{i}" for i in range(len(group))])
    values = found.agg(F.sort_array(F.collect_list("_key")).alias("_keys"))
    number = F.floor(F.size("_keys") * F.lit(slices / rows)).cast("int")
    enough = values.withColumn("_number", number).where("_number > 0")
    places = F.sequence(F.lit(1), F.col("_number"))
    cut = F.transform(places, lambda i: F.get("_keys", F.floor(i / (F.col("_number") + 1) * F.size("_keys")).cast("int")))
    spaced = enough.withColumn("_cut", F.array_distinct(cut)).withColumn("width", F.ceil(F.sqrt(F.size("_cut"))).cast("int"))
    starts = F.sequence(F.lit(0), F.floor((F.size("_cut") - 1) / F.col("width")).cast("int"))
    blocks = F.transform(starts, lambda i: F.slice("_cut", i * F.col("width") + 1, F.col("width")))
    heads = F.transform(F.slice("blocks", 1, F.size("blocks") - 1), lambda block: F.element_at(block, -1))
    kept = [f"_group_{i}" for i in range(len(group))]
    return spaced.withColumn("blocks", blocks).select(*kept, "width", "blocks", heads.alias("heads"))


def _in_slices(tuples: DataFrame, order: Sequence[str], group: Sequence[str], count: str, slices: int) -> DataFrame:
    """``tuples`` with ``_key`` and ``_slice``: how many cuts of its group lie below a tuple, -1 in groups without cuts."""
    cuts = _cuts(tuples, order, group, count, slices)
    keyed = tuples.withColumn("_key", _order_key(order))
    entry = F.struct("width", "blocks", "heads").alias("_cuts")
    if group:
        # At most ``slices`` groups and cuts, by construction.
        table = F.broadcast(cuts.select(*[f"_group_{i}" for i in range(len(group))], entry))
        marked = keyed.join(table, _same_group(group), "left").drop(*[f"_group_{i}" for i in range(len(group))])
    else:
        marked = keyed.withColumn("_cuts", cuts.select(entry).scalar())

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda cut: cut < F.col("_key")))

    block = marked.withColumn("_block", below(F.col("_cuts.heads")))
    number = F.col("_block") * F.col("_cuts.width") + below(F.get("_cuts.blocks", F.col("_block")))
    # The count stands in it so that a condition on the slice stays above the aggregate, whose shuffle is then shared.
    uncut = F.col("_cuts").isNull() | (F.col(count) <= 0)
    return block.withColumn("_slice", F.when(uncut, -1).otherwise(number)).drop("_cuts", "_block")


def _same_group(group: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_group_{i}")) for i, g in enumerate(group)])


def with_neighbours(
    tuples: DataFrame, order: Sequence[str], group: Sequence[str] = (), count: str = "n", largest: Column | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ``_before`` and ``_after``, the order keys next to each tuple of (group, order) in its group, and ``_largest``.

    ``tuples`` are distinct and counted, ``count`` is their number of copies. Groups up to a slice's share of all tuples take one window by group. One window
    would put a larger group, or a table without groups, into one task: it is cut into slices at quantiles, and the window runs
    inside (group, slice). The first and last tuples of the slices, a table of at most two rows per slice, then say what lies
    beyond the ends. Everything is one lazy plan: the sample, the ends and the windows read the same shuffled tuples, so the input
    is read once.

    Keys are structs of (null_i, value_i) per order column, NULLs last; a missing neighbour is NULL. ``largest`` is
    an expression over a tuple whose maximum in the group is added.
    """
    if slices is None:
        slices = SLICES_PER_PARTITION * int(tuples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest = F.lit(None).cast("int") if largest is None else largest
    marked = _in_slices(tuples, order, group, count, slices)
    whole = W.partitionBy(*group, "_slice")
    inside = whole.orderBy("_key")
    rows = marked.select(
        "*", F.lag("_key").over(inside).alias("_before"), F.lead("_key").over(inside).alias("_after"), F.max(largest).over(whole).alias("_largest")
    )
    names = [F.col(g).alias(f"_group_{i}") for i, g in enumerate(group)]
    kept = [f"_group_{i}" for i in range(len(group))]
    ends = marked.where(F.col("_slice") >= 0).groupBy(*names, F.col("_slice").alias("_end_slice")).agg(
        F.min("_key").alias("_first"), F.max("_key").alias("_last"), F.max(largest).alias("_end_largest")
    )
    across = W.partitionBy(*(kept or [F.lit(0)]))
    ordered = across.orderBy("_end_slice")
    beyond = ends.select(
        *kept, "_end_slice", F.lag("_last").over(ordered).alias("_end_before"), F.lead("_first").over(ordered).alias("_end_after"),
        F.max("_end_largest").over(across).alias("_end_largest"),
    )
    meets = F.col("_slice") == F.col("_end_slice")
    joined = rows.join(F.broadcast(beyond), meets & _same_group(group) if group else meets, "left")
    return joined.select(
        *tuples.columns, F.coalesce("_before", "_end_before").alias("_before"), F.coalesce("_after", "_end_after").alias("_after"),
        F.coalesce("_end_largest", "_largest").alias("_largest"),
    )


def counted_lag(df: DataFrame, value: str, group: Sequence[str] = (), previous: str = "previous") -> DataFrame:
    """Rows of (group, value, previous, n): the value before each one, in value order, NULL last.

    Copies are counted before the shuffle. The first copy follows the previous
    distinct value, the other n - 1 follow their own value.
    """
    distinct = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    near = with_neighbours(distinct, [value], group, "_n")
    first = F.struct(F.col("_before.value_0").alias(previous), F.lit(1).cast("long").alias("n"))
    copies = F.struct(F.col(value).alias(previous), (F.col("_n") - 1).alias("n"))
    return (
        near.select(*group, value, F.explode(F.array(first, copies)).alias("_c"))
        .select(*group, value, "_c.*")
        .where(F.col("n") > 0)
    )


def lag_step(df: DataFrame, value: str, group: Sequence[str] = (), previous: str = "previous") -> DataFrame:
    """Every row's (group, value) with the value before it; NULL for the first."""
    return repeat_rows(counted_lag(df, value, group, previous), "n")


def counted_ranges(df: DataFrame, lower: str, upper: str, group: Sequence[str] = ()) -> DataFrame:
    """Ranges in (lower, upper) order as (group, lower, upper, next_lower, is_last, n), NULLs last.

    Copies are counted before the shuffle: the last copy of a range looks at the next distinct range, the
    others are followed by themselves. The last range of a group has its largest known lower bound and, of
    those, the largest known upper bound; one copy of it is marked.
    """
    counted = df.groupBy(*group, lower, upper).agg(F.count(F.lit(1)).alias("_n"))
    known = F.struct(F.col(lower).isNotNull(), F.col(lower), F.col(upper).isNotNull(), F.col(upper))
    near = with_neighbours(counted, [lower, upper], group, "_n", known)
    is_last = known.eqNullSafe(F.col("_largest"))
    last_copy = F.struct(F.col("_after.value_0").alias("next_lower"), is_last.alias("is_last"), F.lit(1).cast("long").alias("n"))
    copies = F.struct(F.col(lower).alias("next_lower"), F.lit(False).alias("is_last"), (F.col("_n") - 1).alias("n"))
    return (
        near.select(*group, lower, upper, F.explode(F.array(last_copy, copies)).alias("_c"))
        .select(*group, lower, upper, "_c.*")
        .where(F.col("n") > 0)
    )


def lead_gap(df: DataFrame, lower: str, upper: str, group: Sequence[str] = ()) -> DataFrame:
    """Every range with the next lower bound in order and a mark on the last one."""
    return repeat_rows(counted_ranges(df, lower, upper, group), "n")


def sort_mart(df: DataFrame, order_by: Sequence[str | Column], spread: Sequence[str] = ()) -> DataFrame:
    """Global order; ``spread`` columns let a hot leading value span several tasks."""
    return df.orderBy(*order_by, *spread)


def storage_order(df: DataFrame, order_by: Sequence[str | Column], spread: Sequence[str] = ()) -> DataFrame:
    """Range-partitioned and sorted inside each file: what a stored mart needs."""
    keys = [*order_by, *spread]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
