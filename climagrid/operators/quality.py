"""Data-quality checks: each returns the rows that break its rule.

A comparison with NULL is neither true nor false, so rows with NULL pass the
row rules. Row rules also exist as plain conditions (``bad_*``), so that a suite
can count many of them in one pass over a table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climagrid.functions.text import slugify
from climagrid.operators.calendar import add_parts
from climagrid.operators.ordering import counted_lag, counted_ranges, repeat_rows
from climagrid.operators.sets import except_both_ways
from climagrid.operators.shape import kept_columns, not_null_share


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- row rules -----------------------------------------------------------------


def bad_range(column, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = _column(column)
    broken = F.lit(False)
    if min_value is not None:
        broken = broken | ~((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        broken = broken | ~((c <= max_value) if inclusive else (c < max_value))
    return broken


def bad_expression(expression: str, column: str | None = None) -> Column:
    """``expression`` is a whole condition, or its right-hand part after ``column``."""
    return ~F.expr(f"({expression})" if column is None else f"({column} {expression})")


def bad_empty_string(column, trim_whitespace: bool = True) -> Column:
    c = _column(column)
    return (F.trim(c) if trim_whitespace else c) == ""


def bad_null(column) -> Column:
    return _column(column).isNull()


def bad_value(column, accepted: Sequence) -> Column:
    return ~_column(column).isin(list(accepted))


def bad_pair(actual, expected) -> Column:
    return _column(actual) != _column(expected)


def dq_accepted_range(df, column, min_value=None, max_value=None, inclusive=True) -> DataFrame:
    return df.where(bad_range(column, min_value, max_value, inclusive))


def dq_expression_is_true(df, expression: str, column: str | None = None) -> DataFrame:
    return df.where(bad_expression(expression, column))


def dq_not_empty_string(df, column: str, trim_whitespace: bool = True) -> DataFrame:
    c = F.trim(column) if trim_whitespace else F.col(column)
    return df.where(bad_empty_string(column, trim_whitespace)).select(c.alias(column))


def dq_not_null(df, column: str) -> DataFrame:
    return df.where(bad_null(column))


def dq_assert_equal(df, actual, expected) -> DataFrame:
    return df.where(bad_pair(actual, expected))


# --- value and group rules -----------------------------------------------------


def dq_accepted_values(df, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted list with their counts."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(bad_value("value_field", values))


def dq_not_accepted_values(df, column: str, values: Sequence) -> DataFrame:
    return df.select(F.col(column).alias("value_field")).where(F.col("value_field").isin(list(values))).distinct()


def dq_unique(df, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def dq_unique_combination(df, columns: Sequence[str]) -> DataFrame:
    """Repeated tuples; NULLs count as equal."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where("_n > 1").drop("_n")


def dq_at_least_one(df, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups, or the whole table, without a single non-NULL value."""
    pruned = df.select(*dict.fromkeys([*group_by, column]))
    if not group_by:
        pruned = pruned.where(F.col(column).isNotNull()).limit(1)
    return pruned.groupBy(*group_by).agg(F.count(column).alias("filler_column")).where("filler_column = 0")


def dq_not_constant(df, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct non-NULL value."""
    ends = df.groupBy(*group_by).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return ends.where("_low = _high").select(*group_by, F.lit(1).cast("long").alias("filler_column"))


def dq_not_null_proportion(
    df, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = df.groupBy(*group_by).agg(not_null_share(column).alias("not_null_proportion"))
    return share.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def dq_recency(
    df,
    field: str,
    datepart: str,
    interval: int,
    now: datetime,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest ``field`` is older than ``now`` minus the interval."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    moment = F.lit(now.isoformat()).cast("timestamp_ntz")
    threshold = add_parts(moment, datepart, F.lit(-interval), is_date=False).cast(kind)
    newest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    return newest.where(F.col("most_recent") < threshold).withColumn("threshold", threshold)


# --- rules over order ----------------------------------------------------------


def dq_sequential_values(
    df, column: str, interval=1, datepart: str | None = None, group_by: Sequence[str] = (), counted: bool = False
) -> DataFrame:
    """Rows that are not one interval after the row before; first rows pass.

    ``counted`` returns equal rows once, with their number in ``n``.
    """
    previous = f"previous_{slugify(column)}"
    steps = counted_lag(df, column, group_by, previous)
    if datepart:
        before = F.col(previous).cast("timestamp_ntz")
        expected = add_parts(before, datepart, F.lit(interval), is_date=False)
        actual = F.col(column).cast("timestamp_ntz")
    else:
        expected, actual = F.col(previous) + interval, F.col(column)
    failing = steps.where(actual != expected)
    return failing if counted else repeat_rows(failing, "n")


# How a range may follow the one before, and the words used in result columns.
GAP_RULES = {
    "not_allowed": ("equal_to", lambda upper, following: upper == following),
    "allowed": ("less_than_or_equal_to", lambda upper, following: upper <= following),
    "required": ("less_than", lambda upper, following: upper < following),
}


def dq_mutually_exclusive_ranges(
    df,
    lower: str,
    upper: str | Column,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    counted: bool = False,
) -> DataFrame:
    """Ranges that are empty, reversed, open, or collide with the next one.

    ``counted`` returns equal rows once, with their number in ``n``.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}, got {gaps!r}")
    gap_words, follows = GAP_RULES[gaps]
    named = [F.col(lower).alias("lower_bound"), _column(upper).alias("upper_bound")]
    group = []
    if partition_by:
        group = ["partition_by_col"]
        named.insert(0, F.col(partition_by).alias("partition_by_col"))
    ranges = counted_ranges(df.select(*named), "lower_bound", "upper_bound", group)
    low, high = F.col("lower_bound"), F.col("upper_bound")
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    has_length = (low <= high) if zero_length_range_allowed else (low < high)
    length_rule = f"lower_bound_{length_words}_upper_bound"
    gap_rule = f"upper_bound_{gap_words}_next_lower_bound"
    checked = ranges.select(
        *group,
        "lower_bound",
        "upper_bound",
        F.col("next_lower").alias("next_lower_bound"),
        F.col("is_last").alias("is_last_record"),
        F.coalesce(has_length, F.lit(False)).alias(length_rule),
        F.coalesce(follows(high, F.col("next_lower")), F.col("is_last"), F.lit(False)).alias(gap_rule),
        "n",
    )
    failing = checked.where(~(F.col(length_rule) & F.col(gap_rule)))
    return failing if counted else repeat_rows(failing, "n")


# --- rules over two tables -----------------------------------------------------


def dq_relationships_where(
    df, column: str, to: DataFrame, field: str, from_condition: str = "true", to_condition: str = "true",
    counted: bool = False,
) -> DataFrame:
    """Non-NULL child values without a parent, one row per child row.

    Children are counted per value before the shuffle, so a value that fills a
    third of the table travels as one row per task; so do parents. ``counted`` returns (id,
    right_id, n) instead of repeated rows, which is all a suite needs.
    """
    children = (
        df.where(F.col(column).isNotNull() & F.expr(from_condition))
        .groupBy(F.col(column).alias("id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = to.where(F.col(field).isNotNull() & F.expr(to_condition)).select(F.col(field).alias("id")).distinct()
    orphans = children.join(parents, "id", "left_anti")
    marked = orphans.select("id", F.lit(None).cast(orphans.schema["id"].dataType).alias("right_id"), "n")
    return marked if counted else repeat_rows(marked, "n")


def dq_cardinality_equality(df, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs that differ between the two sides, from one grouping."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = df.select(F.col(column).alias("_v"), one.alias("_a"), none.alias("_b")).unionAll(
        to.select(F.col(field).alias("_v"), none.alias("_a"), one.alias("_b"))
    )
    counts = both.groupBy("_v").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return (
        counts.where("_a <> _b")
        .select(F.col("_v").alias(column), F.explode(F.array("_a", "_b")).alias("num_rows"))
        .where("num_rows > 0")
    )


def join_full_on_groups(
    a: DataFrame, b: DataFrame, group_by: Sequence[str], count_a: str, count_b: str
) -> DataFrame:
    """Row counts of both sides per group; a group on one side leaves the other NULL."""
    one = F.count(F.lit(1))
    if not group_by:
        return a.agg(one.alias(count_a)).withColumn(count_b, b.agg(one.alias(count_b)).scalar())
    left = a.groupBy(*[F.col(g).alias(f"{g}_a") for g in group_by]).agg(one.alias(count_a))
    right = b.groupBy(*[F.col(g).alias(f"{g}_b") for g in group_by]).agg(one.alias(count_b))
    same = reduce(lambda x, y: x & y, [F.col(f"{g}_a") == F.col(f"{g}_b") for g in group_by])
    pairs = [f"{g}{side}" for g in group_by for side in ("_a", "_b")]
    return left.join(right, same, "full").select(*pairs, count_a, count_b)


def dq_equal_rowcount(df, other: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    counts = join_full_on_groups(df, other, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def dq_fewer_rows_than(df, other: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    counts = join_full_on_groups(df, other, group_by, "count_our_model", "count_comparison_model")
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("long"))


def dq_equality(
    df,
    other: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows on one side only, over chosen columns, optionally rounded."""
    if compare_columns and exclude_columns:
        raise ValueError("pass either compare_columns or exclude_columns, not both")
    columns = list(compare_columns or kept_columns(df, exclude_columns or ()))
    if not compare_columns:
        theirs = {c.lower() for c in kept_columns(other, exclude_columns or ())}
        if {c.lower() for c in columns} != theirs:
            raise ValueError("the two tables have different columns; choose them explicitly")

    def side(frame: DataFrame) -> DataFrame:
        return frame.select(*[_rounded(frame, c, precision).alias(c) for c in columns])

    return except_both_ways(side(df), side(other))


def _rounded(df: DataFrame, name: str, precision: int | None) -> Column:
    kind = df.select(name).schema[0].dataType
    if precision is None or not isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.col(name)
    return F.round(F.col(name).cast(f"decimal(38,{max(6, precision)})"), precision)


# --- suites --------------------------------------------------------------------


def counted_failures() -> Column:
    """For checks that return equal rows once with their number."""
    return F.sum("n")


def equal_rowcount_failures() -> Column:
    return F.sum(F.coalesce(F.col("diff_count"), F.lit(0)))


def fewer_rows_failures() -> Column:
    return F.sum(F.coalesce(F.col("row_count_delta"), F.lit(0)))


def equality_failures() -> Column:
    side = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    return F.count(F.lit(1)) + F.coalesce(F.abs(F.sum(side)), F.lit(0))


@dataclass(frozen=True)
class Check:
    """A named check over a frame of failing rows."""

    name: str
    failing: DataFrame
    failures: Column | None = None
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    severity: str = "error"


@dataclass(frozen=True)
class RowCheck:
    """A named row rule, counted together with the other rules of its table."""

    name: str
    broken: Column
    where: Column | None = None
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    severity: str = "error"


@dataclass(frozen=True)
class GroupCheck:
    """A named rule over the groups of a table: the groups whose ``measure`` is ``broken`` fail.

    ``unique_check`` and the functions after it make the usual ones.
    """

    name: str
    keys: tuple[str, ...]
    measure: Column
    broken: Callable[[Column], Column]
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    severity: str = "error"


def unique_check(name: str, column: str, **thresholds) -> GroupCheck:
    """Counts non-NULL values that occur more than once."""
    return GroupCheck(name, (column,), F.count(F.lit(1)), lambda n: (n > 1) & F.col(column).isNotNull(), **thresholds)


def unique_combination_check(name: str, columns: Sequence[str], **thresholds) -> GroupCheck:
    """Counts repeated tuples; NULLs count as equal."""
    return GroupCheck(name, tuple(columns), F.count(F.lit(1)), lambda n: n > 1, **thresholds)


def at_least_one_check(name: str, column: str, group_by: Sequence[str], **thresholds) -> GroupCheck:
    """Counts groups without a single non-NULL value."""
    return GroupCheck(name, tuple(group_by), F.count(column), lambda n: n == 0, **thresholds)


def not_constant_check(name: str, column: str, group_by: Sequence[str], **thresholds) -> GroupCheck:
    """Counts groups with exactly one distinct non-NULL value."""
    return GroupCheck(name, tuple(group_by), F.min(column) == F.max(column), lambda same: same, **thresholds)


def not_null_proportion_check(name: str, column: str, group_by: Sequence[str], at_least: float, at_most: float = 1.0, **thresholds) -> GroupCheck:
    """Counts groups whose share of non-NULL values is out of bounds."""
    return GroupCheck(name, tuple(group_by), not_null_share(column), lambda s: (s < at_least) | (s > at_most), **thresholds)


def _counted_in_one_scan(df: DataFrame, rules: Sequence[RowCheck | GroupCheck]) -> DataFrame:
    """(check, failures) of all rules of a table.

    All groupings are grouping sets of one aggregate; the row rules are counted in the groups of one set and added
    up. Without group rules there is a single group.
    """
    groupings = list(dict.fromkeys(r.keys for r in rules if isinstance(r, GroupCheck)))
    if any(not keys for keys in groupings):
        raise ValueError("a group rule needs group columns")

    def counter(rule: RowCheck) -> Column:
        return F.count_if(rule.broken if rule.where is None else rule.where & rule.broken)

    if not groupings:
        failures = [(r.name, counter(r)) for r in rules]
        counted = df
    else:
        columns = list(dict.fromkeys(k for keys in groupings for k in keys))
        # The bits of grouping_id, first column highest, mark the columns that a set leaves out.
        number = {keys: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys) for keys in groupings}
        measures = [(counter(r) if isinstance(r, RowCheck) else r.measure).alias(f"_measure_{i}") for i, r in enumerate(rules)]
        sets = [[F.col(k) for k in keys] for keys in groupings]
        counted = df.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("_set"), *measures)
        failures = []
        for i, r in enumerate(rules):
            measure = F.col(f"_measure_{i}")
            if isinstance(r, RowCheck):
                failures.append((r.name, F.coalesce(F.sum(F.when(F.col("_set") == number[groupings[0]], measure)), F.lit(0))))
            else:
                failures.append((r.name, F.count_if((F.col("_set") == number[r.keys]) & r.broken(measure))))
    entries = [F.struct(F.lit(name).alias("check"), n.cast("long").alias("failures")) for name, n in failures]
    return counted.agg(F.array(*entries).alias("_all")).select(F.inline("_all"))


def dq_suite(
    checks: Sequence[Check] = (), row_checks: Sequence[tuple[DataFrame, Sequence[RowCheck | GroupCheck]]] = ()
) -> DataFrame:
    """(check, failures, status) of many checks.

    Row rules and group rules of one table share a single scan and a single aggregate; every other check is an aggregate
    of its own.
    """
    parts, rules = [], {}
    for df, group in row_checks:
        parts.append(_counted_in_one_scan(df, group))
        rules.update({r.name: r for r in group})
    for check in checks:
        number = F.count(F.lit(1)) if check.failures is None else check.failures
        counted = check.failing.agg(F.coalesce(number, F.lit(0)).cast("long").alias("failures"))
        parts.append(counted.select(F.lit(check.name).alias("check"), "failures"))
        rules[check.name] = check
    results = reduce(DataFrame.unionAll, parts)
    return results.withColumn("status", _status(rules))


def _status(rules: Mapping[str, Check | RowCheck | GroupCheck]) -> Column:
    status = F.lit("pass")
    for name, rule in rules.items():
        outcome = F.when(F.expr(f"failures {rule.warn_if}"), "warn").otherwise("pass")
        if rule.severity == "error":
            outcome = F.when(F.expr(f"failures {rule.error_if}"), "fail").otherwise(outcome)
        status = F.when(F.col("check") == name, outcome).otherwise(status)
    return status
