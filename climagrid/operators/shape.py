"""Column-set operators: star, null checks, pivot, unpivot, grouped values."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climagrid.functions.text import slugify, text_of


def kept_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names of ``df`` minus a case-insensitive list."""
    dropped = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in dropped]


def star_columns(
    df: DataFrame,
    exclude: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """The kept columns, renamed only when a prefix or suffix is given."""
    qualifier = f"`{relation_alias}`." if relation_alias else ""
    columns = []
    for name in kept_columns(df, exclude):
        column = F.col(f"{qualifier}`{name}`")
        columns.append(column.alias(f"{prefix}{name}{suffix}") if prefix or suffix else column)
    return columns


def star_except(df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    return df.select(*star_columns(df, exclude, prefix, suffix))


def nullif_empty(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The named columns, with '' turned to NULL where the column is text."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return [F.nullif(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in columns]


def nullif_empty_table(df: DataFrame) -> DataFrame:
    return df.select(*nullif_empty(df, df.columns))


def group_by_n(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggregates)


def column_values(
    df: DataFrame,
    column: str | Column,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Distinct values with their counts, most frequent first and then by value."""
    if where is not None:
        df = df.where(where)
    value = F.col(column) if isinstance(column, str) else column
    counted = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(*(order_by or [F.desc("n")]), F.asc_nulls_last("value"))
    return ordered if max_records is None else ordered.limit(max_records)


# A list of values becomes columns of a plan, so more than this many are refused.
MOST_VALUES = 10_000


def value_list(
    values: DataFrame, max_records: int | None = None, default: Sequence | None = None, most: int = MOST_VALUES
) -> list:
    """The list of values that names the columns of a pivot.

    Without ``max_records`` all values are wanted, and more than ``most`` of them raise an error instead of being cut.
    """
    found = [r["value"] for r in values.select("value").limit(most + 1 if max_records is None else max_records).collect()]
    if max_records is None and len(found) > most:
        raise ValueError(f"more than {most} values; give max_records to take only the first")
    return found or list(default or [])


# How a pivoted column is compared with each value.
COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "like": F.like,
    "ilike": F.ilike,
}

PIVOT_AGGREGATES = {
    "sum": (F.sum, F.sum_distinct),
    "count": (F.count, F.count_distinct),
    "max": (F.max, F.max),
    "min": (F.min, F.min),
    "avg": (F.avg, lambda c: F.sum_distinct(c) / F.count_distinct(c)),
}


def pivot_columns(
    column: str,
    values: Sequence,
    agg: str | Callable[[Column], Column] = "sum",
    cmp: str | Callable[[Column, Column], Column] = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One aggregate per value; without quoting the column names are slugs."""
    compare = cmp if callable(cmp) else COMPARISONS[cmp.strip().lower()]
    aggregate = agg if callable(agg) else PIVOT_AGGREGATES[agg.strip().lower()][1 if distinct else 0]
    then_column, else_column = (
        v if isinstance(v, Column) else F.lit(v) for v in (then_value, else_value)
    )
    columns = []
    for value in values:
        hit = F.when(compare(F.col(column), F.lit(value)), then_column).otherwise(else_column)
        name = f"{prefix}{value}{suffix}"
        result = aggregate(hit)
        if alias:
            result = result.alias(name if quote_identifiers else slugify(name))
        columns.append(result)
    return columns


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, **options) -> DataFrame:
    """Values of ``column`` as columns, in one grouped pass over ``df``."""
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns as rows, NULL values kept; ``exclude`` stays as ids, ``remove`` goes.

    Values reach text first when the target is text, so floats and booleans read
    the same as in keys.
    """
    melted = kept_columns(df, [*exclude, *remove])
    if not melted:
        raise ValueError("no column left to unpivot")
    boolean = {f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)}

    def cell(name: str) -> Column:
        as_text = cast_to.lower() in ("string", "varchar") or name in boolean
        source = text_of(df, name) if as_text else F.col(f"`{name}`")
        return source.cast("string" if cast_to.lower() == "varchar" else cast_to).alias(name)

    prepared = df.select(*exclude, *[cell(c) for c in melted])
    return prepared.unpivot(list(exclude), melted, field_name, value_name)


def scalar_value(df: DataFrame, default=None) -> Column:
    """First row, first column of ``df`` as a scalar subquery; ``default`` without rows."""
    first = df.select(F.struct(F.col(df.columns[0]).alias("v")).alias("hit")).limit(1).scalar()
    found = first.getField("v")
    return found if default is None else F.when(first.isNull(), F.lit(default)).otherwise(found)


def not_null_share(column: str) -> Column:
    """Share of non-NULL values as an aggregate."""
    return F.avg(F.when(F.col(column).isNull(), 0).otherwise(1))
