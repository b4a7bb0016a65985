"""Unions over differing schemas, and differences in both directions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed value: default name of the column that tells where a row came from.
SOURCE_COLUMN = "_dbt_source_relation"


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the column superset.

    A column takes the type of the first relation that has it unless
    ``column_override`` names another; relations without it contribute NULL.
    ``include`` and ``exclude`` are case-insensitive and exclude each other.
    """
    if include and exclude:
        raise ValueError("pass either include or exclude, not both")
    included, excluded = {c.lower() for c in include}, {c.lower() for c in exclude}

    def wanted(name: str) -> bool:
        return name.lower() in included if included else name.lower() not in excluded

    types: dict[str, object] = {}
    for df in relations.values():
        for field in df.schema:
            if wanted(field.name):
                types.setdefault(field.name, field.dataType)
    if not types:
        raise ValueError(f"no columns to union for {', '.join(relations)}")
    types.update({c: t for c, t in (column_override or {}).items() if c in types})

    result = None
    for name, df in relations.items():
        own = set(df.columns)
        columns = [
            (F.col(f"`{c}`") if c in own else F.lit(None)).cast(t).alias(c) for c, t in types.items()
        ]
        if source_column_name is not None:
            columns.insert(0, F.lit(name).alias(source_column_name))
        part = (df.where(where) if where else df).select(*columns)
        result = part if result is None else result.unionAll(part)
    return result


def _ilike(pattern: str) -> re.Pattern:
    signs = {"%": ".*", "_": "."}
    return re.compile("".join(signs.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Tables and views whose schema and name match ILIKE patterns, by full name.

    Temporary views have no schema and match a schema pattern such as ``%``.
    """
    schema_re, table_re, exclude_re = _ilike(schema_pattern), _ilike(table_pattern), _ilike(exclude)

    def matches(name: str) -> bool:
        return bool(table_re.fullmatch(name)) and not exclude_re.fullmatch(name)

    found = {}
    for database in spark.catalog.listDatabases():
        if not schema_re.fullmatch(database.name):
            continue
        for table in spark.catalog.listTables(database.name):
            if not table.isTemporary and matches(table.name):
                found[f"{database.name}.{table.name}"] = spark.table(f"`{database.name}`.`{table.name}`")
    if schema_re.fullmatch(""):
        for table in spark.catalog.listTables():
            if table.isTemporary and matches(table.name):
                found[table.name] = spark.table(f"`{table.name}`")
    return dict(sorted(found.items()))


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, DataFrame]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "", **union_options
) -> DataFrame:
    return union_relations(
        relations_by_pattern(spark, schema_pattern, table_pattern, exclude), **union_options
    )


def except_both_ways(
    a: DataFrame, b: DataFrame, label: str = "which_diff", only_a: str = "a_minus_b", only_b: str = "b_minus_a"
) -> DataFrame:
    """Distinct rows present on one side only, labelled with that side.

    Both sides go through a single grouping that combines copies before the
    shuffle, instead of two anti joins; NULLs compare equal as in EXCEPT.
    """
    tagged = a.withColumn("_in_a", F.lit(1)).withColumn("_in_b", F.lit(0)).unionAll(
        b.select(*a.columns).withColumn("_in_a", F.lit(0)).withColumn("_in_b", F.lit(1))
    )
    sides = tagged.groupBy(*[f"`{c}`" for c in a.columns]).agg(
        F.max("_in_a").alias("_in_a"), F.max("_in_b").alias("_in_b")
    )
    return sides.where(F.col("_in_a") != F.col("_in_b")).select(
        F.when(F.col("_in_a") == 1, only_a).otherwise(only_b).alias(label), *[f"`{c}`" for c in a.columns]
    )


def join_natural(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every column name the two sides share."""
    common = [c for c in a.columns if c.lower() in {x.lower() for x in b.columns}]
    if not common:
        raise ValueError("no common column")
    return a.join(b, common)
