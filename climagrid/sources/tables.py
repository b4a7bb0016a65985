"""Scans of stored tables and files; columns and filters reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, name: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    return spark.table(name).select(*columns)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and declared column types; empty fields are NULL.

    Columns are found by their name in the header, in any order; columns that are not declared are left out, and a missing one
    is an error. The names come from one file, and tasks compare them with the header of every file they read: a
    file with another order or other names fails instead of being read by position. The byte-order mark some tools write is accepted.
    """
    declared = {f.name.lower(): f for f in T.StructType.fromDDL(schema).fields}
    header = spark.read.csv(path, header=True).columns
    names = [c.removeprefix("\ufeff") for c in header]
    missing = declared.keys() - {c.lower() for c in names}
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(sorted(missing))}")
    found = [T.StructField(c, declared[n.lower()].dataType if n.lower() in declared else T.StringType()) for c, n in zip(header, names)]
    rows = spark.read.csv(path, schema=T.StructType(found), header=True, enforceSchema=False, mode="FAILFAST")
    column = {n.lower(): F.col(f"`{c}`") for c, n in zip(header, names)}
    return rows.select(*[column[low].alias(f.name) for low, f in declared.items()])
