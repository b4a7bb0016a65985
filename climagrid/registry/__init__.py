"""Registered queries over the given tables, with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given Parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # Stored on the instance, so that a table's footer is read once per query.
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with its SQL."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from climagrid.registry import (  # noqa: F401
        expressions,
        joins,
        maintenance,
        marts,
        planning,
        quality,
        shaping,
        sources,
    )
