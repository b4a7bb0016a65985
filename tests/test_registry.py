"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from climagrid import registry
from tools.oracle_check import compare, table

entry.queries()
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con(data_dir):
    connection = duckdb.connect()
    for path in Path(data_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, con, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    cursor = con.execute(ORACLES[name])
    expected = table([d[0] for d in cursor.description], cursor.fetchall())
    assert compare(table(df.columns, [tuple(r) for r in df.collect()]), expected) == ""


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 7


def test_no_plan_collects_pairs(spark, data_dir):
    """No query falls back to a Cartesian or nested-loop join."""
    for name, query in QUERIES.items():
        text = query(spark, data_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
