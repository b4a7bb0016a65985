"""Sink, table maintenance and catalogue queries: write, then read back."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.plans import catalog
from climagrid.registry import query
from climagrid.session import scratch_path
from climagrid.sinks import tables as S
from climagrid.sinks.months import MonthTable

_PERIOD = ["year", "month"]


@query("replace_table", "SELECT * FROM orders")
def replaced(t):
    path = scratch_path(t.spark, "table")
    S.replace_table(t.customer, path)
    S.replace_table(t.orders, path)
    return t.spark.read.parquet(path)


@query(
    "append_positional",
    """SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""",
)
def appended_by_position(t):
    path = scratch_path(t.spark, "table")
    S.replace_table(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    S.append_positional(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return t.spark.read.parquet(path)


@query(
    "append_by_name",
    """SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT o_custkey, NULL, o_totalprice FROM orders""",
)
def appended_by_name(t):
    path = scratch_path(t.spark, "table")
    S.replace_table(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    orders = t.orders.select(F.col("o_totalprice").alias("C_ACCTBAL"), F.col("o_custkey").alias("c_custkey"))
    S.append_by_name(orders, path)
    return t.spark.read.parquet(path)


_REPLACED = """SELECT o_orderkey, o_orderdate, CASE WHEN date_trunc('month', o_orderdate) =
    (SELECT date_trunc('month', max(o_orderdate)) FROM orders) THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice{extra}
  FROM orders"""


def _order_lines(t):
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")


def _redelivery(t):
    """The newest month again, with doubled prices."""
    orders = _order_lines(t)
    newest = orders.agg(F.trunc(F.max("o_orderdate").cast("date"), "MM")).first()[0]
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    return orders.where(month == newest).withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query(
    "replace_period",
    _REPLACED.format(extra=", CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"),
)
def replaced_period(t):
    path = scratch_path(t.spark, "bronze")
    S.replace_table(S.with_period(_order_lines(t), "o_orderdate"), path, _PERIOD)
    S.replace_period(_redelivery(t), path, "o_orderdate")
    return t.spark.read.parquet(path)


@query(
    "replace_months_by_manifest",
    _REPLACED.format(extra=", CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"),
)
def replaced_by_manifest(t):
    """The same through a manifest; the second delivery arrives twice."""
    table = MonthTable(t.spark, scratch_path(t.spark, "months"), "o_orderdate")
    table.replace(_order_lines(t), "first")
    table.replace(_redelivery(t), "again")
    table.replace(_redelivery(t).withColumn("o_totalprice", F.lit(0.0)), "again")
    return table.read()


@query("replace_newest_month", _REPLACED.format(extra=""))
def replaced_month(t):
    """The same as a query over two frames, for tables that are not partitioned."""
    return S.replace_newest_month(_order_lines(t), _redelivery(t), "o_orderdate")


@query("export_parquet", "SELECT * FROM lineitem")
def exported(t):
    path = scratch_path(t.spark, "export")
    S.export_parquet(t.lineitem, path)
    return t.spark.read.parquet(path)


@query(
    "publish_guard",
    """SELECT c_nationkey, c_mktsegment, count(*) AS n_orders, round(max(o_totalprice), 2) AS top
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def published(t):
    """Orders per nation and segment, published as a sheet that stays below the row limit."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    summary = joined.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top")
    )
    path = scratch_path(t.spark, "sheet")
    S.publish(summary.withColumn("key_id", F.md5("c_mktsegment")), path)
    return t.spark.read.csv(path, header=True, schema="c_nationkey int, c_mktsegment string, n_orders bigint, top double")


_DESCRIBED = {
    "customer": [("c_custkey", "number"), ("c_name", "string"), ("c_nationkey", "number"), ("c_acctbal", "number"), ("c_mktsegment", "string")],
    "events": [("event_id", "number"), ("ts", "date"), ("user_id", "number"), ("event_type", "string"), ("value", "number"), ("props", "string")],
    "labels": [("doc_id", "number"), ("quality", "number"), ("toxic", "number")],
}
# Columns renamed to known names, to exercise the lookup.
_RENAMED = {"ts": "Time", "c_acctbal": "TP", "quality": "Humidité_Relative"}
_DESCRIBED_SQL = " UNION ALL ".join(
    "SELECT '{d}' AS dataset, {i} AS ordinal, '{n}' AS name, '{text}' AS description, '{unit}' AS unit, '{kind}' AS type, "
    "(SELECT count(*) FROM {d}) AS n_rows, (SELECT count({c}) FROM {d}) AS n_filled".format(
        d=dataset,
        i=i,
        c=column,
        n=_RENAMED.get(column, column),
        text=catalog.COLUMN_INFO.get(_RENAMED.get(column, column).lower(), (_RENAMED.get(column, column), ""))[0].replace("'", "''"),
        unit=catalog.COLUMN_INFO.get(_RENAMED.get(column, column).lower(), ("", ""))[1],
        kind=kind,
    )
    for dataset, columns in _DESCRIBED.items()
    for i, (column, kind) in enumerate(columns)
)


@query("catalog_rows", _DESCRIBED_SQL)
def described(t):
    """Published columns of three tables, with the rows and filled cells of each."""
    info = catalog.column_info(t.spark)
    result = None
    for dataset in _DESCRIBED:
        df = getattr(t, dataset).withColumnsRenamed(_RENAMED).withColumn("KEY_ID", F.lit(""))
        columns = catalog.described_columns(df, dataset, info)
        kept = [c for c in df.columns if c != "KEY_ID"]
        counts = df.agg(F.count("*").alias("n_rows"), *[F.count(F.col(c)).alias(c) for c in kept])
        filled = counts.unpivot(["n_rows"], kept, "name", "n_filled")
        one = columns.join(filled, "name")
        result = one if result is None else result.unionByName(one)
    return result.select("dataset", "ordinal", "name", "description", "unit", "type", "n_rows", "n_filled")


# Themes are regions; the last dataset has an unknown one and is left out.
_THEMES = {"customer": "AFRICA", "events": "ASIA", "labels": "NOWHERE"}


@query(
    "catalog_full_rows",
    f"""SELECT 'About ' || dataset AS name, 'f/' || dataset || '.csv' AS file_path, CAST(r_regionkey AS BIGINT) AS theme_id, 'csv' AS file_type,
          '{catalog.NEW_STATUS}' AS status, n_rows AS file_size_bytes, d.ordinal, d.name AS column_name, d.description, d.unit, d.type
        FROM ({_DESCRIBED_SQL}) d
        JOIN (VALUES {", ".join(f"('{d}', '{s}')" for d, s in _THEMES.items())}) x(ds, slug) ON ds = dataset
        JOIN region ON r_name = slug""",
)
def full_rows(t):
    """Catalogue rows of two tables, one row per nested column; the size is the number of rows."""
    info = catalog.column_info(t.spark)
    tables = {d: getattr(t, d).withColumnsRenamed(_RENAMED).withColumn("KEY_ID", F.lit("")) for d in _THEMES}
    described = reduce(DataFrame.unionAll, [catalog.described_columns(df, d, info) for d, df in tables.items()])
    counts = [df.agg(F.count("*").alias("file_size_bytes")).select(F.lit(d).alias("dataset"), "file_size_bytes") for d, df in tables.items()]
    listed = [(d, f"About {d}", d, "", slug, [d], f"f/{d}.csv") for d, slug in _THEMES.items()]
    datasets = t.spark.createDataFrame(
        listed, "dataset string, name string, description string, source string, theme_slug string, tags array<string>, file_path string"
    )
    themes = t.region.select(F.col("r_name").alias("slug"), F.col("r_regionkey").cast("long").alias("id"))
    full = catalog.catalog_rows(datasets, described, themes, reduce(DataFrame.unionAll, counts))
    return full.select("name", "file_path", "theme_id", "file_type", "status", "file_size_bytes", F.posexplode("columns").alias("ordinal", "c")).select(
        "name", "file_path", "theme_id", "file_type", "status", "file_size_bytes", "ordinal",
        F.col("c.name").alias("column_name"), "c.description", "c.unit", "c.type",
    )


@query(
    "catalog_upsert",
    """WITH existing AS (SELECT 'f/' || s_suppkey AS file_path, s_name AS name, CAST(s_nationkey AS BIGINT) AS file_size_bytes FROM supplier),
         incoming AS (SELECT 'f/' || o_custkey AS file_path, 'customer ' || o_custkey AS name, count(*) AS file_size_bytes
           FROM orders GROUP BY o_custkey)
       SELECT e.file_path, e.name, coalesce(i.file_size_bytes, e.file_size_bytes) AS file_size_bytes
       FROM existing e LEFT JOIN incoming i USING (file_path)
       UNION ALL SELECT * FROM incoming WHERE file_path NOT IN (SELECT file_path FROM existing)""",
)
def upserted(t):
    existing = t.supplier.select(
        F.concat(F.lit("f/"), F.col("s_suppkey").cast("string")).alias("file_path"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("long").alias("file_size_bytes"),
    )
    key = F.col("o_custkey").cast("string")
    incoming = t.orders.groupBy("o_custkey").agg(F.count("*").alias("file_size_bytes"))
    incoming = incoming.select(
        F.concat(F.lit("f/"), key).alias("file_path"), F.concat(F.lit("customer "), key).alias("name"), "file_size_bytes"
    )
    return catalog.catalog_upsert(existing, incoming)
