"""Scan and source queries."""

import uuid

from pyspark.sql import functions as F

from climagrid.registry import query
from climagrid.session import scratch_path
from climagrid.sources.grid import combine_by_coords, combine_folder, grid_to_long
from climagrid.sources.regions import regions_from_geojson
from climagrid.sources.tables import scan_csv, scan_parquet, scan_table

SIDE = 6


def _cubes(t):
    """One packed cube per day: a 6 by 6 lattice, at most 36 cells, NULL where nothing was seen."""
    i, j = F.col("l_orderkey") % SIDE, F.col("l_partkey") % SIDE
    seen = t.lineitem.groupBy(F.col("l_shipdate").alias("day"), (i * SIDE + j).cast("int").alias("pos")).agg(
        F.max("l_extendedprice").alias("price"), F.min("l_quantity").alias("quantity")
    )
    packed = seen.groupBy("day").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", F.struct("price", "quantity")))).alias("cells")
    )
    cells = F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), lambda p: F.col("cells")[p])
    return packed.select(
        F.array("day").alias("time"),
        F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda k: (k + 109) / 10).alias("lat"),
        F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda k: (k + 417) / 10).alias("lon"),
        F.transform(cells, lambda c: c["price"]).alias("price"),
        F.transform(cells, lambda c: c["quantity"]).alias("quantity"),
    )


@query(
    "grid_to_long",
    """WITH seen AS (SELECT l_shipdate AS time, l_orderkey % 6 AS i, l_partkey % 6 AS j, max(l_extendedprice) AS price,
           min(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2, 3),
         lattice AS (SELECT DISTINCT time, a.k AS i, b.k AS j FROM seen, range(6) AS a(k), range(6) AS b(k))
       SELECT time, (109 + i) / 10e0 AS lat, (417 + j) / 10e0 AS lon, price, quantity
       FROM lattice LEFT JOIN seen USING (time, i, j)""",
)
def cubes_to_long(t):
    return grid_to_long(_cubes(t), ["time", "lat", "lon"], ["price", "quantity"])


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "combine_by_coords",
    "SELECT CAST(ts AS DATE) AS time, user_id, "
    + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in _KINDS)
    + " FROM events GROUP BY 1, 2",
)
def combined_files(t):
    """Five single-variable frames, each with a grid-mapping column, merged on (time, user_id)."""
    files = []
    for kind in _KINDS:
        one = t.events.where(F.col("event_type") == kind)
        files.append(
            one.groupBy(F.col("ts").cast("date").alias("time"), "user_id")
            .agg(F.max("value").alias(kind))
            .withColumn("crs", F.lit(0))
        )
    return combine_by_coords(files, ["time", "user_id"])


@query(
    "combine_folder",
    "SELECT CAST(ts AS DATE) AS time, user_id, "
    + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in _KINDS)
    + " FROM events GROUP BY 1, 2",
)
def combined_folder(t):
    """The same from files: a folder per kind of event, several files in each, merged in one scan."""
    folder = scratch_path(t.spark, "parts")
    for kind in _KINDS:
        one = t.events.where(F.col("event_type") == kind)
        grouped = one.groupBy(F.col("ts").cast("date").alias("time"), "user_id").agg(F.max("value").alias(kind))
        grouped.withColumn("crs", F.lit(0)).write.parquet(f"{folder}/{kind}")
    return combine_folder(t.spark, folder, ["time", "user_id"]).select("time", "user_id", *_KINDS)


@query(
    "regions_from_geojson",
    """WITH p AS (SELECT c_custkey AS k, c_name AS region, c_nationkey AS n, c_custkey % 340 - 170e0 AS x,
           c_nationkey * 3 - 45e0 AS y FROM customer),
         parts AS (SELECT *, 0 AS poly, 0e0 AS shift FROM p UNION ALL SELECT *, 1, 4e0 FROM p WHERE n % 2 = 1),
         s(seq, fx, fy, gx, gy) AS (VALUES (0, 0e0, 0e0, 1.5e0, 0.25e0), (1, 1.5e0, 0.25e0, 0.5e0, 2e0),
           (2, 0.5e0, 2e0, 0e0, 0e0))
       SELECT region, poly, 0 AS ring, seq, x + shift + fx AS x1, y + fy AS y1, x + shift + gx AS x2, y + gy AS y2
       FROM parts, s""",
)
def customer_regions(t):
    """Customers written as GeoJSON features, one per line, and read back as edges."""
    x, y = F.col("c_custkey") % 340 - F.lit(170.0), F.col("c_nationkey") * 3 - F.lit(45.0)

    def ring(shift: float):
        points = [(0.0, 0.0), (1.5, 0.25), (0.5, 2.0), (0.0, 0.0)]
        return F.array(F.array(*[F.array(x + shift + a, y + b) for a, b in points]))

    geometry = F.when(
        F.col("c_nationkey") % 2 == 1,
        F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(F.array(ring(0.0), ring(4.0))), F.lit("}")),
    ).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(ring(0.0)), F.lit("}")))
    line = F.concat(
        F.lit('{"type":"Feature","properties":{"NAME_1":"'), F.col("c_name"), F.lit('"},"geometry":'), geometry, F.lit("}")
    )
    path = scratch_path(t.spark, "features")
    t.customer.select(line.alias("value")).write.text(path)
    return regions_from_geojson(t.spark, path, line_delimited=True)


@query("scan_table", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 25")
def named_table(t):
    name = f"bronze_lines_{uuid.uuid4().hex}"
    t.lineitem.createOrReplaceTempView(name)
    lines = scan_table(t.spark, name, ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])
    return lines.where("l_quantity > 25")


@query(
    "scan_parquet",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'",
)
def parquet_file(t):
    orders = scan_parquet(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderdate"])
    recent = orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return recent.select("o_orderkey", "o_totalprice")


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer")
def csv_file(t):
    path = scratch_path(t.spark, "customers.csv")
    customers = t.customer.withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    customers.select("c_mktsegment", "c_custkey", "c_acctbal", "c_name", "c_nationkey").write.csv(path, header=True)
    return scan_csv(
        t.spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )
