"""Expression queries."""

from pyspark.sql import functions as F

from climagrid.functions import arithmetic as A
from climagrid.functions import text as X
from climagrid.operators.shape import nullif_empty, nullif_empty_table, star_except
from climagrid.registry import query
from climagrid.registry.standins import key_sql

# Quantity with NULL in place of 7, on both sides.
_Q = "nullif(l_quantity, 7e0)"
_LINE = "l_orderkey, l_linenumber, l_partkey"


def _lines(t):
    return t.lineitem.withColumn("q", F.nullif(F.col("l_quantity"), F.lit(7.0)))


_ORDER_KEY = key_sql("o_custkey", "nullif(o_orderstatus, 'P')", "o_totalprice", "o_orderdate")


@query(
    "surrogate_key",
    f"""SELECT o_orderkey, {_ORDER_KEY} AS key_all, {key_sql("nullif(o_orderstatus, 'P')")} AS key_status,
          md5(concat_ws('-', coalesce(nullif(o_orderstatus, 'P'), ''), CAST(o_custkey AS VARCHAR))) AS key_blank
        FROM orders""",
)
def surrogate_key(t):
    orders = t.orders.withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return orders.select(
        "o_orderkey",
        X.surrogate_key(orders, ["o_custkey", "status", "o_totalprice", "o_orderdate"]).alias("key_all"),
        X.surrogate_key(orders, ["status"]).alias("key_status"),
        X.surrogate_key(orders, ["status", "o_custkey"], null_value="").alias("key_blank"),
    )


@query(
    "safe_add",
    f"SELECT {_LINE}, coalesce({_Q}, 0) + coalesce(l_linenumber, 0) + coalesce(l_tax, 0) AS total FROM lineitem",
)
def safe_add(t):
    return _lines(t).select("l_orderkey", "l_linenumber", "l_partkey", A.safe_add("q", "l_linenumber", "l_tax").alias("total"))


@query(
    "safe_subtract",
    f"SELECT {_LINE}, coalesce(l_extendedprice, 0) - coalesce({_Q}, 0) - coalesce(l_tax, 0) AS remainder FROM lineitem",
)
def safe_subtract(t):
    rest = A.safe_subtract("l_extendedprice", "q", "l_tax").alias("remainder")
    return _lines(t).select("l_orderkey", "l_linenumber", "l_partkey", rest)


@query(
    "safe_divide",
    f"""SELECT {_LINE}, l_extendedprice / nullif(l_discount, 0) AS per_discount,
          ({_Q} * l_tax) / nullif(l_discount * l_linenumber, 0) AS ratio FROM lineitem""",
)
def safe_divide(t):
    return _lines(t).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        A.safe_divide("l_extendedprice", "l_discount").alias("per_discount"),
        A.safe_divide(F.col("q") * F.col("l_tax"), F.col("l_discount") * F.col("l_linenumber")).alias("ratio"),
    )


@query(
    "width_bucket",
    f"""SELECT {_LINE}, CAST(CASE WHEN mod(CAST(l_quantity AS DECIMAL(28,6)), CAST((40e0 - 10e0) / 6 AS DECIMAL(28,6))) = 0
          THEN 1 ELSE 0 END + least(ceil((l_quantity - 10e0) / ((40e0 - 10e0) / 6)), 7) AS BIGINT) AS bucket FROM lineitem""",
)
def width_bucket(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", A.width_bucket("l_quantity", 10.0, 40.0, 6).alias("bucket")
    )


_LAT = "(o_orderkey % 170 - 85)"
_LON = "(o_custkey % 360 - 180)"


def _haversine_sql(rate: str) -> str:
    return f"""round(2 * 3961 * asin(sqrt(power(sin(radians(({_LAT} / 2e0 - {_LAT}) / 2)), 2)
      + cos(radians({_LAT})) * cos(radians({_LAT} / 2e0)) * power(sin(radians(({_LON} / 3e0 - {_LON}) / 2)), 2)))
      * {rate}, 6)"""


@query(
    "haversine",
    f"SELECT o_orderkey, {_haversine_sql('1')} AS miles, {_haversine_sql('1.60934e0')} AS km FROM orders",
)
def haversine(t):
    lat, lon = F.expr(_LAT), F.expr(_LON)
    ends = (lat, lon, lat / 2, lon / 3)
    return t.orders.select(
        "o_orderkey",
        A.round_half_away(A.haversine(*ends), 6).alias("miles"),
        A.round_half_away(A.haversine(*ends, unit="km"), 6).alias("km"),
    )


# Customers with one segment blanked, on both sides.
_BLANKED = "replace(c_mktsegment, 'BUILDING', '')"


def _blanked(t):
    return t.customer.withColumn("c_mktsegment", F.replace(F.col("c_mktsegment"), F.lit("BUILDING"), F.lit("")))


@query("nullif_empty", f"SELECT c_custkey, nullif({_BLANKED}, '') AS c_mktsegment FROM customer")
def blank_segments(t):
    customers = _blanked(t)
    return customers.select(*nullif_empty(customers, ["c_custkey", "c_mktsegment"]))


@query(
    "nullif_empty_table",
    f"""SELECT c_custkey, nullif(c_name, '') AS c_name, c_nationkey, c_acctbal, nullif({_BLANKED}, '') AS c_mktsegment
        FROM customer""",
)
def blank_table(t):
    return nullif_empty_table(_blanked(t))


_HOST = """split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''),
  '/', 1), '?', 1)"""


@query("url_host", f"SELECT page_id, url, {_HOST} AS host FROM pages")
def url_host(t):
    return t.pages.select("page_id", "url", X.url_host("url").alias("host"))


_STRIPPED = "replace(replace(url, 'http://', ''), 'https://', '')"


@query(
    "url_path",
    f"""SELECT page_id, split_part(right({_STRIPPED}, length({_STRIPPED}) - coalesce(nullif(position('/' IN {_STRIPPED}), 0),
          position('?' IN {_STRIPPED}) - 1)), '?', 1) AS path FROM pages""",
)
def url_path(t):
    return t.pages.select("page_id", X.url_path("url").alias("path"))


@query(
    "url_parameter",
    """SELECT page_id, nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS source,
         nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page FROM pages""",
)
def url_parameter(t):
    return t.pages.select(
        "page_id", X.url_parameter("url", "utm_source").alias("source"), X.url_parameter("url", "page").alias("page")
    )


@query(
    "star_except",
    """SELECT c_custkey AS old_c_custkey_v1, c_name AS old_c_name_v1, c_nationkey AS old_c_nationkey_v1,
         c_mktsegment AS old_c_mktsegment_v1 FROM customer""",
)
def star(t):
    return star_except(t.customer, ["C_ACCTBAL"], prefix="old_", suffix="_v1")
