"""Aggregation, window, set and generator queries."""

from pyspark.sql import functions as F

from climagrid.functions.arithmetic import round_half_away
from climagrid.operators import ordering as O
from climagrid.operators import sets, shape
from climagrid.operators.calendar import date_spine, generate_series
from climagrid.registry import query

# --- aggregates ------------------------------------------------------------------


@query(
    "group_by_n",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def group_by_n(t):
    lines = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return shape.group_by_n(lines, 2, F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query(
    "column_values",
    """SELECT user_id AS value, count(*) AS n FROM events WHERE event_type <> 'error'
       GROUP BY 1 ORDER BY n DESC, value LIMIT 50""",
)
def column_values(t):
    """The fifty busiest users."""
    return shape.column_values(t.events, "user_id", max_records=50, where="event_type <> 'error'")


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot",
    "SELECT user_id, "
    + ", ".join(f"CAST(sum(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}" for k in _KINDS)
    + ", "
    + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN value ELSE -1e0 END) AS max_{k}" for k in _KINDS)
    + " FROM events GROUP BY user_id",
)
def pivot(t):
    kinds = shape.value_list(shape.column_values(t.events, "event_type"))
    return t.events.groupBy("user_id").agg(
        *shape.pivot_columns("event_type", kinds, prefix="n_"),
        *shape.pivot_columns(
            "event_type", kinds, agg="max", prefix="max_", then_value=F.col("value"), else_value=-1.0,
            quote_identifiers=False,
        ),
    )


@query(
    "scalar_value",
    """SELECT o_orderkey, (SELECT max(o_orderdate) FROM orders) AS newest,
         coalesce((SELECT min(c_custkey) FROM customer WHERE c_acctbal > 1e9), -1) AS richest,
         date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age FROM orders""",
)
def scalar_value(t):
    newest = t.orders.agg(F.max("o_orderdate"))
    rich = t.customer.where("c_acctbal > 1e9").select("c_custkey")
    aged = t.orders.withColumn("newest", shape.scalar_value(newest)).withColumn("richest", shape.scalar_value(rich, -1))
    return aged.select(
        "o_orderkey", "newest", F.col("richest").cast("long").alias("richest"),
        F.datediff("newest", "o_orderdate").cast("long").alias("age"),
    )


@query(
    "sum_grouped_star",
    """SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey, sum(l_quantity) AS l_quantity_sum
       FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def sum_grouped_star(t):
    lines = t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_quantity")
    return lines.groupBy(*shape.star_columns(lines, ["L_QUANTITY"])).agg(F.sum("l_quantity").alias("l_quantity_sum"))


@query(
    "count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_shipdate) AS n_days
       FROM lineitem GROUP BY 1""",
)
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("n_suppliers"), F.count_distinct("l_shipdate").alias("n_days")
    )


@query(
    "having",
    "SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1 HAVING count(*) > 10",
)
def having(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return per_customer.where("n > 10")


@query(
    "conditional_proportion",
    """SELECT l_returnflag, l_linestatus, round(sum(CASE WHEN nullif(l_quantity, 7e0) IS NULL THEN 0 ELSE 1 END)
         / CAST(count(*) AS DOUBLE), 9) AS share FROM lineitem GROUP BY 1, 2""",
)
def conditional_proportion(t):
    lines = t.lineitem.withColumn("q", F.nullif(F.col("l_quantity"), F.lit(7.0)))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(round_half_away(shape.not_null_share("q"), 9).alias("share"))


# --- windows ---------------------------------------------------------------------


@query(
    "top1_per_group",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def top1_per_group(t):
    return O.top1_per_group(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "deduplicate",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
         ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def deduplicate(t):
    return O.deduplicate(t.events, ["user_id", "event_type"], [F.desc("ts"), F.asc("event_id")])


@query(
    "deduplicate_natural",
    """WITH data AS (SELECT user_id, event_type, nullif(event_id % 10, 3) AS digit, event_id FROM events),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM data)
       SELECT DISTINCT data.* FROM data NATURAL JOIN ranked WHERE ranked.rn = 1""",
)
def deduplicate_natural(t):
    """The variant that picks rows by a natural join: chosen rows with a NULL are gone."""
    data = t.events.select(
        "user_id", "event_type", F.expr("nullif(event_id % 10, 3)").alias("digit"), "event_id"
    )
    return O.deduplicate(data, ["user_id", "event_type"], [F.asc("event_id")], keep_nulls=False)


_RANGES = """SELECT l_suppkey, CAST(l_shipdate AS DATE) AS lower_day,
  CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS upper_day, l_orderkey, l_linenumber, l_partkey FROM lineitem"""


def shipping_ranges(t):
    return t.lineitem.select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("lower_day"),
        F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")).alias("upper_day"),
    )


@query(
    "lead_gap",
    f"""WITH r AS ({_RANGES}), o AS (
          SELECT l_suppkey, lower_day, upper_day,
                 lead(lower_day) OVER w AS next_lower,
                 lead(lower_day) OVER w IS NULL AS is_last
          FROM r WINDOW w AS (PARTITION BY l_suppkey ORDER BY lower_day, upper_day, l_orderkey, l_linenumber, l_partkey))
        SELECT * FROM o""",
)
def lead_gap(t):
    return O.lead_gap(shipping_ranges(t), "lower_day", "upper_day", ["l_suppkey"])


@query(
    "lag_step",
    """SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous
       FROM (SELECT user_id, CAST(ts AS DATE) AS day FROM events)""",
)
def lag_step(t):
    days = t.events.select("user_id", F.col("ts").cast("date").alias("day"))
    return O.lag_step(days, "day", ["user_id"])


@query(
    "lag_step_whole_table",
    "SELECT l_extendedprice, lag(l_extendedprice) OVER (ORDER BY l_extendedprice) AS previous FROM lineitem",
)
def lag_step_whole_table(t):
    """One order over the whole table, without a single-task window."""
    return O.lag_step(t.lineitem, "l_extendedprice")


# --- order, limits, sets ---------------------------------------------------------


@query("sort_mart", "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate")
def sort_mart(t):
    return O.sort_mart(t.orders.select("o_orderdate", "o_orderkey", "o_totalprice"), ["o_orderdate"], ["o_orderkey"])


@query(
    "limit_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def limit_n(t):
    """The hundred largest orders."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query(
    "distinct_rows",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem",
)
def distinct_rows(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")).distinct()


@query(
    "union_relations",
    """SELECT 'customers' AS _dbt_source_relation, c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation,
         c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer WHERE c_custkey >= 10
       UNION ALL SELECT 'suppliers', s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier WHERE s_suppkey >= 10""",
)
def union_relations(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"), "c_acctbal",
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), "s_acctbal"
    )
    return sets.union_relations(
        {"customers": customers, "suppliers": suppliers},
        column_override={"nation": "bigint"},
        exclude=["C_ACCTBAL"],
        where="id >= 10",
    )


@query(
    "union_by_pattern",
    """SELECT 'climagrid_obs_orders' AS _dbt_source_relation, o_orderkey AS id, o_orderdate AS moment, o_totalprice AS amount
         FROM orders
       UNION ALL SELECT 'climagrid_obs_ships', l_orderkey, l_shipdate, NULL FROM lineitem""",
)
def union_by_pattern(t):
    t.orders.selectExpr("o_orderkey AS id", "o_orderdate AS moment", "o_totalprice AS amount").createOrReplaceTempView(
        "climagrid_obs_orders"
    )
    t.lineitem.selectExpr("l_orderkey AS id", "l_shipdate AS moment").createOrReplaceTempView("climagrid_obs_ships")
    t.customer.createOrReplaceTempView("climagrid_obs_old")
    return sets.union_by_pattern(t.spark, "%", "CLIMAGRID_obs%", exclude="%_old")


@query(
    "except_both_ways",
    """WITH a AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders),
         b AS (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS day FROM lineitem)
       SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
       UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def except_both_ways(t):
    a = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"))
    b = t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("date").alias("day"))
    return sets.except_both_ways(a, b)


_MELTED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


@query(
    "unpivot",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, '{c}' AS prop, CAST(nullif({c}, {n}) AS VARCHAR) AS val FROM lineitem"
        for c, n in zip(_MELTED, ["7e0", "0e0", "0e0", "0e0", "'N'"])
    ),
)
def unpivot(t):
    blanks = dict(zip(_MELTED, [7.0, 0.0, 0.0, 0.0, "N"]))
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        *[F.nullif(F.col(c), F.lit(v)).alias(c) for c, v in blanks.items()],
    )
    return shape.unpivot(
        lines, exclude=["l_orderkey", "l_linenumber", "l_partkey"], remove=["L_SUPPKEY"], field_name="prop", value_name="val"
    )


# --- generators ------------------------------------------------------------------


@query(
    "generate_series",
    """SELECT g.n AS generated_number, count(o_orderkey) AS n_orders
       FROM (SELECT unnest(generate_series(1, max(o_custkey) + 5)) AS n FROM orders) g
       LEFT JOIN orders ON o_custkey = g.n GROUP BY 1""",
)
def numbered_customers(t):
    """Orders of every customer number, with the numbers that never ordered."""
    top = t.orders.agg(F.max("o_custkey")).first()[0] + 5
    counts = t.orders.groupBy(F.col("o_custkey").alias("generated_number")).agg(F.count("*").alias("n"))
    return generate_series(t.spark, top).join(counts, "generated_number", "left").select(
        "generated_number", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders")
    )


@query(
    "date_spine",
    """WITH s AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS date_hour FROM events)
       SELECT date_hour, count(event_id) AS n_events FROM s
       LEFT JOIN events ON date_trunc('hour', ts) = date_hour
       WHERE date_hour < (SELECT date_trunc('hour', max(ts)) FROM events) GROUP BY 1""",
)
def hourly_events(t):
    """Events per hour without gaps, up to but excluding the hour of the newest event."""
    first, last = t.events.agg(
        F.min(F.date_trunc("hour", "ts").cast("timestamp_ntz")), F.max(F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    ).first()
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_hour")
    counts = t.events.groupBy(hour).agg(F.count("*").alias("n"))
    return date_spine(t.spark, "hour", first, last).join(counts, "date_hour", "left").select(
        "date_hour", F.coalesce("n", F.lit(0)).cast("long").alias("n_events")
    )


@query(
    "date_spine_month",
    """WITH s AS (SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)), max(l_shipdate), INTERVAL 1 MONTH)) AS m
         FROM lineitem)
       SELECT CAST(m AS DATE) AS date_month, count(l_orderkey) AS n_lines FROM s
       LEFT JOIN lineitem ON date_trunc('month', l_shipdate) = m
       WHERE m < (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem) GROUP BY 1""",
)
def monthly_lines(t):
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    first, last = t.lineitem.agg(F.min(month), F.max(month)).first()
    counts = t.lineitem.groupBy(month.alias("date_month")).agg(F.count("*").alias("n"))
    return date_spine(t.spark, "month", first, last).join(counts, "date_month", "left").select(
        "date_month", F.coalesce("n", F.lit(0)).cast("long").alias("n_lines")
    )
