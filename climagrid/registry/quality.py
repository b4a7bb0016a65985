"""Data-quality queries: the failing rows, and a suite of counts."""

from datetime import datetime

from pyspark.sql import functions as F

from climagrid.operators import quality as Q
from climagrid.registry import query
from climagrid.registry.shaping import shipping_ranges

_Q = "nullif(l_quantity, 7e0)"


def _lines(t):
    return t.lineitem.withColumn("l_quantity", F.nullif(F.col("l_quantity"), F.lit(7.0)))


_LINES = "(SELECT * REPLACE (nullif(l_quantity, 7e0) AS l_quantity) FROM lineitem)"


@query("dq_accepted_range", f"SELECT * FROM {_LINES} WHERE NOT (l_quantity > 2) OR NOT (l_quantity < 49)")
def accepted_range(t):
    return Q.dq_accepted_range(_lines(t), "l_quantity", 2, 49, inclusive=False)


@query(
    "dq_at_least_one",
    """SELECT user_id, day, count(amount) AS filler_column FROM (SELECT user_id, CAST(ts AS DATE) AS day,
         CASE WHEN event_type = 'purchase' THEN value END AS amount FROM events) GROUP BY 1, 2 HAVING count(amount) = 0""",
)
def at_least_one(t):
    amounts = t.events.select(
        "user_id", F.col("ts").cast("date").alias("day"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount")
    )
    return Q.dq_at_least_one(amounts, "amount", ["user_id", "day"])


@query(
    "dq_at_least_one_table",
    "SELECT count(missing) AS filler_column FROM (SELECT nullif(l_tax, l_tax) AS missing FROM lineitem) HAVING count(missing) = 0",
)
def at_least_one_in_table(t):
    return Q.dq_at_least_one(t.lineitem.select(F.nullif(F.col("l_tax"), F.col("l_tax")).alias("missing")), "missing")


@query(
    "dq_cardinality_equality",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS num_rows FROM orders GROUP BY 1),
         b AS (SELECT l_partkey AS k, count(*) AS num_rows FROM lineitem GROUP BY 1)
       (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def cardinality_equality(t):
    orders = t.orders.select(F.col("o_custkey").alias("k"))
    return Q.dq_cardinality_equality(orders, "k", t.lineitem, "l_partkey")


def _nations(t):
    return t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))


_NATION_COUNTS = """FROM (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1) a
  FULL JOIN (SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY 1) b ON a.nation = b.nation"""


@query(
    "dq_equal_rowcount",
    f"""SELECT a.nation AS nation_a, b.nation AS nation_b, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
        {_NATION_COUNTS}""",
)
def equal_rowcount(t):
    return Q.dq_equal_rowcount(*_nations(t), ["nation"])


@query(
    "dq_fewer_rows_than",
    f"""SELECT a.nation AS nation_a, b.nation AS nation_b, a.n AS count_our_model, b.n AS count_comparison_model,
          CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta {_NATION_COUNTS}""",
)
def fewer_rows_than(t):
    return Q.dq_fewer_rows_than(*_nations(t), ["nation"])


@query(
    "dq_fewer_rows_than_table",
    """SELECT a.n AS count_our_model, b.n AS count_comparison_model,
         CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta
       FROM (SELECT count(*) AS n FROM orders) a, (SELECT count(*) AS n FROM customer) b""",
)
def fewer_rows_in_table(t):
    return Q.dq_fewer_rows_than(t.orders, t.customer)


_EQUALITY_SIDE = "SELECT o_orderkey, {status} AS o_orderstatus, round(CAST({price} AS DECIMAL(38,6)), 2) AS price FROM orders"
_EQUALITY_A = _EQUALITY_SIDE.format(status="o_orderstatus", price="o_totalprice")
_EQUALITY_B = _EQUALITY_SIDE.format(
    status="CASE o_orderpriority WHEN '1-URGENT' THEN 'U' ELSE o_orderstatus END", price="o_totalprice + 0.001e0"
)


@query(
    "dq_equality",
    f"""WITH a AS ({_EQUALITY_A}), b AS ({_EQUALITY_B}), d AS (
          SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
          UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM d""",
)
def equality(t):
    a = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"), F.lit(1).alias("batch"))
    b = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "U").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + 0.001).alias("price"),
        F.lit(2).alias("batch"),
    )
    found = Q.dq_equality(a, b, exclude_columns=["BATCH"], precision=2)
    return found.withColumn("price", F.col("price").cast("double"))


@query("dq_expression_is_true", f"SELECT * FROM {_LINES} WHERE NOT (l_quantity * l_discount < 2.5)")
def expression_is_true(t):
    return Q.dq_expression_is_true(_lines(t), "* l_discount < 2.5", "l_quantity")


_DAYS = "SELECT l_suppkey AS partition_by_col, CAST(l_shipdate AS DATE) AS lower_bound, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) - 1 AS upper_bound, l_orderkey, l_linenumber, l_partkey FROM lineitem"


@query(
    "dq_mutually_exclusive_ranges",
    f"""WITH r AS ({_DAYS}), o AS (SELECT partition_by_col, lower_bound, upper_bound,
          lead(lower_bound) OVER w AS next_lower_bound, lead(lower_bound) OVER w IS NULL AS is_last_record FROM r
          WINDOW w AS (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound, l_orderkey, l_linenumber, l_partkey)),
        c AS (SELECT *, coalesce(lower_bound < upper_bound, false) AS lower_bound_less_than_upper_bound,
          coalesce(upper_bound <= next_lower_bound, is_last_record, false) AS upper_bound_less_than_or_equal_to_next_lower_bound FROM o)
        SELECT * FROM c WHERE NOT (lower_bound_less_than_upper_bound AND upper_bound_less_than_or_equal_to_next_lower_bound)""",
)
def mutually_exclusive_ranges(t):
    ranges = shipping_ranges(t).withColumn("upper_day", F.date_sub("upper_day", 1))
    return Q.dq_mutually_exclusive_ranges(ranges, "lower_day", "upper_day", partition_by="l_suppkey")


@query(
    "dq_mutually_exclusive_ranges_table",
    """WITH o AS (SELECT o_totalprice AS lower_bound, o_totalprice + o_orderkey % 50 AS upper_bound,
          lead(o_totalprice) OVER w AS next_lower_bound, lead(o_totalprice) OVER w IS NULL AS is_last_record FROM orders
          WINDOW w AS (ORDER BY o_totalprice, o_totalprice + o_orderkey % 50, o_orderkey)),
        c AS (SELECT *, coalesce(lower_bound <= upper_bound, false) AS lower_bound_less_than_or_equal_to_upper_bound,
          coalesce(upper_bound < next_lower_bound, is_last_record, false) AS upper_bound_less_than_next_lower_bound FROM o)
        SELECT * FROM c WHERE NOT (lower_bound_less_than_or_equal_to_upper_bound AND upper_bound_less_than_next_lower_bound)""",
)
def mutually_exclusive_ranges_in_table(t):
    ranges = t.orders.select(
        F.col("o_totalprice").alias("low"), (F.col("o_totalprice") + F.col("o_orderkey") % 50).alias("high")
    )
    return Q.dq_mutually_exclusive_ranges(ranges, "low", "high", gaps="required", zero_length_range_allowed=True)


@query(
    "dq_not_accepted_values",
    "SELECT DISTINCT p_brand AS value_field FROM part WHERE p_brand IN ('Brand#2', 'Brand#17', 'Brand#999')",
)
def not_accepted_values(t):
    return Q.dq_not_accepted_values(t.part, "p_brand", ["Brand#2", "Brand#17", "Brand#999"])


@query(
    "dq_accepted_values",
    """SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE NOT (event_type IN ('click', 'view', 'signup'))
       GROUP BY 1""",
)
def accepted_values(t):
    return Q.dq_accepted_values(t.events, "event_type", ["click", "view", "signup"])


@query(
    "dq_not_constant",
    """SELECT user_id, day, count(DISTINCT event_type) AS filler_column FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
       GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 1""",
)
def not_constant(t):
    return Q.dq_not_constant(t.events.withColumn("day", F.col("ts").cast("date")), "event_type", ["user_id", "day"])


@query(
    "dq_not_empty_string",
    """SELECT trim(replace(c_mktsegment, 'BUILDING', '  ')) AS c_mktsegment FROM customer
       WHERE trim(replace(c_mktsegment, 'BUILDING', '  ')) = ''""",
)
def not_empty_string(t):
    blanked = F.replace(F.col("c_mktsegment"), F.lit("BUILDING"), F.lit("  "))
    return Q.dq_not_empty_string(t.customer.withColumn("c_mktsegment", blanked), "c_mktsegment")


@query("dq_not_null", f"SELECT * FROM {_LINES} WHERE l_quantity IS NULL")
def not_null(t):
    return Q.dq_not_null(_lines(t), "l_quantity")


@query(
    "dq_not_null_proportion",
    f"""SELECT l_suppkey, round(sum(CASE WHEN l_quantity IS NULL THEN 0 ELSE 1 END) / CAST(count(*) AS DOUBLE), 9)
          AS not_null_proportion FROM {_LINES} GROUP BY 1
        HAVING sum(CASE WHEN l_quantity IS NULL THEN 0 ELSE 1 END) / CAST(count(*) AS DOUBLE) < 0.98""",
)
def not_null_proportion(t):
    from climagrid.functions.arithmetic import round_half_away

    found = Q.dq_not_null_proportion(_lines(t), "l_quantity", 0.98, group_by=["l_suppkey"])
    return found.withColumn("not_null_proportion", round_half_away("not_null_proportion", 9))


_NOW = datetime(2024, 1, 31, 6, 30)


@query(
    "dq_recency",
    f"""SELECT user_id, max(ts) AS most_recent, TIMESTAMP '{_NOW}' - INTERVAL 12 HOUR AS threshold FROM events
        GROUP BY 1 HAVING max(ts) < TIMESTAMP '{_NOW}' - INTERVAL 12 HOUR""",
)
def recency(t):
    return Q.dq_recency(t.events, "ts", "hour", 12, _NOW, group_by=["user_id"])


@query(
    "dq_recency_days",
    f"""SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, CAST(TIMESTAMP '{_NOW}' - INTERVAL 2 DAY AS DATE) AS threshold
        FROM events GROUP BY 1 HAVING CAST(max(ts) AS DATE) < CAST(TIMESTAMP '{_NOW}' - INTERVAL 2 DAY AS DATE)""",
)
def recency_in_days(t):
    return Q.dq_recency(t.events, "ts", "day", 2, _NOW, ignore_time_component=True, group_by=["user_id"])


@query(
    "dq_relationships_where",
    """SELECT o.id, c.id AS right_id FROM (SELECT o_custkey AS id FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus <> 'P') o
       LEFT JOIN (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 1000) c ON o.id = c.id WHERE c.id IS NULL""",
)
def relationships_where(t):
    return Q.dq_relationships_where(t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus <> 'P'", "c_acctbal > 1000")


@query(
    "dq_sequential_values",
    """WITH w AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)
         AS previous_l_linenumber FROM lineitem)
       SELECT * FROM w WHERE NOT (l_linenumber = previous_l_linenumber + 1)""",
)
def sequential_values(t):
    return Q.dq_sequential_values(t.lineitem, "l_linenumber", group_by=["l_orderkey"])


@query(
    "dq_sequential_dates",
    """WITH w AS (SELECT CAST(o_orderdate AS DATE) AS day, lag(CAST(o_orderdate AS DATE)) OVER (ORDER BY o_orderdate) AS previous_day
         FROM orders)
       SELECT * FROM w WHERE NOT (CAST(day AS TIMESTAMP) = CAST(previous_day + INTERVAL 1 DAY AS TIMESTAMP))""",
)
def sequential_dates(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    return Q.dq_sequential_values(days, "day", interval=1, datepart="day")


@query(
    "dq_unique_combination",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def unique_combination(t):
    return Q.dq_unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_unique",
    "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
def unique(t):
    return Q.dq_unique(t.orders, "o_custkey")


@query("dq_assert_equal", f"SELECT * FROM {_LINES} WHERE l_quantity <> l_linenumber")
def assert_equal(t):
    return Q.dq_assert_equal(_lines(t), "l_quantity", "l_linenumber")


_SUITE = {
    "quantity_range": (f"SELECT count(*) FROM {_LINES} WHERE NOT (l_quantity >= 1) OR NOT (l_quantity <= 49)", "fail"),
    "tax_is_low": ("SELECT count(*) FROM lineitem WHERE NOT (l_tax < 0.5)", "pass"),
    "returned_has_quantity": (f"SELECT count(*) FROM {_LINES} WHERE l_returnflag = 'R' AND l_quantity IS NULL", "warn"),
    "known_customers": (
        "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)", "fail",
    ),
    "lines_differ": (
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)", "fail",
    ),
    "nations_balanced": (f"SELECT coalesce(sum(coalesce(abs(a.n - b.n), 0)), 0) {_NATION_COUNTS}", "fail"),
    "same_orders": ("SELECT 0", "pass"),
    "must_differ": ("SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)", "pass"),
}


@query(
    "dq_suite",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST(({sql}) AS BIGINT) AS failures, '{status}' AS status"
        for name, (sql, status) in _SUITE.items()
    ),
)
def suite(t):
    lines = [
        Q.RowCheck("quantity_range", Q.bad_range("l_quantity", 1, 49)),
        Q.RowCheck("tax_is_low", Q.bad_expression("l_tax < 0.5")),
        Q.RowCheck("returned_has_quantity", Q.bad_null("l_quantity"), where=F.col("l_returnflag") == "R", severity="warn"),
        Q.unique_combination_check("lines_differ", ["l_orderkey", "l_linenumber"]),
    ]
    orders = [Q.unique_check("must_differ", "o_custkey", error_if="< 1", warn_if="< 0")]
    known = Q.dq_relationships_where(
        t.orders, "o_custkey", t.customer, "c_custkey", to_condition="c_acctbal > 0", counted=True
    )
    checks = [
        Q.Check("known_customers", known, Q.counted_failures()),
        Q.Check("nations_balanced", Q.dq_equal_rowcount(*_nations(t), ["nation"]), Q.equal_rowcount_failures()),
        Q.Check("same_orders", Q.dq_equality(t.orders, t.orders), Q.equality_failures()),
    ]
    return Q.dq_suite(checks, [(_lines(t), lines), (t.orders, orders)])


_GROUPS = {
    "price_given": "SELECT count(*) FROM orders WHERE NOT (o_totalprice > 1000)",
    "one_order_per_day": "SELECT count(*) FROM (SELECT 1 FROM d GROUP BY o_custkey, day HAVING count(*) > 1)",
    "customers_once": "SELECT count(*) FROM (SELECT 1 FROM d WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)",
    "some_clerk": "SELECT count(*) FROM (SELECT 1 FROM d GROUP BY o_custkey HAVING count(urgent) = 0)",
    "prices_vary": "SELECT count(*) FROM (SELECT 1 FROM d GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) = 1)",
    "mostly_urgent": "SELECT count(*) FROM (SELECT 1 FROM d GROUP BY day HAVING avg(CASE WHEN urgent IS NULL THEN 0e0 ELSE 1e0 END) < 0.3)",
}


@query(
    "dq_suite_groups",
    """WITH d AS (SELECT nullif(o_custkey, 10) AS o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority,
         CASE WHEN o_orderpriority < '3' THEN o_orderkey END AS urgent FROM orders) """
    + " UNION ALL ".join(f"SELECT '{n}' AS \"check\", CAST(({sql}) AS BIGINT) AS failures FROM (SELECT 1)" for n, sql in _GROUPS.items()),
)
def suite_of_groups(t):
    """Row and group rules over three groupings of one table, in one scan."""
    orders = t.orders.select(
        F.nullif(F.col("o_custkey"), F.lit(10)).alias("o_custkey"), F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority",
        "o_totalprice", F.when(F.col("o_orderpriority") < "3", F.col("o_orderkey")).alias("urgent"),
    )
    rules = [
        Q.RowCheck("price_given", Q.bad_expression("o_totalprice > 1000")),
        Q.unique_combination_check("one_order_per_day", ["o_custkey", "day"]),
        Q.unique_check("customers_once", "o_custkey"),
        Q.at_least_one_check("some_clerk", "urgent", ["o_custkey"]),
        Q.not_constant_check("prices_vary", "o_orderpriority", ["o_custkey"]),
        Q.not_null_proportion_check("mostly_urgent", "urgent", ["day"], 0.3),
    ]
    return Q.dq_suite(row_checks=[(orders, rules)]).drop("status")
