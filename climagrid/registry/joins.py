"""Join queries that are not part of a mart."""

from pyspark.sql import functions as F

from climagrid.operators.quality import join_full_on_groups
from climagrid.operators.sets import join_natural
from climagrid.registry import query


@query(
    "join_natural",
    """SELECT n_nationkey, n_name, n_regionkey, c_custkey, c_acctbal, r_name FROM nation
       JOIN (SELECT c_nationkey AS n_nationkey, c_custkey, c_acctbal FROM customer) USING (n_nationkey)
       JOIN (SELECT r_regionkey AS n_regionkey, r_name FROM region) USING (n_regionkey)""",
)
def natural(t):
    customers = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_acctbal")
    regions = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return join_natural(join_natural(customers, t.nation), regions)


@query(
    "join_full_on_groups",
    """SELECT a.k AS k_a, b.k AS k_b, n_orders, n_lines
       FROM (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1) a
       FULL JOIN (SELECT l_partkey AS k, count(*) AS n_lines FROM lineitem GROUP BY 1) b ON a.k = b.k""",
)
def full_on_groups(t):
    a = t.orders.select(F.col("o_custkey").alias("k"))
    b = t.lineitem.select(F.col("l_partkey").alias("k"))
    return join_full_on_groups(a, b, ["k"], "n_orders", "n_lines")


@query(
    "join_anti",
    "SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL",
)
def anti(t):
    # Distinct keys are combined before the shuffle; a frequent one arrives once per map task.
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey", "left_anti")
