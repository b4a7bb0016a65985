"""Incremental planning queries: every user of the events table is a variable."""

from datetime import date

from pyspark.sql import functions as F

from climagrid.operators import incremental as I
from climagrid.registry import query

TODAY = date(2027, 3, 10)

# Every customer number is seeded; only users with events have a latest time.
_MARKS = """seeds AS (SELECT c_custkey AS variable FROM customer),
  marks AS (SELECT s.variable, max(ts) - INTERVAL 1 DAY * (s.variable % 900) AS latest
            FROM seeds s LEFT JOIN events e ON e.user_id = s.variable GROUP BY s.variable)"""


def _marks(t):
    seeds = t.customer.select(F.col("c_custkey").alias("variable"))
    seen = t.events.select(F.col("user_id").alias("variable"), "ts")
    marks = I.high_water_mark(seeds, seen, "variable", "ts")
    return marks.withColumn("latest", F.expr("latest - make_dt_interval(cast(variable % 900 as int))"))


def _months_sql(start_known: str, first: str, cutoff: str) -> str:
    return f"""m AS (SELECT variable, CAST(unnest(generate_series(
        CASE WHEN latest IS NULL THEN TIMESTAMP '{first}' ELSE {start_known} END, {cutoff}, INTERVAL 1 MONTH)) AS DATE)
        AS month_start FROM marks),
      months AS (SELECT variable, month_start, CAST(year(month_start) AS INTEGER) AS year,
        CAST(month(month_start) AS INTEGER) AS month FROM m)"""


_AFTER = _months_sql(
    "date_trunc('month', latest) + INTERVAL 1 MONTH",
    "1940-01-01",
    f"date_trunc('month', TIMESTAMP '{TODAY}' - INTERVAL 2 MONTH)",
)
_FROM = _months_sql(
    "CAST(date_trunc('month', latest) AS TIMESTAMP)",
    "2021-01-01",
    f"date_trunc('month', TIMESTAMP '{TODAY}' - INTERVAL 15 DAY)",
)


@query(
    "high_water_mark",
    """SELECT c_custkey AS variable, max(ts) AS latest FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1""",
)
def high_water_mark(t):
    seeds = t.customer.select(F.col("c_custkey").alias("variable"))
    return I.high_water_mark(seeds, t.events.select(F.col("user_id").alias("variable"), "ts"), "variable", "ts")


@query(
    "missing_months_after",
    f"WITH {_MARKS}, {_AFTER.replace('1940-01-01', '2015-01-01')} SELECT * FROM months",
)
def missing_months_after(t):
    return I.missing_months_after(_marks(t), TODAY, first=date(2015, 1, 1))


@query("missing_months_from", f"WITH {_MARKS}, {_FROM} SELECT * FROM months")
def missing_months_from(t):
    return I.missing_months_from(_marks(t), TODAY)


@query(
    "plan_batches",
    f"""WITH {_MARKS}, {_AFTER.replace('1940-01-01', '1980-01-01')},
        per_year AS (SELECT variable, year, count(DISTINCT month) AS n, string_agg(DISTINCT lpad(CAST(month AS VARCHAR), 2, '0'),
          ',' ORDER BY lpad(CAST(month AS VARCHAR), 2, '0')) AS months FROM months GROUP BY 1, 2),
        whole AS (SELECT variable, (row_number() OVER (PARTITION BY variable ORDER BY year) - 1) // 10 AS chunk, year, months
          FROM per_year WHERE n = 12),
        whole_batches AS (SELECT variable, chunk + 1 AS batch, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years,
          min(months) AS months FROM whole GROUP BY 1, 2),
        part AS (SELECT variable, row_number() OVER (PARTITION BY variable ORDER BY year) AS position, year, months
          FROM per_year WHERE n < 12)
        SELECT variable, CAST(batch AS INTEGER) AS batch, years, months FROM whole_batches
        UNION ALL
        SELECT variable, CAST(position + (SELECT count(*) FROM whole_batches w WHERE w.variable = part.variable) AS INTEGER),
          CAST(year AS VARCHAR), months FROM part""",
)
def plan_batches(t):
    plan = I.plan_batches(I.missing_months_after(_marks(t), TODAY, first=date(1980, 1, 1)), ["variable"])
    return plan.withColumn("years", F.array_join("years", ",")).withColumn("months", F.array_join("months", ","))


@query(
    "plan_month_requests",
    f"""WITH {_MARKS}, {_FROM}
        SELECT variable, c_mktsegment AS statistic, c_name AS target, CAST(year AS VARCHAR) AS year,
          lpad(CAST(month AS VARCHAR), 2, '0') AS month FROM months JOIN customer ON c_custkey = variable""",
)
def plan_month_requests(t):
    specs = t.customer.select(
        F.col("c_custkey").alias("variable"), F.col("c_mktsegment").alias("statistic"), F.col("c_name").alias("target")
    )
    return I.plan_month_requests(I.missing_months_from(_marks(t), TODAY), specs)
