"""Incremental planning: high-water marks, missing months, request batches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Publication lags, first periods and batch size of the two products.
MONTHLY_LAG_MONTHS = 2
MONTHLY_FIRST = date(1940, 1, 1)
DAILY_LAG_DAYS = 15
DAILY_FIRST = date(2021, 1, 1)
YEARS_PER_BATCH = 10
# Requests that one task sorts; about 75 MB in memory.
SORT_ROWS = 500_000

# Bits 1 to 12 set: all months of a year.
ALL_MONTHS = sum(1 << month for month in range(1, 13))


def high_water_mark(seeds: DataFrame, observations: DataFrame, variable: str, time: str) -> DataFrame:
    """Latest time of every seeded variable; variables without data keep NULL."""
    latest = observations.groupBy(variable).agg(F.max(time).alias("latest"))
    return seeds.select(variable).distinct().join(latest, variable, "left")


def _months(marks: DataFrame, first: Column, cutoff: Column) -> DataFrame:
    """One row per missing month from ``first`` to ``cutoff``.

    Marks are few and small, so adaptive execution leaves them in one task, which
    would then write out every month. Years are listed first and dealt to a fixed
    number of tasks; grouping by year afterwards needs no other shuffle.
    """
    others = [c for c in marks.columns if c != "latest"]
    tasks = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    years = F.when(first <= cutoff, F.sequence(F.year(first), F.year(cutoff)))
    from_month = F.when(F.col("year") == F.year("_first"), F.month("_first")).otherwise(1)
    to_month = F.when(F.col("year") == F.year("_cutoff"), F.month("_cutoff")).otherwise(12)
    return (
        marks.select(*others, first.alias("_first"), cutoff.alias("_cutoff"), F.explode(years).alias("year"))
        .repartition(tasks, *others, "year")
        .select(*others, "year", F.explode(F.sequence(from_month, to_month)).alias("month"))
        .select(*others, F.make_date("year", "month", F.lit(1)).alias("month_start"), "year", "month")
    )


def missing_months_after(
    marks: DataFrame, today: date, lag_months: int = MONTHLY_LAG_MONTHS, first: date = MONTHLY_FIRST
) -> DataFrame:
    """Months after the latest loaded one up to the month ``lag_months`` ago, inclusive."""
    cutoff = F.trunc(F.add_months(F.lit(today), -lag_months), "MM")
    start = F.coalesce(F.add_months(F.trunc(F.col("latest").cast("date"), "MM"), 1), F.lit(first))
    return _months(marks, start, cutoff)


def missing_months_from(
    marks: DataFrame, today: date, lag_days: int = DAILY_LAG_DAYS, first: date = DAILY_FIRST
) -> DataFrame:
    """Months from the latest loaded one, which may be partial, up to ``lag_days`` ago."""
    cutoff = F.trunc(F.date_sub(F.lit(today), lag_days), "MM")
    start = F.coalesce(F.trunc(F.col("latest").cast("date"), "MM"), F.lit(first))
    return _months(marks, start, cutoff)


def plan_batches(
    months: DataFrame, by: Sequence[str] = (), years_per_batch: int = YEARS_PER_BATCH
) -> DataFrame:
    """Request batches (batch, years, months) per ``by``.

    Only whole years share a batch, so years times months never asks for more
    than is missing; each partial year is a batch of its own, after the whole
    ones. The months of a year travel as one bit mask, and each ``by`` is numbered
    in a window over its calendar years.
    """
    by = list(by)
    mask = F.bit_or(F.expr("shiftleft(1, month)"))
    per_year = months.groupBy(*by, "year").agg(mask.alias("_mask"))
    whole = (F.col("_mask") == ALL_MONTHS).cast("int")
    own = W.partitionBy(*(by or [F.lit(0)]))
    n_whole = F.sum(whole).over(own)
    position = F.row_number().over(own.orderBy(whole.desc(), "year")) - 1
    batch = F.when(position < n_whole, F.floor(position / years_per_batch)).otherwise(
        F.ceil(n_whole / years_per_batch) + position - n_whole
    )
    numbered = per_year.withColumn("batch", (batch + 1).cast("int"))
    in_mask = F.filter(
        F.sequence(F.lit(1), F.lit(12)), lambda m: F.getbit(F.col("_mask"), m) == 1
    )
    return numbered.groupBy(*by, "batch").agg(
        F.sort_array(F.collect_list("year")).alias("_years"), F.max("_mask").alias("_mask")
    ).select(
        *by,
        "batch",
        F.transform("_years", lambda y: y.cast("string")).alias("years"),
        F.transform(in_mask, lambda m: F.lpad(m.cast("string"), 2, "0")).alias("months"),
    )


def plan_month_requests(months: DataFrame, specs: DataFrame, variable: str = "variable") -> DataFrame:
    """One request per variable and month, with the variable's request options, in this order over the partitions.

    Requests compress so well that adaptive execution would leave millions of them to one sort, which holds them
    unpacked. They are counted first and dealt to as many tasks as their number asks for.
    """
    requests = months.join(specs, variable).select(
        *specs.columns,
        F.col("year").cast("string").alias("year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"),
    )
    order = [variable, "year", "month"]
    return requests.repartitionByRange(requests.count() // SORT_ROWS + 1, *order).sortWithinPartitions(*order)
