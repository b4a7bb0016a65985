"""Series, date spines and the date dimension."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: first day of the date dimension.
CALENDAR_START = date(1940, 1, 1)

# Text forms of day and month.
DAY_TEXT = "dd/MM/yyyy"
MONTH_TEXT = "MM/yyyy"

_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """Numbers 1 .. upper_bound, generated in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).toDF("generated_number")


def intervals_between(start: date, end: date, datepart: str) -> int:
    """Number of ``datepart`` boundaries between two dates or timestamps."""
    part = datepart.lower()
    if part in _MONTHS:
        span = _MONTHS[part]
        return (end.year * 12 + end.month - 1) // span - (start.year * 12 + start.month - 1) // span
    first, last = _as_datetime(start), _as_datetime(end)
    if part == "week":
        monday = datetime(1900, 1, 1)
        return (last - monday) // timedelta(days=7) - (first - monday) // timedelta(days=7)
    if part in _SECONDS:
        step = timedelta(seconds=_SECONDS[part])
        origin = datetime(1900, 1, 1)
        return (last - origin) // step - (first - origin) // step
    raise ValueError(f"unknown date part {datepart!r}")


def _as_datetime(value: date) -> datetime:
    return value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)


def add_parts(start: Column, datepart: str, count: Column, is_date: bool) -> Column:
    """``start`` moved by ``count`` date parts; month steps clamp to the month's end."""
    part = datepart.lower()
    if is_date and part in ("day", "week"):
        return F.date_add(start, (count * (7 if part == "week" else 1)).cast("int"))
    if is_date and part in _MONTHS:
        return F.add_months(start, (count * _MONTHS[part]).cast("int"))
    return F.timestamp_add(part.upper(), count.cast("int"), start)


def date_spine(spark: SparkSession, datepart: str, start: date, end: date) -> DataFrame:
    """One row per date part from ``start`` up to but excluding ``end``.

    The ids come from a parallel range, so no window over the whole spine is
    needed. Dates stay dates for parts of a day or more.
    """
    part = datepart.lower()
    is_date = not isinstance(start, datetime) and part not in ("hour", "minute", "second")
    kind = "date" if is_date else "timestamp_ntz"
    first = F.lit(start.isoformat()).cast(kind)
    last = F.lit(end.isoformat()).cast("timestamp_ntz")
    ids = generate_series(spark, intervals_between(start, end, part))
    name = f"date_{part}"
    spine = ids.select(add_parts(first, part, F.col("generated_number") - 1, is_date).alias(name))
    return spine.where(F.col(name) <= last)


def date_parts(day: str | Column) -> list[Column]:
    """Key, date, year, month, ``MM/yyyy``, day and weekday (0 = Sunday) of a date."""
    d = F.col(day) if isinstance(day, str) else day
    return [
        F.date_format(d, DAY_TEXT).alias("datetime_id"),
        d.alias("datetime"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, MONTH_TEXT).alias("month_year"),
        F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("weekday"),
    ]


def dim_datetime(spark: SparkSession, today: date, start: date = CALENDAR_START) -> DataFrame:
    """Date dimension from ``start`` to the day before ``today``."""
    return date_spine(spark, "day", start, today).select(*date_parts("date_day"))
