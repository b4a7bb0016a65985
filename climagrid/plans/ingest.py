"""Loading decoded observations into bronze tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.sinks.tables import PERIOD, append_by_name, by_name, replace_period, replace_table, with_period


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def newest(spark: SparkSession, path: str, time: str) -> DataFrame:
    """(latest) of the table at ``path``; NULL when it is missing or empty.

    The newest period is found from partition values alone, so times are read
    from a single month.
    """
    table = stored(spark, path)
    if table is None:
        return spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("latest"))
    if set(PERIOD) <= set(table.columns):
        period = F.col("year") * 12 + F.col("month")
        last = table.agg(F.max(period)).scalar()
        table = table.where(period == last)
    return table.agg(F.max(time).alias("latest"))


def load_monthly(observations: DataFrame, path: str, time: str = "valid_time") -> None:
    """First load replaces the table, later loads append new months by name."""
    ready = with_period(observations, time)
    if stored(observations.sparkSession, path) is None:
        replace_table(ready, path, PERIOD)
    else:
        append_by_name(ready, path, PERIOD)


def load_daily(observations: DataFrame, path: str, time: str = "time", older: bool = False) -> None:
    """First load creates the table, later loads swap in the months they bring.

    The newest stored month may be partial and is downloaded again, so its rows are
    replaced rather than added to. Earlier months are refused unless ``older`` is set.
    """
    table = stored(observations.sparkSession, path)
    if table is None:
        replace_table(with_period(observations, time), path, PERIOD)
    else:
        known = table.drop(*PERIOD)
        replace_period(by_name(observations, known), path, time, older)


def load_all(
    loads: Mapping[str, Callable[[], DataFrame]], time: str = "time", older: bool = False, raise_at_end: bool = True
) -> dict[str, Exception]:
    """Load every daily table (path to a function that gives its new rows); a table that fails does not keep the others back.

    Returns the failures by path, or raises them together when all tables have been tried.
    """
    failed: dict[str, Exception] = {}
    for path, observations in loads.items():
        try:
            load_daily(observations(), path, time, older)
        except Exception as error:  # noqa: BLE001 - whatever it is, it belongs to this table
            failed[path] = error
    if failed and raise_at_end:
        raise ExceptionGroup(f"{len(failed)} of {len(loads)} tables failed: {', '.join(failed)}", list(failed.values()))
    return failed
