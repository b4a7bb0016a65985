"""Writing and maintaining stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from climagrid.sinks.manifest import file_system

# Fixed value: rows of a published sheet, header included.
SHEET_MAX_ROWS = 1_048_576
# Fixed value: columns that are not published.
UNPUBLISHED = ("key_id",)

PERIOD = ("year", "month")


def _layout(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Even output files per partition; a hot partition is split over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create or wholly replace the table at ``path``."""
    writer = _layout(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.parquet(path, partitionBy=list(partition_by) or None)


def positional(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` under the names and types of ``target``, matched by position."""
    if len(df.columns) != len(target.columns):
        raise ValueError(f"{len(df.columns)} columns given, the table has {len(target.columns)}")
    renamed = df.toDF(*target.columns)
    return renamed.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in target.schema])


def by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` in the shape of ``target``: absent columns NULL, unknown columns refused."""
    given = {c.lower() for c in df.columns}
    unknown = given - {c.lower() for c in target.columns}
    if unknown:
        raise ValueError(f"not in the table: {', '.join(sorted(unknown))}")
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def append_positional(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    target = df.sparkSession.read.parquet(path)
    _append(positional(df, target), path, partition_by)


def append_by_name(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    target = df.sparkSession.read.parquet(path)
    _append(by_name(df, target), path, partition_by)


def _append(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    _layout(df, partition_by).write.mode("append").parquet(path, partitionBy=list(partition_by) or None)


def with_period(df: DataFrame, time: str) -> DataFrame:
    """Add the year and month columns that bronze tables are partitioned by."""
    return df.withColumn("year", F.year(time)).withColumn("month", F.month(time))


def replace_newest_month(existing: DataFrame, incoming: DataFrame, time: str) -> DataFrame:
    """``existing`` without its newest, possibly partial, month, plus ``incoming`` by name."""
    month = F.trunc(F.col(time).cast("date"), "MM")
    newest = existing.agg(F.trunc(F.max(time).cast("date"), "MM").alias("m")).scalar()
    kept = existing.withColumn("_newest", newest).where(month.isNull() | (month != F.col("_newest")))
    return kept.drop("_newest").unionAll(by_name(incoming, existing))


def replace_period(incoming: DataFrame, path: str, time: str, older: bool = False) -> None:
    """Swap in the newest stored month and later ones from ``incoming``; all other months stay untouched.

    One dynamic partition overwrite replaces delete-then-append, so a failure in
    between cannot lose a month. Rows without a time are refused, and so are months
    before the newest stored one unless ``older`` says that they were delivered in
    full: the write then fails before it has changed anything.
    """
    newest = None if older else newest_stored(incoming.sparkSession, path)
    ready = _layout(checked_periods(with_period(incoming, time), time, newest), PERIOD)
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
        path, partitionBy=list(PERIOD)
    )


def checked_periods(dated: DataFrame, time: str, newest: tuple[int, int] | None) -> DataFrame:
    """``dated`` with year and month; rows without a time, or of a month before ``newest``, fail the job that reads them."""
    year, month = F.col("year"), F.col("month")
    refused = F.when(year.isNull(), F.raise_error(F.lit(f"rows without {time}")))
    if newest is not None:
        number = newest[0] * 12 + newest[1]
        refused = refused.when(year * 12 + month < number, F.raise_error(F.lit("a month before the newest stored one")))
    return dated.withColumn("year", refused.otherwise(year).cast("int"))


def newest_stored(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """The newest (year, month) of a table partitioned by them, from the names of its folders."""
    found = None
    for year in sorted(_partition_values(spark, path, "year"), reverse=True):
        months = _partition_values(spark, f"{path.rstrip('/')}/year={year}", "month")
        if months:
            found = (year, max(months))
            break
    return found


def _partition_values(spark: SparkSession, path: str, name: str) -> list[int]:
    """Whole-number values of the partition folders ``name=...`` right below ``path``."""
    folder, files = file_system(spark, path)
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()]
    values = [n.removeprefix(f"{name}=") for n in names if n.startswith(f"{name}=")]
    return [int(v) for v in values if v.isdigit()]


def save_by_day(
    df: DataFrame, table: str, path: str, time: str, buckets: int, partition_by: Sequence[str] = PERIOD
) -> None:
    """Store daily observations as a catalogue table bucketed by day.

    Marts join their five inputs on coordinates and day. Inputs stored with the same
    number of buckets meet without a shuffle once the session allows partitioning on
    part of the join keys (``spark.sql.requireAllClusterKeysForCoPartition=false``). The
    day is the only key that can be bucketed on: Spark normalises floating-point join
    keys, which hides bucketing on coordinates.
    """
    days = df.withColumn(time, F.col(time).cast("date"))
    if partition_by:
        days = with_period(days, time)
    writer = _layout(days, [time]).write.mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, time).sortBy(time).saveAsTable(table)


def export_parquet(df: DataFrame, path: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def publishable(df: DataFrame, drop: Sequence[str] = UNPUBLISHED) -> DataFrame:
    """``df`` without the columns that are not published."""
    hidden = {c.lower() for c in drop}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in hidden])


def _too_many(rows: str, max_rows: int) -> str:
    return f"{rows} rows and a header exceed the limit of {max_rows:,}; split the data or publish Parquet"


def publish_guard(
    df: DataFrame, drop: Sequence[str] = UNPUBLISHED, max_rows: int = SHEET_MAX_ROWS
) -> DataFrame:
    """The publishable columns of ``df``; raises when rows plus header pass the limit.

    For stored frames. Counting stops at the limit in every task. ``publish`` checks while it writes instead.
    """
    rows = df.limit(max_rows).count()
    if rows + 1 > max_rows:
        raise RuntimeError(_too_many(f"at least {rows:,}", max_rows))
    return publishable(df, drop)


def publish(df: DataFrame, path: str, drop: Sequence[str] = UNPUBLISHED, max_rows: int = SHEET_MAX_ROWS) -> int:
    """Guarded CSV with a header; returns the number of rows.

    The frame is evaluated once: rows are counted while they are written to a folder next to ``path``, which takes the place of
    ``path`` only if they fit. A task that alone passes the limit stops there. A refused or failed write leaves what was published before.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    too_many = F.raise_error(F.lit(_too_many(f"at least {max_rows:,}", max_rows)))
    guarded = publishable(df, drop).withColumn("_fits", F.when(in_task >= max_rows - 1, too_many.cast("boolean")).otherwise(True))
    seen = Observation("publish")
    counted = guarded.where("_fits").drop("_fits").observe(seen, F.count(F.lit(1)).alias("rows"))
    staging = f"{path}-staging-{uuid.uuid4().hex}"
    folder, files = file_system(spark, staging)
    try:
        counted.write.csv(staging, header=True)
        rows = seen.get["rows"]
        if rows + 1 > max_rows:
            raise RuntimeError(_too_many(f"{rows:,}", max_rows))
        target = file_system(spark, path)[0]
        files.delete(target, True)
        if not files.rename(folder, target):
            raise RuntimeError(f"cannot move {staging} to {path}")
    finally:
        files.delete(folder, True)
    return rows


def published_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, bytes) of published folders, from file listings alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    sized = None
    for path in paths:
        one = files.load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("file_size_bytes"))
        one = one.select(F.lit(path).alias("path"), "file_size_bytes")
        sized = one if sized is None else sized.unionAll(one)
    return sized
