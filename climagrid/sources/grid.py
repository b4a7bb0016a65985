"""Packed grid cubes as long tables, and merging of files by coordinates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _known(value: Column, kind: T.DataType) -> Column:
    """NaN marks a missing value in a cube; tables hold NULL instead."""
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.FloatType, T.DoubleType)) else value


def grid_to_long(
    cubes: DataFrame, dims: Sequence[str], variables: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per coordinate tuple of each cube.

    A cube row holds one array per dimension and one flattened array per variable,
    the last dimension running fastest. All variables are unrolled together in a
    single pass, and a coordinate is looked up from the position by division. A
    variable that a cube lacks is NULL in its rows, and so is NaN. Cut very large cubes into several
    rows along a dimension, as chunked files already are.
    """
    arrays = [F.coalesce(F.col(v), F.array().cast(cubes.schema[v].dataType)).alias(v) for v in variables]
    cells = cubes.select(*keep, *dims, F.posexplode(F.arrays_zip(*arrays)).alias("_pos", "_cell"))
    columns: list[Column] = []
    stride: Column = F.lit(1)
    for name in reversed(list(dims)):
        index = F.floor(F.col("_pos") / stride).cast("int") % F.size(name)
        columns.insert(0, F.get(name, index).alias(name))
        stride = stride * F.size(name)
    found = [_known(F.col("_cell")[v], cubes.schema[v].dataType.elementType).alias(v) for v in variables]
    return cells.select(*keep, *columns, *found)


def combine_by_coords(
    parts: Sequence[DataFrame], coords: Sequence[str], drop: Sequence[str] = ("crs",)
) -> DataFrame:
    """Concatenate frames along their coordinates and merge different variables.

    Each coordinate tuple gives one row. Parts that disagree on a value fail
    rather than silently prefer one of them; NaN is a missing value and agrees with all.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.drop(*drop) for p in parts])
    return _merged(stacked, coords)


def combine_folder(
    spark: SparkSession, path: str | Sequence[str], coords: Sequence[str], drop: Sequence[str] = ("crs",), pattern: str = "*.parquet"
) -> DataFrame:
    """Merge all files below a folder by their coordinates, as ``combine_by_coords`` does with frames.

    The folder is one scan, whatever the number of files: columns are the union of those in the files' footers, which tasks
    read, and a variable that a file lacks is NULL in its rows. An error names two files that disagree.
    """
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    found = reader.parquet(*([path] if isinstance(path, str) else path)).drop(*drop)
    return _merged(found.select("*", F.col("_metadata.file_path").alias("_origin")), coords, "_origin")


def _merged(stacked: DataFrame, coords: Sequence[str], origin: str | None = None) -> DataFrame:
    variables = [c for c in stacked.columns if c not in coords and c != origin]

    def agreed(name: str) -> Column:
        kind = stacked.schema[name].dataType
        value = _known(F.col(f"`{name}`"), kind)
        low, high = F.min(value), F.max(value)
        words = [F.lit(f"conflicting values of {name}: "), low.cast("string"), F.lit(" and "), high.cast("string")]
        if origin:
            words += [F.lit(", for example in "), F.min_by(origin, value), F.lit(" and "), F.max_by(origin, value)]
        return F.when(low != high, F.raise_error(F.concat(*words)).cast(kind)).otherwise(high).alias(name)

    return stacked.groupBy(*coords).agg(*[agreed(v) for v in variables])
