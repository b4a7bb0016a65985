"""Missing values, undeclared cuts and column order at the edges of the library."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from climagrid.operators import shape
from climagrid.sources.grid import combine_by_coords, grid_to_long
from climagrid.sources.tables import scan_csv

NAN = float("nan")


def test_nan_cells_become_null(spark):
    cubes = spark.createDataFrame([([1.0, 2.0], [NAN, 5.0], [1, 2])], "lat array<double>, a array<double>, n array<int>")
    assert rows(grid_to_long(cubes, ["lat"], ["a", "n"])) == [(1.0, None, 1), (2.0, 5.0, 2)]


def test_nan_agrees_with_other_files(spark):
    one = spark.createDataFrame([(1, NAN), (2, NAN)], "x int, a double")
    two = spark.createDataFrame([(1, 2.0)], "x int, a double")
    assert rows(combine_by_coords([one, two], ["x"])) == [(1, 2.0), (2, None)]


def test_all_values_become_columns_or_none(spark):
    many = spark.range(300).select(F.col("id").cast("string").alias("value"))
    assert len(shape.value_list(many)) == 300
    with pytest.raises(ValueError, match="more than 299"):
        shape.value_list(many, most=299)


def test_pivot_takes_any_aggregate(spark):
    df = spark.createDataFrame([(1, "a", 4.0), (1, "a", 2.0)], "g int, k string, v double")
    found = shape.pivot(df, ["g"], "k", ["a"], agg=F.median, then_value=F.col("v"), else_value=None)
    assert rows(found) == [(1, 3.0)]


def test_csv_columns_by_name(spark, folder):
    spark.createDataFrame([("1", "x", "z")], "b string, a string, c string").write.csv(folder, header=True)
    assert rows(scan_csv(spark, folder, "a string, b int")) == [("x", 1)]
    with pytest.raises(ValueError, match="missing"):
        scan_csv(spark, folder, "a string, d int")
