from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from climagrid.operators import quality as Q

from conftest import rows

FLOATS = [62.3888186, 81.2511656, 23.3959675, 72.2100841, 68.6029434, 72.7861425, 35.3662223, 89.1524680, 19.5755431, 22.9237047]


def test_accepted_range(spark):
    df = spark.createDataFrame([(-1,), (11,), (None,)], "id int")
    assert Q.dq_accepted_range(df, "id", -1, 11).count() == 0
    assert Q.dq_accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert rows(Q.dq_accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert rows(Q.dq_accepted_range(df.where("id <> -1"), "id", 0)) == []
    assert rows(Q.dq_accepted_range(df, "id", max_value=0)) == [(11,)]


def test_at_least_one(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "field string, value int")
    assert Q.dq_at_least_one(df, "field").count() == 0
    assert rows(Q.dq_at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert rows(Q.dq_at_least_one(df.where("field = 'b'"), "value")) == [(0,)]
    assert rows(Q.dq_at_least_one(df.where("false"), "value")) == [(0,)]


def test_cardinality_equality(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "same_name int")
    b = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "same_name int, different_name int")
    assert Q.dq_cardinality_equality(a, "same_name", b, "same_name").count() == 0
    assert Q.dq_cardinality_equality(a, "same_name", b, "different_name").count() == 0
    c = spark.createDataFrame([(1,), (1,), (None,), (4,)], "other int")
    assert rows(Q.dq_cardinality_equality(a, "same_name", c, "other")) == [(1, 1), (1, 2), (2, 1), (3, 1), (4, 1), (None, 1)]


def test_row_counts(spark):
    one = spark.createDataFrame([(1,), (1,), (2,)], "field int")
    assert Q.dq_equal_rowcount(one, one).agg(Q.equal_rowcount_failures()).first()[0] == 0
    assert Q.dq_equal_rowcount(one, one, ["field"]).agg(Q.equal_rowcount_failures()).first()[0] == 0
    other = spark.createDataFrame([(1,), (3,), (3,)], "field int")
    by_group = Q.dq_equal_rowcount(one, other, ["field"])
    assert rows(by_group) == [(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 2, None)]
    assert by_group.agg(Q.equal_rowcount_failures()).first()[0] == 1
    less = spark.createDataFrame([(1, i) for i in (1, 2, 3)], "col_a int, field int")
    more = spark.createDataFrame([(1, i) for i in (1, 2, 3, 4)], "col_a int, field int")
    for group in ([], ["col_a"]):
        assert Q.dq_fewer_rows_than(less, more, group).agg(Q.fewer_rows_failures()).first()[0] == 0
        assert Q.dq_fewer_rows_than(less, less, group).agg(Q.fewer_rows_failures()).first()[0] == 1
        assert Q.dq_fewer_rows_than(more.unionAll(more), less, group).agg(Q.fewer_rows_failures()).first()[0] == 5


def test_equality(spark):
    a = spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 3, 3)], "col_a int, col_b int, col_c int")
    b = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 3, 2)], "col_a int, col_b int, col_c int")
    assert Q.dq_equality(a, a).count() == 0
    different = Q.dq_equality(a, b)
    assert different.count() == 6 and different.agg(Q.equality_failures()).first()[0] == 6
    assert Q.dq_equality(a, b, compare_columns=["col_a", "col_b"]).count() == 0
    assert Q.dq_equality(a, b, exclude_columns=["COL_C"]).count() == 0
    assert Q.dq_equality(a.drop("col_c"), a, exclude_columns=["col_c"]).count() == 0
    with pytest.raises(ValueError):
        Q.dq_equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        Q.dq_equality(a, b, compare_columns=["col_a"], exclude_columns=["col_b"])
    extra = a.unionAll(spark.createDataFrame([(9, 9, 9)], a.schema))
    assert Q.dq_equality(extra, a).agg(Q.equality_failures()).first()[0] == 2


def test_equality_of_floats(spark):
    a = spark.createDataFrame([(str(i), v, "a") for i, v in enumerate(FLOATS)], "id string, float_number double, to_ignore string")
    b = a.select("id", (F.col("float_number") + 1e-7).alias("float_number"), F.lit("b").alias("to_ignore"))
    assert Q.dq_equality(a, b, exclude_columns=["to_ignore"], precision=4).count() == 0
    assert Q.dq_equality(a, b, compare_columns=["id", "float_number"], precision=4).count() == 0
    assert Q.dq_equality(a, b, exclude_columns=["to_ignore"], precision=8).count() > 0
    assert Q.dq_equality(a, b, precision=4).count() > 0


def test_expression_is_true(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "col_a double, col_b double")
    assert Q.dq_expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert Q.dq_expression_is_true(df, "+ col_b = 1", "col_a").count() == 0
    assert Q.dq_expression_is_true(df.where("col_b = 0.5"), "= 0.5", "col_a").count() == 0
    assert Q.dq_expression_is_true(df, "= 0.5", "col_a").count() == 2


def test_mutually_exclusive_ranges(spark):
    gapless = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "lower_bound int, upper_bound int")
    check = Q.dq_mutually_exclusive_ranges
    assert check(gapless, "lower_bound", "upper_bound", gaps="not_allowed").count() == 0
    assert check(gapless, "lower_bound", "upper_bound").count() == 0
    assert check(gapless, "lower_bound", "upper_bound", gaps="required").count() == 2
    d = date
    gaps = spark.createDataFrame(
        [(1, d(2019, 1, 1), d(2019, 2, 1)), (1, d(2019, 3, 3), d(2019, 4, 1)), (2, d(2019, 5, 6), d(2019, 7, 2)), (2, d(2019, 7, 3), None)],
        "subscription_id int, valid_from date, valid_to date",
    )
    closed = F.coalesce("valid_to", F.lit(d(2099, 1, 1)))
    for rule in ("allowed", "required"):
        assert check(gaps, "valid_from", closed, "subscription_id", gaps=rule).count() == 0
    assert check(gaps, "valid_from", closed, "subscription_id", gaps="not_allowed").count() == 2
    open_end = check(gaps, "valid_from", "valid_to", "subscription_id").collect()
    assert [(r.partition_by_col, r.lower_bound, r.is_last_record) for r in open_end] == [(2, d(2019, 7, 3), True)]
    points = spark.createDataFrame(
        [(3, d(2020, 5, 6), d(2020, 5, 7)), (3, d(2020, 5, 8), d(2020, 5, 10)), (3, d(2020, 5, 8), d(2020, 5, 8)),
         (3, d(2020, 5, 12), d(2020, 5, 15)), (4, d(2020, 6, 6), d(2020, 6, 7)), (4, d(2020, 6, 8), d(2020, 6, 8)),
         (4, d(2020, 6, 9), d(2020, 6, 10))],
        "subscription_id int, valid_from date, valid_to date",
    )
    assert check(points, "valid_from", "valid_to", "subscription_id", zero_length_range_allowed=True).count() == 0
    assert check(points, "valid_from", "valid_to", "subscription_id").count() == 2
    with pytest.raises(ValueError):
        check(gapless, "lower_bound", "upper_bound", gaps="maybe")


def test_values(spark):
    cities = spark.createDataFrame([("Barcelona",), ("London",), ("Paris",), ("Paris",), (None,)], "city string")
    assert Q.dq_not_accepted_values(cities, "city", ["Madrid", "Berlin"]).count() == 0
    assert rows(Q.dq_not_accepted_values(cities, "city", ["Paris"])) == [("Paris",)]
    assert rows(Q.dq_accepted_values(cities, "city", ["London", "Barcelona"])) == [("Paris", 2)]
    assert rows(Q.dq_unique(cities, "city")) == [("Paris", 2)]
    assert Q.dq_not_null(cities, "city").count() == 1


def test_not_constant(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 5), (2, 5), (3, None)], "col_a int, field int")
    assert Q.dq_not_constant(df, "field").count() == 0
    assert rows(Q.dq_not_constant(df, "field", ["col_a"])) == [(2, 1)]


def test_not_empty_string(spark):
    df = spark.createDataFrame([(" ",), ("",), ("a",), (None,)], "s string")
    assert rows(Q.dq_not_empty_string(df, "s")) == [("",), ("",)]
    assert rows(Q.dq_not_empty_string(df, "s", trim_whitespace=False)) == [("",)]


def test_not_null_proportion(spark):
    df = spark.createDataFrame(
        [(1, 1), (None, 2), (None, 3), (4, 4), (5, 5), (6, 6), (None, 7), (None, 8), (None, None), (10, 10)], "point_5 int, point_9 int"
    )
    assert Q.dq_not_null_proportion(df, "point_5", 0.5, 0.5).count() == 0
    assert Q.dq_not_null_proportion(df, "point_9", 0.9).count() == 0
    assert Q.dq_not_null_proportion(df, "point_5", 0, group_by=["point_9"]).count() == 0
    assert rows(Q.dq_not_null_proportion(df, "point_5", 0.6)) == [(0.5,)]


def test_recency(spark):
    now = datetime(2024, 5, 2, 12)
    fresh = spark.createDataFrame([(1, 1, datetime(2024, 5, 1, 13))], "col1 int, col2 int, created_at timestamp_ntz")
    for group in ([], ["col1"], ["col1", "col2"]):
        assert Q.dq_recency(fresh, "created_at", "day", 1, now, group_by=group).count() == 0
    old = spark.createDataFrame([(datetime(2024, 5, 1, 11),)], "created_at timestamp_ntz")
    assert Q.dq_recency(old, "created_at", "day", 1, now, ignore_time_component=True).count() == 0
    assert rows(Q.dq_recency(old, "created_at", "day", 1, now)) == [(datetime(2024, 5, 1, 11), datetime(2024, 5, 1, 12))]


def test_relationships_where(spark):
    child = spark.createDataFrame([(1,), (2,), (4,), (4,), (None,)], "id int")
    parent = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    assert Q.dq_relationships_where(child, "id", parent, "id", "id <> 4").count() == 0
    assert rows(Q.dq_relationships_where(child, "id", parent, "id")) == [(4, None), (4, None)]
    assert rows(Q.dq_relationships_where(child, "id", parent, "id", "id < 3", "id > 1")) == [(1, None)]


def test_sequential_values(spark):
    df = spark.createDataFrame([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "col_a int, my_even_sequence int")
    assert Q.dq_sequential_values(df, "my_even_sequence", 2).count() == 0
    assert Q.dq_sequential_values(df, "my_even_sequence", 2, group_by=["col_a"]).count() == 0
    assert rows(Q.dq_sequential_values(df, "my_even_sequence", 1, group_by=["col_a"])) == [(1, 4, 2), (1, 6, 4), (2, 10, 8)]
    hours = spark.createDataFrame([(datetime(2021, 1, 1, h),) for h in range(4)], "my_timestamp timestamp_ntz")
    assert Q.dq_sequential_values(hours, "my_timestamp", 1, "hour").count() == 0
    assert Q.dq_sequential_values(hours, "my_timestamp", 1, "day").count() == 3


def test_unique_combination(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "x"), (None, "x")], "m int, p string")
    assert rows(Q.dq_unique_combination(df, ["m", "p"])) == [(None, "x")]


def test_assert_equal_passes_null(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2)], "actual int, expected int")
    assert rows(Q.dq_assert_equal(df, "actual", "expected")) == [(1, 2)]


def test_suite(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (9, "")], "n int, s string")
    rules = [
        Q.RowCheck("n.in range", Q.bad_range("n", 0, 5)),
        Q.RowCheck("n_filled", Q.bad_null("n"), severity="warn"),
        Q.RowCheck("s_filled", Q.bad_empty_string("s"), where=F.col("n").isNull()),
        Q.RowCheck("tolerant", Q.bad_empty_string("s"), error_if="> 5", warn_if="> 0"),
    ]
    checks = [Q.Check("expected_failure", Q.dq_not_null(df, "n"), error_if="< 1", warn_if="< 0")]
    found = {r.check: (r.failures, r.status) for r in Q.dq_suite(checks, [(df, rules)]).collect()}
    assert found == {
        "n.in range": (1, "fail"), "n_filled": (1, "warn"), "s_filled": (0, "pass"), "tolerant": (1, "warn"),
        "expected_failure": (1, "pass"),
    }


def test_suite_fuses_group_rules(spark, folder):
    """Row and group rules of a table are one scan and one aggregate over it, with the results of the single checks."""
    data = [(1, "a", 5), (1, "a", 5), (1, "b", None), (2, "a", 7), (None, "b", None), (None, "b", None), (3, None, None)]
    spark.createDataFrame(data, "k int, s string, v int").write.parquet(folder)
    df = spark.read.parquet(folder)
    rules = [
        Q.unique_combination_check("pairs", ["k", "s"]), Q.unique_check("keys", "k"), Q.at_least_one_check("some", "v", ["s"]),
        Q.not_constant_check("vary", "v", ["s"]), Q.not_null_proportion_check("filled", "v", ["k"], 0.5, severity="warn"),
        Q.RowCheck("small", Q.bad_range("v", 0, 5)),
    ]
    out = Q.dq_suite(row_checks=[(df, rules)])
    assert {r.check: r.failures for r in out.collect()} == {
        "pairs": Q.dq_unique_combination(df, ["k", "s"]).count(), "keys": Q.dq_unique(df, "k").count(),
        "some": Q.dq_at_least_one(df, "v", ["s"]).count(), "vary": Q.dq_not_constant(df, "v", ["s"]).count(),
        "filled": Q.dq_not_null_proportion(df, "v", 0.5, group_by=["k"]).count(), "small": 1,
    }
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("FileScan") == 1
    empty = {r.check: (r.failures, r.status) for r in Q.dq_suite(row_checks=[(df.limit(0), rules)]).collect()}
    assert set(empty.values()) == {(0, "pass")}
    with pytest.raises(ValueError, match="group columns"):
        Q.dq_suite(row_checks=[(df, [Q.at_least_one_check("some", "v", [])])])
