from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from climagrid.operators import calendar as C
from climagrid.operators import incremental as I

from conftest import rows


def test_generate_series(spark):
    assert [r[0] for r in C.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        C.generate_series(spark, 0)


def test_date_spine_excludes_the_end(spark):
    days = [r.date_day for r in C.date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10)).collect()]
    assert days[0] == date(2018, 1, 1) and days[-1] == date(2018, 1, 9) and len(days) == 9
    months = [r.date_month for r in C.date_spine(spark, "month", date(2018, 1, 31), date(2018, 4, 30)).collect()]
    assert months == [date(2018, 1, 31), date(2018, 2, 28), date(2018, 3, 31)]
    hours = [r.date_hour for r in C.date_spine(spark, "hour", datetime(2018, 1, 1, 22), datetime(2018, 1, 2, 1)).collect()]
    assert hours == [datetime(2018, 1, 1, 22), datetime(2018, 1, 1, 23), datetime(2018, 1, 2, 0)]
    weeks = [r.date_week for r in C.date_spine(spark, "week", date(2018, 1, 1), date(2018, 1, 22)).collect()]
    assert weeks == [date(2018, 1, 1), date(2018, 1, 8), date(2018, 1, 15)]


@pytest.mark.parametrize(
    "part, start, end, n",
    [
        ("year", date(2018, 12, 31), date(2019, 1, 1), 1),
        ("quarter", date(2018, 3, 31), date(2018, 10, 1), 3),
        ("month", date(2018, 1, 31), date(2018, 3, 1), 2),
        ("minute", datetime(2018, 1, 1, 0, 0, 59), datetime(2018, 1, 1, 0, 2, 0), 2),
    ],
)
def test_intervals_count_boundaries(part, start, end, n):
    assert C.intervals_between(start, end, part) == n


def test_dim_datetime(spark):
    dim = C.dim_datetime(spark, date(2024, 3, 2))
    assert dim.columns == ["datetime_id", "datetime", "year", "month", "month_year", "day", "weekday"]
    assert dim.count() == (date(2024, 3, 2) - date(1940, 1, 1)).days
    last = dim.orderBy(F.desc("datetime")).first()
    assert tuple(last) == ("01/03/2024", date(2024, 3, 1), 2024, 3, "03/2024", 1, 5)
    assert dim.where("datetime = date '2024-02-25'").first()["weekday"] == 0


def marks(spark, *latest):
    return spark.createDataFrame([(f"v{i}", d) for i, d in enumerate(latest)], "variable string, latest timestamp_ntz")


def months(df):
    return {(r.variable, r.year, r.month) for r in df.collect()}


def test_missing_months_after(spark):
    df = marks(spark, datetime(2023, 11, 1), datetime(2024, 1, 1), datetime(2024, 5, 1))
    found = months(I.missing_months_after(df, date(2024, 3, 10)))
    assert found == {("v0", 2023, 12), ("v0", 2024, 1)}
    full = I.missing_months_after(marks(spark, None), date(1941, 3, 31))
    assert full.count() == 13 and full.agg(F.min("month_start")).first()[0] == date(1940, 1, 1)


def test_missing_months_from(spark):
    df = marks(spark, datetime(2024, 1, 20), datetime(2024, 6, 1), None)
    found = months(I.missing_months_from(df, date(2024, 3, 10), first=date(2024, 2, 1)))
    assert found == {("v0", 2024, 1), ("v0", 2024, 2), ("v2", 2024, 2)}


def test_high_water_mark(spark):
    seeds = spark.createDataFrame([("a",), ("b",)], "variable string")
    seen = spark.createDataFrame([("a", 1), ("a", 3)], "variable string, time int")
    assert rows(I.high_water_mark(seeds, seen, "variable", "time")) == [("a", 3), ("b", None)]


def brute_batches(pairs, size=10):
    by_year = {}
    for y, m in pairs:
        by_year.setdefault(y, set()).add(m)
    whole = sorted(y for y, ms in by_year.items() if len(ms) == 12)
    chunks = [whole[i : i + size] for i in range(0, len(whole), size)]
    out = [([str(y) for y in c], [f"{m:02d}" for m in range(1, 13)]) for c in chunks]
    out += [([str(y)], [f"{m:02d}" for m in sorted(ms)]) for y, ms in sorted(by_year.items()) if len(ms) < 12]
    return [(i + 1, *b) for i, b in enumerate(out)]


@pytest.mark.parametrize("start, stop", [((1940, 1), (2024, 1)), ((2023, 12), (2024, 2)), ((2000, 5), (2021, 12))])
def test_plan_batches(spark, start, stop):
    n = (stop[0] - start[0]) * 12 + stop[1] - start[1] + 1
    pairs = [((start[1] - 1 + i) // 12 + start[0], (start[1] - 1 + i) % 12 + 1) for i in range(n)]
    df = spark.createDataFrame([("x", y, m) for y, m in pairs], "variable string, year int, month int")
    expected = brute_batches(pairs)
    per_variable = I.plan_batches(df, ["variable"]).orderBy("batch")
    assert [(r.batch, r.years, r.months) for r in per_variable.collect()] == expected
    alone = I.plan_batches(df.drop("variable")).orderBy("batch")
    assert [(r.batch, r.years, r.months) for r in alone.collect()] == expected


def test_plan_month_requests(spark):
    need = spark.createDataFrame([("t", 2024, 2), ("t", 2024, 1), ("w", 2023, 12)], "variable string, year int, month int")
    specs = spark.createDataFrame([("t", ["max", "min"]), ("w", None)], "variable string, statistic array<string>")
    requests = I.plan_month_requests(need, specs).collect()
    assert [tuple(r) for r in requests] == [
        ("t", ["max", "min"], "2024", "01"), ("t", ["max", "min"], "2024", "02"), ("w", None, "2023", "12"),
    ]


def test_month_requests_are_sorted_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(I, "SORT_ROWS", 500)
    need = spark.range(1200).select(
        (F.col("id") % 100).alias("variable"), (F.lit(2020) - F.floor(F.col("id") / 1200)).cast("int").alias("year"),
        (F.floor(F.col("id") / 100) + 1).cast("int").alias("month"),
    )
    # An id twice gives its requests twice, one without months gives none, as do NULL ones.
    specs = spark.createDataFrame([(v, f"s{v}") for v in [*range(101), 7, None]], "variable long, target string")
    requests = I.plan_month_requests(need.unionByName(need.limit(1).withColumn("variable", F.lit(None).cast("long"))), specs)
    parts = [r["count"] for r in requests.groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) == 3 and sum(parts) == 1212 and max(parts) < 800
    rows = [(r.variable, r.target, r.year, r.month) for r in requests.collect()]
    assert rows == sorted((v, f"s{v}", "2020", f"{m:02d}") for v in [*range(100), 7] for m in range(1, 13))
