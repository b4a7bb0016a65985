import time
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from climagrid.plans import catalog, ingest, requests
from climagrid.session import cut_lineage, is_small, scratch_path, shared_dir
from climagrid.sinks import tables as S
from climagrid.sinks.manifest import Manifest
from climagrid.sinks.months import MonthTable
from climagrid.sources import grid, tables

from conftest import rows


def observations(spark, *values):
    return spark.createDataFrame(list(values), "time timestamp_ntz, lat double, v double")


JAN, FEB = datetime(2024, 1, 5), datetime(2024, 2, 5)


def test_grid_to_long(spark):
    cube = spark.createDataFrame(
        [("f1", [JAN, FEB], [11.0, 11.5], [42.0, 42.5, 43.0], [float(i) for i in range(12)], [None, *range(1, 12)])],
        "file string, time array<timestamp_ntz>, lat array<double>, lon array<double>, t array<double>, p array<int>",
    )
    out = grid.grid_to_long(cube, ["time", "lat", "lon"], ["t", "p"], keep=["file"])
    assert out.columns == ["file", "time", "lat", "lon", "t", "p"] and out.count() == 12
    assert out.where("t = 0").first()["p"] is None
    row = out.where((F.col("time") == F.lit(FEB)) & (F.col("lat") == 11.5) & (F.col("lon") == 42.5)).first()
    assert (row.t, row.p) == (10.0, 10)
    lacking = cube.withColumn("p", F.lit(None).cast("array<int>"))
    out = grid.grid_to_long(lacking, ["time", "lat", "lon"], ["t", "p"])
    assert out.count() == 12 and out.where("p is null").count() == 12


def test_combine_by_coords(spark):
    a = spark.createDataFrame([(1, 10, 0.5), (2, 10, 0.6)], "time int, lat int, t_max double").withColumn("crs", F.lit(0))
    b = spark.createDataFrame([(1, 10, 0.1), (3, 10, 0.2)], "time int, lat int, t_min double").withColumn("crs", F.lit(0))
    c = spark.createDataFrame([(4, 10, 0.9)], "time int, lat int, t_max double")
    out = grid.combine_by_coords([a, b, c], ["time", "lat"])
    assert rows(out) == [(1, 10, 0.5, 0.1), (2, 10, 0.6, None), (3, 10, None, 0.2), (4, 10, 0.9, None)]
    again = grid.combine_by_coords([a, a], ["time", "lat"])
    assert again.count() == 2
    with pytest.raises(Exception, match="conflicting values of t_max"):
        grid.combine_by_coords([a, a.withColumn("t_max", F.col("t_max") + 1)], ["time", "lat"]).collect()


def test_combine_folder(spark, folder):
    """Many small files are one scan; errors name the files."""
    for i in range(30):
        kind = "t_max" if i % 2 else "t_min"
        frame = spark.createDataFrame([(i // 2, 10, float(i)), (99, i, float("nan"))], f"time int, lat int, {kind} double")
        frame.withColumn("crs", F.lit(0)).coalesce(1).write.parquet(f"{folder}/day{i}")
    out = grid.combine_folder(spark, folder, ["time", "lat"])
    assert sorted(out.columns) == ["lat", "t_max", "t_min", "time"]
    found = rows(out.where("time < 99").select("time", "t_min", "t_max"))
    assert found == rows(spark.createDataFrame([(i, 2.0 * i, 2.0 * i + 1) for i in range(15)], "time int, a double, b double"))
    assert out.where("time = 99 AND t_min IS NULL AND t_max IS NULL").count() == 30
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and "Union" not in out._jdf.queryExecution().toString()
    spark.createDataFrame([(0, 10, 7.5)], "time int, lat int, t_min double").write.parquet(f"{folder}/other")
    with pytest.raises(Exception, match="conflicting values of t_min: 0.0 and 7.5, for example in file:.*day0/.* and file:.*other/"):
        grid.combine_folder(spark, folder, ["time", "lat"]).collect()


def test_combine_folder_of_thousands_of_files(spark, folder):
    """Opening a folder is one listing and one job over footers, not a plan node per file."""
    spark.range(2_000).selectExpr("cast(id as int) AS time", "1 AS lat", "cast(id as double) AS v").repartition(1_000).write.parquet(folder)
    started = time.monotonic()
    out = grid.combine_folder(spark, folder, ["time", "lat"])
    out._jdf.queryExecution().executedPlan()
    assert time.monotonic() - started < 30
    assert out.count() == 2_000


def test_appends(spark, folder):
    S.replace_table(spark.createDataFrame([(1, "a")], "id bigint, name string"), folder)
    S.append_positional(spark.createDataFrame([(2, "b")], "x int, y string"), folder)
    S.append_by_name(spark.createDataFrame([(3,)], "ID int"), folder)
    assert rows(spark.read.parquet(folder)) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="other"):
        S.append_by_name(spark.createDataFrame([(4, 1)], "id int, other int"), folder)
    with pytest.raises(ValueError):
        S.append_positional(spark.createDataFrame([(4,)], "id int"), folder)
    S.replace_table(spark.createDataFrame([(9,)], "z int"), folder)
    assert rows(spark.read.parquet(folder)) == [(9,)]


def test_replace_period_leaves_other_months(spark, folder):
    first = observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0), (FEB, 2.0, 3.0))
    S.replace_table(S.with_period(first, "time"), folder, S.PERIOD)
    S.replace_period(observations(spark, (FEB, 1.0, 20.0), (datetime(2024, 3, 1), 1.0, 30.0)), folder, "time")
    assert rows(spark.read.parquet(folder).select("month", "v")) == [(1, 1.0), (2, 20.0), (3, 30.0)]


def test_replace_period_refuses_what_would_lose_rows(spark, folder):
    S.replace_table(S.with_period(observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0)), "time"), folder, S.PERIOD)
    before = rows(spark.read.parquet(folder).select("month", "v"))
    with pytest.raises(Exception, match="before the newest"):
        S.replace_period(observations(spark, (datetime(2024, 1, 7), 1.0, 9.0), (FEB, 1.0, 8.0)), folder, "time")
    with pytest.raises(Exception, match="rows without time"):
        S.replace_period(observations(spark, (FEB, 1.0, 8.0), (None, 1.0, 9.0)), folder, "time")
    assert rows(spark.read.parquet(folder).select("month", "v")) == before
    S.replace_period(observations(spark, (JAN, 1.0, 9.0)), folder, "time", older=True)
    assert rows(spark.read.parquet(folder).select("month", "v")) == [(1, 9.0), (2, 2.0)]


def test_newest_stored_month_is_found_by_name(spark, folder):
    assert S.newest_stored(spark, folder) is None
    S.replace_table(S.with_period(observations(spark, (JAN, 1.0, 1.0), (datetime(2023, 12, 5), 1.0, 2.0)), "time"), folder, S.PERIOD)
    assert S.newest_stored(spark, folder) == (2024, 1)


def test_month_table(spark, folder):
    table = MonthTable(spark, folder, "time")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0)), "a")
    assert table.replace(observations(spark, (FEB, 1.0, 5.0), (FEB, 2.0, 6.0)), "b")
    assert not table.replace(observations(spark, (FEB, 1.0, 99.0)), "b")  # a retry
    assert rows(table.read().select("year", "month", "v")) == [(2024, 1, 1.0), (2024, 2, 5.0), (2024, 2, 6.0)]
    with pytest.raises(Exception, match="before the newest"):
        table.replace(observations(spark, (JAN, 1.0, 0.0)), "c")
    with pytest.raises(Exception, match="rows without time"):
        table.replace(observations(spark, (None, 1.0, 0.0)), "c")
    assert table.replace(observations(spark, (JAN, 1.0, 0.0)), "c", older=True)
    assert table.replace(spark.createDataFrame([(datetime(2024, 3, 1), 3.0)], "time timestamp_ntz, V double"), "d")
    assert rows(table.read().select("month", "lat", "v")) == [(1, 1.0, 0.0), (2, 1.0, 5.0), (2, 2.0, 6.0), (3, None, 3.0)]
    pruned = table.read().where("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in pruned


def test_month_table_shows_no_half_of_a_delivery(spark, folder, monkeypatch):
    """A delivery that breaks off while or after it writes changes nothing; its retry does."""
    table = MonthTable(spark, folder, "time")
    table.replace(observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0)), "a")
    before = rows(table.read())
    late = observations(spark, (FEB, 1.0, 8.0), (datetime(2024, 3, 5), 1.0, 9.0))
    breaks = late.withColumn("v", F.when(F.month("time") == 3, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.replace(breaks, "b")
    assert rows(table.read()) == before
    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "create", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            table.replace(late, "b")
    assert rows(table.read()) == before
    assert table.replace(late, "b")
    assert rows(table.read().select("month", "v")) == [(1, 1.0), (2, 8.0), (3, 9.0)]


def test_month_table_with_two_writers(spark, folder, monkeypatch):
    """The writer that comes second sees what the first one stored, and keeps it."""
    table, other = MonthTable(spark, folder, "time"), MonthTable(spark, folder, "time")
    table.replace(observations(spark, (JAN, 1.0, 1.0)), "a")
    create = Manifest.create
    raced = []

    def first_the_other(self, *version):
        if not raced:
            raced.append(True)
            other.replace(observations(spark, (FEB, 1.0, 2.0)), "other")
        return create(self, *version)

    monkeypatch.setattr(Manifest, "create", first_the_other)
    assert table.replace(observations(spark, (datetime(2024, 3, 5), 1.0, 3.0)), "b")
    assert rows(table.read().select("month", "v")) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert table.manifest()["deliveries"] == ["a", "other", "b"]


def test_all_tables_are_tried(spark, folder):
    good, bad = observations(spark, (JAN, 1.0, 1.0)), observations(spark, (None, 1.0, 1.0))
    loads = {f"{folder}/a": lambda: good, f"{folder}/b": lambda: 1 / 0, f"{folder}/c": lambda: good}
    with pytest.raises(ExceptionGroup, match="1 of 3 tables failed: .*/b"):
        ingest.load_all(loads)
    assert set(ingest.load_all({f"{folder}/a": lambda: bad, f"{folder}/c": lambda: good}, raise_at_end=False)) == {f"{folder}/a"}
    assert rows(spark.read.parquet(f"{folder}/c").select("v")) == [(1.0,)]


def test_replace_newest_month(spark):
    old = observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0), (None, 1.0, 7.0))
    new = spark.createDataFrame([(20.0, FEB)], "v double, time timestamp_ntz")
    out = S.replace_newest_month(old, new, "time")
    assert rows(out.select("v", "lat")) == [(1.0, 1.0), (20.0, None), (7.0, 1.0)]


def test_loads(spark, folder):
    path = f"{folder}/daily"
    assert ingest.newest(spark, path, "time").first()["latest"] is None
    ingest.load_daily(observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0)), path)
    latest = ingest.newest(spark, path, "time")
    assert latest.first()["latest"] == FEB
    text = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "Subquery" in text
    ingest.load_daily(observations(spark, (FEB, 1.0, 5.0), (FEB, 2.0, 6.0)), path)
    assert rows(spark.read.parquet(path).select("lat", "v")) == [(1.0, 1.0), (1.0, 5.0), (2.0, 6.0)]
    path = f"{folder}/monthly"
    ingest.load_monthly(observations(spark, (JAN, 1.0, 1.0)), path, "time")
    ingest.load_monthly(observations(spark, (FEB, 1.0, 2.0)), path, "time")
    assert rows(spark.read.parquet(path).select("month", "v")) == [(1, 1.0), (2, 2.0)]


def test_period_filter_prunes_partitions(spark, folder):
    S.replace_table(S.with_period(observations(spark, (JAN, 1.0, 1.0), (FEB, 1.0, 2.0)), "time"), folder, S.PERIOD)
    scan = spark.read.parquet(folder).where("year = 2024 and month = 2")
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and scan.count() == 1


def test_stored_partitions_are_rebalanced(spark, folder):
    df = S._layout(S.with_period(observations(spark, (JAN, 1.0, 1.0)), "time"), S.PERIOD)
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString()


def test_publish_evaluates_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def noted(x):
        seen.add(1)
        return x

    assert S.publish(spark.range(50).select(noted(F.col("id").cast("int")).alias("n")), folder) == 50
    assert seen.value == 50


def test_publish(spark, folder):
    df = spark.createDataFrame([("k", 1, "x"), ("l", 2, "y")], "KEY_ID string, n int, s string")
    S.publish(df, folder)
    assert rows(spark.read.csv(folder, header=True)) == [("1", "x"), ("2", "y")]
    assert S.publish_guard(df, max_rows=3).columns == ["n", "s"]
    with pytest.raises(RuntimeError, match="2 rows"):
        S.publish_guard(df, max_rows=2)
    assert rows(spark.read.csv(folder, header=True)) == [("1", "x"), ("2", "y")]
    with pytest.raises(RuntimeError, match="2 rows and a header exceed the limit of 2"):
        S.publish(df.withColumn("n", F.lit(9)).repartition(2, "s").coalesce(2), folder, max_rows=2)
    with pytest.raises(Exception, match="at least 3 rows"):
        S.publish(spark.range(0, 100, 1, 1), folder, max_rows=3)
    assert rows(spark.read.csv(folder, header=True)) == [("1", "x"), ("2", "y")]
    assert sorted(p.name for p in Path(folder).parent.iterdir()) == [Path(folder).name]
    assert S.publish(df.limit(0), folder + "-empty") == 0
    sizes = S.published_sizes(spark, [folder])
    assert sizes.first()["file_size_bytes"] > 8 and sizes.columns == ["path", "file_size_bytes"]


def test_scans(spark, folder):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, s string").write.csv(folder, header=True)
    assert rows(tables.scan_csv(spark, folder, "id bigint, s string")) == [(1, "a"), (2, None)]
    with pytest.raises(Exception):
        tables.scan_csv(spark, folder, "id bigint, s int").collect()
    swapped = f"{folder}-swapped"
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.csv(swapped, header=True)
    spark.createDataFrame([(20, 10)], "b int, a int").coalesce(1).write.mode("append").csv(swapped, header=True)
    with pytest.raises(Exception, match="header does not conform"):
        tables.scan_csv(spark, swapped, "a int, b int").collect()
    Path(folder + "-mark.csv").write_bytes("\ufeffid,s\n1,é\n".encode())
    assert rows(tables.scan_csv(spark, folder + "-mark.csv", "S string, ID int")) == [("é", 1)]
    with pytest.raises(ValueError, match="missing"):
        tables.scan_csv(spark, folder, "id int, other int")
    spark.range(3).createOrReplaceTempView("bronze_numbers")
    assert tables.scan_table(spark, "bronze_numbers", ["id"]).count() == 3


def test_catalog(spark):
    fact = spark.createDataFrame([(1, "k", 2.0, date(2024, 1, 1), True)], "`Années` int, key_id string, TP double, day date, ok boolean")
    described = catalog.described_columns(fact, "d", catalog.column_info(spark))
    assert rows(described.select("ordinal", "name", "description", "unit", "type")) == [
        (0, "Années", "Année de la mesure", "", "number"),
        (1, "TP", "Précipitations totales", "m", "number"),
        (2, "day", "day", "", "date"),
        (3, "ok", "ok", "", "boolean"),
    ]
    datasets = spark.createDataFrame(
        [("d", "Name", "About", "src", "climate", ["a", "b"], "f/d.csv"), ("e", "Other", "", "", "unknown", ["a"], "f/e.csv")],
        "dataset string, name string, description string, source string, theme_slug string, tags array<string>, file_path string",
    )
    themes = spark.createDataFrame([("climate", 7)], "slug string, id int")
    sizes = spark.createDataFrame([("d", 100), ("e", 1)], "dataset string, file_size_bytes bigint")
    rows_ = catalog.catalog_rows(datasets, described, themes, sizes)
    entry = rows_.collect()
    assert len(entry) == 1 and entry[0].theme_id == 7 and entry[0].status == "validated"
    assert [c.name for c in entry[0].columns] == ["Années", "TP", "day", "ok"]
    edited = rows_.withColumn("name", F.lit("Edited")).withColumn("file_size_bytes", F.lit(5).cast("long"))
    extra = rows_.withColumn("file_path", F.lit("f/new.csv"))
    merged = catalog.catalog_upsert(edited, rows_.unionAll(extra)).select("file_path", "name", "file_size_bytes")
    assert rows(merged) == [("f/d.csv", "Edited", 100), ("f/new.csv", "Name", 100)]
    untouched = catalog.catalog_upsert(edited, rows_.where("false"))
    assert untouched.first()["file_size_bytes"] == 5


def test_catalog_keys(spark):
    """Repeated and NULL keys; paths of an existing catalogue."""
    shape = "file_path string, name string, file_size_bytes bigint"
    old = spark.createDataFrame([("a", "edited", 1), (None, "by hand", 2)], shape)
    new = spark.createDataFrame([("a", "x", 7), ("a", "x", 7), ("b", "y", 8), ("b", "y", 9), (None, "z", 3)], shape)
    found = sorted(rows(catalog.catalog_upsert(old, new)), key=str)
    assert found == sorted([("a", "edited", 7), (None, "by hand", 2), ("b", "y", 8), (None, "z", 3)], key=str)
    paths = [r.file_path for r in catalog.dataset_rows(spark, prefix="r2:", extension="xlsx").collect()]
    assert paths and all(p.startswith("r2:") and p.endswith(".xlsx") for p in paths)


def test_shared_folder(spark):
    base = shared_dir(spark)
    assert scratch_path(spark, "x").startswith(base) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert shared_dir(spark) == base
    stored = cut_lineage(spark.range(10))
    assert stored.count() == 10 and is_small(stored, 10) and not is_small(stored, 9)


def test_request_plans_follow_the_stored_tables(spark, folder):
    today = date(2024, 3, 20)
    assert requests.monthly_plan(spark, f"{folder}/monthly", today).first()["years"] == [str(y) for y in range(1940, 1950)]
    ingest.load_monthly(observations(spark, (datetime(2023, 11, 1), 1.0, 1.0)).withColumnRenamed("time", "valid_time"), f"{folder}/monthly")
    plan = requests.monthly_plan(spark, f"{folder}/monthly", today).collect()
    assert [(r.batch, r.years, r.months) for r in plan] == [(1, ["2023"], ["12"]), (2, ["2024"], ["01"])]
    ingest.load_daily(observations(spark, (FEB, 1.0, 1.0)), f"{folder}/wind")
    paths = {"Ag_wind_10m": f"{folder}/wind", "Ag_humidity_2m": f"{folder}/humidity"}
    plan = requests.daily_plan(spark, paths, today).collect()
    wind = [(r.target, r.statistic, r.year, r.month) for r in plan if r.variable == "10m_wind_speed"]
    assert wind == [("Ag_wind_10m", ["24_hour_mean"], "2024", "02"), ("Ag_wind_10m", ["24_hour_mean"], "2024", "03")]
    humidity = [(r.year, r.month) for r in plan if r.variable == "2m_relative_humidity"]
    assert humidity[0] == ("2021", "01") and len(humidity) == 39 and len(plan) == 41
