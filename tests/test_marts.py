from datetime import date, datetime

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from climagrid.operators.calendar import dim_datetime
from climagrid.plans import catalog, gold, marts, staging
from climagrid.session import cut_lineage
from climagrid.sinks.tables import save_by_day

from conftest import rows

EDGE = "region string, poly int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"


def box(name, x0, y0, x1, y1):
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return [(name, 0, 0, i, *corners[i], *corners[i + 1]) for i in range(4)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(box("West", 42.0, 11.0, 42.5, 12.0) + box("East", 42.5, 11.0, 43.0, 12.0), EDGE)


DAY = datetime(2024, 1, 5, 12)
INSIDE, OUTSIDE = (11.5, 42.2), (20.0, 42.2)


@pytest.fixture(scope="module")
def bronze(spark):
    points = [(DAY, *INSIDE), (datetime(2024, 1, 6), *INSIDE), (DAY, *OUTSIDE), (datetime(2030, 1, 1), *INSIDE), (None, *INSIDE), (DAY, None, 42.2)]

    def frame(names, values, kept):
        columns = "time timestamp_ntz, lat double, lon double, " + ", ".join(f"{n} float" for n in names)
        return spark.createDataFrame([(*p, *values) for p in kept], columns)

    return {
        "temperature": frame([f"Temperature_Air_2m_{s}_24h" for s in ("Max", "Mean", "Min")], [300.155, 299.0, 290.5], points),
        "wind": frame(["Wind_Speed_10m_Mean_24h"], [3.456], points),
        "humidity": frame(["Relative_Humidity_2m_12h"], [45.678], points),
        "precip": frame(["Precipitation_Flux"], [0.125], points[:1] + points[2:]),
        "et": frame(["ReferenceET_PenmanMonteith_FAO56"], [4.0], points),
    }


def test_daily_fact(spark, bronze, edges):
    out = gold.agriculture_marts(bronze, edges, date(2024, 3, 1))["agriculture"]
    assert out.columns == [
        "Date", "Années", "Mois_Années", "latitude", "longitude", "Temp_Max_24h", "Temp_Moyenne_24h", "Temp_Min_24h",
        "Vitesse_vent_10m_Moyenne", "Reference_Evapotranspiration", "Precipitation_Flux", "Humidité_Relative",
    ]
    # One row: no rain on the 6th, 20 degrees north is outside, 2030 is after today, NULLs match nothing.
    single = [float(np.float32(v)) for v in (27.01, 25.85, 17.35, 3.46, 4.0, 0.13, 0.46)]
    assert rows(out) == [(date(2024, 1, 5), 2024, "01/2024", 11.5, 42.2, *single)]


CONVERSIONS = {
    "stg_general_water": {"tp": "tp * 1000", "ssrd": "ssrd / 86400", "e": "e * -1000", "pev": "pev * -1000", "ro": "ro * 1000"},
    "stg_general_temp": {
        "t2m": "t2m - 273.15", "d2m": "d2m - 273.15", "si10": "si10", "stl1": "stl1 - 273.15", "swvl1": "swvl1",
        "sst": "sst - 273.15", "sp": "sp / 100", "msl": "msl / 100",
    },
    "stg_ag_temperature": {f"Temperature_Air_2m_{s}_24h": f"ROUND(Temperature_Air_2m_{s}_24h - 273.15, 2)" for s in ("Max", "Mean", "Min")},
    "stg_ag_humidity": {"Relative_Humidity_2m_12h": "ROUND(Relative_Humidity_2m_12h / 100, 2)"},
    "stg_ag_precip": {"Precipitation_Flux": "ROUND(Precipitation_Flux, 2)"},
}


@pytest.mark.parametrize("name", CONVERSIONS)
@pytest.mark.parametrize("kind", ["float", "double"])
def test_conversions_are_exact_in_the_measures_own_type(spark, name, kind):
    """Same bits as SQL on FLOAT and DOUBLE columns, over values near rounding ties."""
    rng = np.random.default_rng(1)
    columns = list(CONVERSIONS[name])
    values = np.round(rng.uniform(250, 320, (4000, len(columns))), 3).tolist()
    fixed = "id int, time timestamp_ntz, lat double, lon double, number int, expver string"
    if name.startswith("stg_general"):
        fixed = fixed.replace("time ", "valid_time ").replace("lat ", "latitude ").replace("lon ", "longitude ")
    df = spark.createDataFrame(
        [(i, DAY, float(i), 1.0, 0, "1", *v) for i, v in enumerate(values)], f"{fixed}, " + ", ".join(f"{c} {kind}" for c in columns)
    )
    staged = getattr(staging, name)(df)
    latitude = "latitude" if "latitude" in staged.columns else "lat"
    measures = [c for c in staged.columns if c not in ("key_id", "coord_id", "datetime_id", "lat", "lon", "latitude", "longitude", "valid_time", "versionERA5")]
    con = duckdb.connect()
    con.execute("CREATE TABLE m (id INT, " + ", ".join(f"{c} {kind}" for c in columns) + ")")
    con.executemany(f"INSERT INTO m VALUES (?, {', '.join('?' * len(columns))})", [(i, *v) for i, v in enumerate(values)])
    expected = con.execute(f"SELECT {', '.join(CONVERSIONS[name].values())} FROM m ORDER BY id").fetchall()
    assert [tuple(r) for r in staged.orderBy(latitude).select(*measures).collect()] == expected


def test_daily_keys(spark, bronze, edges):
    regions = marts.daily_region_map(bronze["temperature"], edges)
    out = marts.int_agriculture(bronze, dim_datetime(spark, date(2024, 3, 1)), regions).first()
    md5 = lambda text: spark.range(1).select(F.md5(F.lit(text))).first()[0]
    assert (out.key_id, out.coord_id, out.Region) == (md5("11.5-42.2-05/01/2024"), md5("11.5-42.2"), "West")
    staged = staging.stg_ag_wind(bronze["wind"]).where("lat = 11.5 and datetime_id = '05/01/2024'").first()
    assert (staged.key_id, staged.coord_id) == (out.key_id, out.coord_id)


def test_same_rows_as_joining_on_the_text_key(spark, bronze, edges):
    regions = marts.daily_region_map(bronze["temperature"], edges)
    dates = dim_datetime(spark, date(2024, 3, 1))
    t = {n: stage(bronze[n]) for n, (stage, _) in marts.DAILY_PRODUCTS.items()}
    joined = t["temperature"]
    for name in ("wind", "et", "precip", "humidity"):
        joined = joined.join(t[name].drop("coord_id", "datetime_id", "lat", "lon"), "key_id")
    joined = joined.join(dates, "datetime_id").join(regions.select("coord_id"), "coord_id")
    assert rows(joined.select("key_id")) == rows(marts.int_agriculture(bronze, dates, regions).select("key_id"))


def test_plan_ships_no_text_keys_and_joins_each_side_once(spark, bronze, edges):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gold.agriculture_marts(bronze, edges, date(2024, 3, 1))["agriculture"]
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "md5" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("SortMergeJoin") == 4 and text.count("Exchange hashpartitioning") == 5
    assert text.count("BroadcastExchange") >= 2


def test_large_region_map_is_not_broadcast(spark, bronze, edges, monkeypatch):
    dates = dim_datetime(spark, date(2024, 3, 1))
    regions = marts.daily_region_map(bronze["temperature"], edges)
    small = marts.int_agriculture(bronze, dates, regions)
    monkeypatch.setattr(marts, "BROADCAST_MAX_ROWS", 0)
    large = marts.int_agriculture(bronze, dates, regions)
    assert rows(large) == rows(small)
    assert "LeftSemi" in small._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" not in large._jdf.queryExecution().executedPlan().toString()


def test_map_bounds_reach_the_scan(spark, bronze, edges, folder):
    regions = marts.daily_region_map(bronze["temperature"], edges)
    stored = {}
    for name, df in bronze.items():
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    out = marts.int_agriculture(stored, dim_datetime(spark, date(2024, 3, 1)), regions)
    scans = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert len(scans) == 5 and all("GreaterThanOrEqual(lat,11.5)" in s for s in scans)
    nowhere = marts.int_agriculture(stored, dim_datetime(spark, date(2024, 3, 1)), regions.where("false"))
    assert nowhere.count() == 0


@pytest.mark.parametrize("partition_by", [(), ("year", "month")])
def test_inputs_bucketed_by_day_join_without_a_shuffle(spark, bronze, edges, folder, partition_by):
    dates = dim_datetime(spark, date(2024, 3, 1))
    regions = marts.daily_region_map(bronze["temperature"], edges)
    expected = rows(marts.int_agriculture(bronze, dates, regions))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        stored = {}
        for name, df in bronze.items():
            save_by_day(df, f"bucketed_{name}", f"{folder}/{name}", "time", 4, partition_by)
            stored[name] = spark.table(f"bucketed_{name}")
        out = marts.int_agriculture(stored, dates, regions)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text and text.count("SortMergeJoin") == 4
        assert rows(out) == expected
    finally:
        for key in settings:
            spark.conf.unset(key)
        for name in bronze:
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


@pytest.fixture(scope="module")
def monthly(spark):
    base = "valid_time timestamp_ntz, latitude double, longitude double, number int, expver string, "
    jan, feb = datetime(2024, 1, 1), datetime(2024, 2, 1)
    keys = [(jan, 11.5, 42.25, 0, "0001"), (feb, 11.5, 42.25, 0, "0001"), (jan, 11.5, 42.25, 1, "0001"), (jan, 20.0, 42.25, 0, "0001")]
    water = spark.createDataFrame([(*k, 0.001, 86400.0, -0.002, -0.003, 0.004) for k in keys], base + "tp float, ssrd float, e float, pev float, ro float")
    temp = spark.createDataFrame(
        [(*k, 300.0, 290.0, 2.0, 301.0, 0.2, None, 101000.0, 101300.0) for k in keys[:1] + [(jan, 99.0, 0.0, 0, "0001")]],
        base + "t2m float, d2m float, si10 float, stl1 float, swvl1 float, sst float, sp float, msl float",
    )
    waves = spark.createDataFrame(
        [(*keys[0], 90.0, 5.0), (*keys[0], 90.0, 5.0), (*keys[1], None, 5.0), (*keys[2], 1.0, 1.0)], base + "mwd float, mwp float"
    )
    return water, temp, waves


def test_monthly_marts(spark, monthly, edges):
    out = gold.general_marts(*monthly, edges, date(2024, 3, 1))
    fact = {r["Mois_Années"]: r for r in out["general"].collect()}
    assert set(fact) == {"01/2024", "02/2024"}
    january, february = fact["01/2024"], fact["02/2024"]
    assert round(january.total_precipitation, 6) == 1.0 and january.rayonnement_solaire_surface == 1.0
    assert round(january.evaporation_reelle, 6) == 2.0 and round(january.evaporation_potentielle, 6) == 3.0
    assert round(january.temperature, 4) == 26.85 and february.temperature is None
    assert len(out["general"].columns) == 15
    waves = out["waves"].collect()
    assert len(waves) == 1 and waves[0].Date == "01/01/2024" and waves[0].key_id == january.key_id


def test_member_filter_reaches_the_scan(spark, monthly, folder):
    monthly[0].write.parquet(folder)
    text = staging.stg_general_water(spark.read.parquet(folder)).select("total_precipitation")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(number,0)" in text and "ReadSchema: struct<number:int,tp:float>" in text


def test_export_and_publish(spark, bronze, monthly, edges, folder):
    outputs = {**gold.general_marts(*monthly, edges, date(2024, 3, 1)), **gold.agriculture_marts(bronze, edges, date(2024, 3, 1))}
    exported = gold.export_marts(outputs, f"{folder}/gold")
    assert rows(spark.read.parquet(exported["general"])) == rows(outputs["general"])
    published = gold.publish_marts(spark, exported, f"{folder}/portal")
    assert "key_id" not in spark.read.csv(published["general"], header=True).columns
    assert spark.read.csv(published["agriculture"], header=True).count() == 1
    themes = spark.createDataFrame([("meteorologie_climat", 3)], "slug string, id int")
    empty = spark.createDataFrame([], CATALOG)
    first = catalog.refresh_catalog(empty, exported, published, themes, "general")
    assert rows(first.select("file_path", "theme_id", "file_type")) == [
        ("Copernicus/General/GeneralEra5.csv", 3, "csv"), ("Copernicus/General/vagues.csv", 3, "csv"),
    ]
    stored = cut_lineage(first.withColumn("name", F.lit("Edited")).withColumn("file_size_bytes", F.lit(0).cast("long")))
    after = catalog.refresh_catalog(stored, exported, published, themes)
    assert rows(after.select("name", F.col("file_size_bytes") > 0)) == [
        ("ERA5 - Indicateurs agrométéorologiques journaliers - Djibouti", True), ("Edited", True), ("Edited", True),
    ]
    waves = after.where("file_path like '%vagues%'").first()
    assert [(c.name, c.type) for c in waves.columns][:2] == [("Date", "string"), ("latitude", "number")]
    with pytest.raises(ValueError):
        catalog.dataset_rows(spark, "nope")


CATALOG = (
    "name string, description string, source string, theme_id int, file_path string, file_type string, file_size_bytes bigint, "
    "columns array<struct<name: string, description: string, unit: string, type: string>>, tags array<string>, "
    "status string, created_by string"
)
