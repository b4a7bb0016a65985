"""What to download next: the monthly batches and the daily per-variable months."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.operators.incremental import (
    missing_months_after,
    missing_months_from,
    plan_batches,
    plan_month_requests,
)
from climagrid.plans.ingest import newest

# The area north, west, south, east that both products are cut to.
AREA = [12.7, 41.7, 10.9, 43.5]

# The monthly variables, all in every batch.
MONTHLY_VARIABLES = [
    "2m_dewpoint_temperature",
    "2m_temperature",
    "total_precipitation",
    "10m_wind_speed",
    "surface_solar_radiation_downwards",
    "evaporation",
    "potential_evaporation",
    "runoff",
    "soil_temperature_level_1",
    "volumetric_soil_water_layer_1",
    "mean_sea_level_pressure",
    "surface_pressure",
    "sea_surface_temperature",
    "mean_wave_direction",
    "mean_wave_period",
]

# Daily variables, their statistics and hours, and the bronze table of each.
DAILY_VARIABLES = [
    ("2m_temperature", ["24_hour_maximum", "24_hour_mean", "24_hour_minimum"], None, "Ag_temperature_2m"),
    ("10m_wind_speed", ["24_hour_mean"], None, "Ag_wind_10m"),
    ("2m_relative_humidity", None, ["12_00"], "Ag_humidity_2m"),
    ("precipitation_flux", None, None, "Ag_precip_flux"),
    ("reference_evapotranspiration", None, None, "Ag_reference_et"),
]


def daily_specs(spark: SparkSession) -> DataFrame:
    """The request options of every daily variable."""
    schema = "variable string, statistic array<string>, time array<string>, target string"
    return spark.createDataFrame(DAILY_VARIABLES, schema)


def monthly_plan(spark: SparkSession, path: str, today: date) -> DataFrame:
    """Batches (batch, years, months) that bring the monthly table at ``path`` up to date."""
    return plan_batches(missing_months_after(newest(spark, path, "valid_time"), today)).orderBy("batch")


def daily_plan(spark: SparkSession, paths: Mapping[str, str], today: date) -> DataFrame:
    """One request per variable and missing month; ``paths`` maps bronze tables to folders.

    A variable whose table does not exist yet starts at the first month.
    """
    specs = daily_specs(spark).where(F.col("target").isin(list(paths)))
    targets = {target: variable for variable, _, _, target in DAILY_VARIABLES}
    marks = [newest(spark, path, "time").withColumn("variable", F.lit(targets[t])) for t, path in paths.items()]
    return plan_month_requests(missing_months_from(reduce(DataFrame.unionByName, marks), today), specs)
