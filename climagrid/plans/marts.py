"""Fact and dimension marts.

Joins between observations run on (latitude, longitude, day) rather than on the
md5 key made of the same three values: the key is a longer text that every side
would have to hash and ship, and Spark then builds it only for published rows.
Rows with a NULL coordinate or day never reach a mart, because they find neither
a region nor a date. Region and date dimensions are joined first, and every other
side is cut down to the bounds and cells of the region map, so rows outside the
regions are gone before the wide joins shuffle. Both dimensions are broadcast only after
their rows have been counted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.operators.spatial import DAILY_HALF_CELL, MONTHLY_HALF_CELL, cell_envelope, cell_region_map
from climagrid.plans import staging
from climagrid.session import BROADCAST_MAX_ROWS, broadcast_if_small, cut_lineage


def region_map(points: DataFrame, edges: DataFrame, half: float, latitude: str, longitude: str) -> DataFrame:
    """The cell-to-region map, worked out once and stored.

    Observations hold far more rows than cells; every mart join then reads the
    stored result, whose size can be counted.
    """
    return cut_lineage(cell_region_map(cell_envelope(points, half, latitude, longitude), edges))


def monthly_region_map(water: DataFrame, edges: DataFrame) -> DataFrame:
    member = staging.filter_member(water)
    return region_map(member, edges, MONTHLY_HALF_CELL, "latitude", "longitude")


def daily_region_map(temperature: DataFrame, edges: DataFrame) -> DataFrame:
    return region_map(temperature, edges, DAILY_HALF_CELL, "lat", "lon")


def _with_dimensions(
    observations: DataFrame, coordinates: list[str], dates: DataFrame, cells: MappedCells
) -> DataFrame:
    """Observations inside the regions and the calendar, with the columns of both."""
    near = _inside(observations, coordinates, replace(cells, small=False))
    days = broadcast_if_small(dates).select(
        F.col("datetime").cast("date").alias("obs_day"), "datetime_id", "datetime", "year", "month_year"
    )
    return near.join(cells.frame, coordinates).join(days, "obs_day")


@dataclass(frozen=True)
class MappedCells:
    """The region map under the observations' names, with its counted size and bounds."""

    frame: DataFrame
    small: bool
    bounds: tuple[float | None, ...]


def _cells(regions: DataFrame, latitude: str, longitude: str) -> MappedCells:
    """Read the stored map once for its size and its bounds."""
    cells = regions.select(
        F.col("latitude").alias(latitude),
        F.col("longitude").alias(longitude),
        F.col("region").alias("Region"),
    )
    extent = [f(c) for c in ("latitude", "longitude") for f in (F.min, F.max)]
    n, *bounds = regions.agg(F.count(F.lit(1)), *extent).first()
    small = n <= BROADCAST_MAX_ROWS
    return MappedCells(F.broadcast(cells) if small else cells, small, tuple(bounds))


def _inside(observations: DataFrame, coordinates: list[str], cells: MappedCells) -> DataFrame:
    """Observations that can have a region.

    The bounds of the map reach the scan, where they skip row groups. A map small
    enough to broadcast also drops the cells between its members; a larger one
    would cost a shuffle for that.
    """
    (latitude, longitude), (south, north, west, east) = coordinates, cells.bounds
    if south is None:
        return observations.where("false")
    near = observations.where(
        F.col(latitude).between(south, north) & F.col(longitude).between(west, east)
    )
    return near.join(cells.frame, coordinates, "left_semi") if cells.small else near


def int_general(water: DataFrame, temp: DataFrame, dates: DataFrame, regions: DataFrame) -> DataFrame:
    """Monthly water and temperature observations with date and region, 20 columns.

    A full join followed by inner joins on the water side's columns keeps exactly
    the water rows that have a date and a region. Those two joins therefore run
    first, and temperature is attached by a left join to what remains.
    """
    coordinates = ["latitude", "longitude"]
    cells = _cells(regions, *coordinates)
    base = _with_dimensions(staging.stg_general_water(water, native=True), coordinates, dates, cells)
    second = _inside(staging.stg_general_temp(temp, native=True), coordinates, cells)
    joined = base.join(
        second.select(
            *coordinates,
            "obs_day",
            "temperature",
            "temperature_point_rosee",
            "vitesse_vent",
            "temperature_sol_couche1",
            "humidite_volumique_sol1",
        ),
        [*coordinates, "obs_day"],
        "left",
    )
    return staging.with_keys(joined, coordinates).select(
        "key_id",
        "datetime_id",
        "datetime",
        "year",
        "month_year",
        "latitude",
        "longitude",
        "Region",
        "total_precipitation",
        "rayonnement_solaire_surface",
        "evaporation_reelle",
        "evaporation_potentielle",
        "ruissellement",
        "versionERA5",
        "coord_id",
        "temperature",
        "temperature_point_rosee",
        "vitesse_vent",
        "temperature_sol_couche1",
        "humidite_volumique_sol1",
    )


def fact_general(general: DataFrame) -> DataFrame:
    """The published monthly fact; the region is not published but has filtered the rows."""
    return general.select(
        "key_id",
        F.col("month_year").alias("Mois_Années"),
        "latitude",
        "longitude",
        "total_precipitation",
        "rayonnement_solaire_surface",
        "evaporation_reelle",
        "evaporation_potentielle",
        "ruissellement",
        "versionERA5",
        "temperature",
        "temperature_point_rosee",
        "vitesse_vent",
        "temperature_sol_couche1",
        "humidite_volumique_sol1",
    )


def dim_waves(waves: DataFrame) -> DataFrame:
    """Distinct wave observations; distinct runs on raw values, the key is added after."""
    rows = (
        staging.filter_member(waves)
        .where("mwd is not null and mwp is not null")
        .withColumn("valid_time", F.col("valid_time").cast("date"))
        .select("valid_time", "latitude", "longitude", "mwd", "mwp", "expver", "number")
        .distinct()
    )
    return staging.stg_general_waves(rows).select(
        "key_id",
        F.col("datetime_id").alias("Date"),
        "latitude",
        "longitude",
        "direction_moyenne_vagues",
        "periode_moyenne_vagues",
        "versionERA5",
    )


# Name of each daily bronze frame, how it is staged, and its measures.
DAILY_PRODUCTS = {
    "temperature": (staging.stg_ag_temperature, ["Temp_Max_24h", "Temp_Mean_24h", "Temp_Min_24h"]),
    "wind": (staging.stg_ag_wind, ["Wind_Speed_10m_Mean_24h"]),
    "et": (staging.stg_ag_et, ["Reference_Evapotranspiration"]),
    "precip": (staging.stg_ag_precip, ["Precipitation_Flux"]),
    "humidity": (staging.stg_ag_humidity, ["Relative_Humidity_12h"]),
}


def int_agriculture(bronze: Mapping[str, DataFrame], dates: DataFrame, regions: DataFrame) -> DataFrame:
    """Daily observations present in all five products, with date and region, 16 columns."""
    coordinates = ["lat", "lon"]
    cells = _cells(regions, *coordinates)
    joined = None
    for name, (stage, measures) in DAILY_PRODUCTS.items():
        staged = stage(bronze[name], native=True)
        if joined is None:
            joined = _with_dimensions(staged, coordinates, dates, cells)
        else:
            inside = _inside(staged, coordinates, cells)
            joined = joined.join(inside, [*coordinates, "obs_day"])
    return staging.with_keys(joined, coordinates).select(
        "key_id",
        "coord_id",
        "datetime_id",
        "datetime",
        "year",
        "month_year",
        "Region",
        "lat",
        "lon",
        *[m for _, measures in DAILY_PRODUCTS.values() for m in measures],
    )


def fact_agriculture(agriculture: DataFrame) -> DataFrame:
    """The published daily fact under its published names."""
    return agriculture.select(
        F.col("datetime").alias("Date"),
        F.col("year").alias("Années"),
        F.col("month_year").alias("Mois_Années"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "Temp_Max_24h",
        F.col("Temp_Mean_24h").alias("Temp_Moyenne_24h"),
        "Temp_Min_24h",
        F.col("Wind_Speed_10m_Mean_24h").alias("Vitesse_vent_10m_Moyenne"),
        "Reference_Evapotranspiration",
        "Precipitation_Flux",
        F.col("Relative_Humidity_12h").alias("Humidité_Relative"),
    )
