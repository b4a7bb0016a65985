"""Bronze tables to stored, exported and published marts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.operators.calendar import MONTH_TEXT, dim_datetime
from climagrid.operators.ordering import storage_order
from climagrid.plans import marts
from climagrid.sinks.tables import export_parquet, publish
from climagrid.sources.regions import region_names, regions_from_geojson


def region_edges(spark: SparkSession, geojson: str, line_delimited: bool = False) -> DataFrame:
    """Edges of the administrative regions under their published names."""
    return region_names(regions_from_geojson(spark, geojson, line_delimited=line_delimited))


def general_marts(
    water: DataFrame, temp: DataFrame, waves: DataFrame, edges: DataFrame, today: date
) -> dict[str, DataFrame]:
    """The monthly fact and the wave dimension."""
    dates = dim_datetime(water.sparkSession, today)
    regions = marts.monthly_region_map(water, edges)
    general = marts.int_general(water, temp, dates, regions)
    return {"general": marts.fact_general(general), "waves": marts.dim_waves(waves)}


def agriculture_marts(bronze: Mapping[str, DataFrame], edges: DataFrame, today: date) -> dict[str, DataFrame]:
    """The daily fact."""
    dates = dim_datetime(edges.sparkSession, today)
    regions = marts.daily_region_map(bronze["temperature"], edges)
    agriculture = marts.int_agriculture(bronze, dates, regions)
    return {"agriculture": marts.fact_agriculture(agriculture)}


def mart_order(name: str) -> Column:
    """What a mart is stored in order of; coordinates then spread days that hold many rows."""
    return F.to_date("Mois_Années", MONTH_TEXT) if name == "general" else F.col("Date")



def export_marts(outputs: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every mart as sorted Parquet below ``folder`` and return the paths."""
    paths = {}
    for name, mart in outputs.items():
        paths[name] = f"{folder.rstrip('/')}/{name}.parquet"
        export_parquet(storage_order(mart, [mart_order(name)], ["latitude", "longitude"]), paths[name])
    return paths


def publish_marts(spark: SparkSession, exported: Mapping[str, str], folder: str) -> dict[str, str]:
    """Publish exported marts as guarded CSV below ``folder`` and return the paths."""
    paths = {}
    for name, source in exported.items():
        paths[name] = f"{folder.rstrip('/')}/{name}.csv"
        publish(spark.read.parquet(source), paths[name])
    return paths
