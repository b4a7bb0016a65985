"""Staging, dimension and fact queries."""

from pyspark.sql import functions as F

from climagrid.operators.calendar import date_parts, dim_datetime
from climagrid.operators.spatial import DAILY_HALF_CELL, MONTHLY_HALF_CELL, cell_envelope, cell_region_map
from climagrid.plans import marts, staging
from climagrid.registry import query
from climagrid.registry.standins import (
    daily_bronze,
    date_parts_sql,
    dates,
    misspelled_edges,
    monthly_bronze,
    region_edges,
    waves_bronze,
    with_ctes,
)
from climagrid.session import broadcast_if_small
from climagrid.sources.regions import region_names


@query("filter_member", with_ctes("general1", "SELECT * FROM general1 WHERE number = 0"))
def filter_member(t):
    return staging.filter_member(monthly_bronze(t)["general1"])


@query("stg_general_water", with_ctes("general1 stg_water", "SELECT * FROM stg_water"))
def stg_general_water(t):
    return staging.stg_general_water(monthly_bronze(t)["general1"])


@query("stg_general_temp", with_ctes("general2 stg_temp", "SELECT * FROM stg_temp"))
def stg_general_temp(t):
    return staging.stg_general_temp(monthly_bronze(t)["general2"])


@query("stg_general_waves", with_ctes("general3 stg_waves", "SELECT * FROM stg_waves"))
def stg_general_waves(t):
    return staging.stg_general_waves(waves_bronze(t))


@query("stg_ag_temperature", with_ctes("temperature stg_temperature", "SELECT * FROM stg_temperature"))
def stg_ag_temperature(t):
    return staging.stg_ag_temperature(daily_bronze(t)["temperature"])


@query("stg_ag_wind", with_ctes("wind stg_wind", "SELECT * FROM stg_wind"))
def stg_ag_wind(t):
    return staging.stg_ag_wind(daily_bronze(t)["wind"])


@query("stg_ag_humidity", with_ctes("humidity stg_humidity", "SELECT * FROM stg_humidity"))
def stg_ag_humidity(t):
    return staging.stg_ag_humidity(daily_bronze(t)["humidity"])


@query("stg_ag_precip", with_ctes("precip stg_precip", "SELECT * FROM stg_precip"))
def stg_ag_precip(t):
    return staging.stg_ag_precip(daily_bronze(t)["precip"])


@query("stg_ag_et", with_ctes("et stg_et", "SELECT * FROM stg_et"))
def stg_ag_et(t):
    return staging.stg_ag_et(daily_bronze(t)["et"])


@query(
    "region_names",
    with_ctes(
        "misspelled",
        """SELECT CASE region WHEN 'Djiboutii' THEN 'Djibouti' WHEN 'AliSabieh' THEN 'Ali Sabieh' ELSE region END
             AS region, poly, count(*) AS n_edges, (SELECT count(*) FROM customer WHERE c_nationkey = poly) AS n_customers
           FROM misspelled GROUP BY 1, 2""",
    ),
)
def named_regions(t):
    customers = t.customer.groupBy(F.col("c_nationkey").alias("poly")).agg(F.count("*").alias("n"))
    edges = region_names(misspelled_edges(t)).groupBy("region", "poly").agg(F.count("*").alias("n_edges"))
    return edges.join(customers, "poly", "left").select(
        "region", "poly", "n_edges", F.coalesce("n", F.lit(0)).cast("long").alias("n_customers")
    )


@query("date_parts", f"SELECT o_orderkey, {date_parts_sql('o_orderdate')} FROM orders")
def parts_of_order_dates(t):
    return t.orders.select("o_orderkey", *date_parts(F.col("o_orderdate").cast("date")))


@query(
    "dim_datetime",
    f"""WITH days AS (SELECT {date_parts_sql('d')} FROM (
          SELECT unnest(generate_series(TIMESTAMP '1940-01-01', max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)),
        counts AS (SELECT CAST(o_orderdate AS DATE) AS datetime, count(*) AS n FROM orders GROUP BY 1)
        SELECT days.*, coalesce(n, 0) AS n_orders FROM days LEFT JOIN counts USING (datetime)""",
)
def calendar_of_orders(t):
    """The calendar up to the newest order, with the orders of each day."""
    today = t.orders.agg(F.date_add(F.max("o_orderdate").cast("date"), 1)).first()[0]
    counts = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("datetime")).agg(F.count("*").alias("n"))
    return dim_datetime(t.spark, today).join(counts, "datetime", "left").select(
        "datetime_id", "datetime", "year", "month", "month_year", "day", "weekday",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"),
    )


@query(
    "cell_envelope",
    with_ctes(
        "temperature",
        """SELECT latitude, longitude, longitude - 0.05e0 AS x0, latitude - 0.05e0 AS y0, longitude + 0.05e0 AS x1,
             latitude + 0.05e0 AS y1 FROM (SELECT DISTINCT lat AS latitude, lon AS longitude FROM temperature)""",
    ),
)
def envelopes(t):
    return cell_envelope(daily_bronze(t)["temperature"], DAILY_HALF_CELL, "lat", "lon")


@query(
    "join_spatial_overlap",
    with_ctes(
        "temperature edges daily_overlaps",
        "SELECT latitude, longitude, region, round(overlap_area, 9) AS overlap_area FROM daily_overlaps",
    ),
)
def overlaps(t):
    from climagrid.functions.arithmetic import round_half_away
    from climagrid.operators.spatial import join_spatial_overlap

    areas = join_spatial_overlap(envelopes(t), region_edges(t))
    return areas.withColumn("overlap_area", round_half_away("overlap_area", 9))


@query("cell_region_map", with_ctes("temperature edges daily_overlaps daily_map", "SELECT * FROM daily_map"))
def daily_cells(t):
    return cell_region_map(envelopes(t), region_edges(t))


@query(
    "cell_region_map_monthly",
    with_ctes("general1 edges monthly_overlaps monthly_map", "SELECT * FROM monthly_map"),
)
def monthly_cells(t):
    water = staging.filter_member(monthly_bronze(t)["general1"])
    return cell_region_map(cell_envelope(water, MONTHLY_HALF_CELL), region_edges(t))


_GENERAL_CTES = "general1 general2 edges monthly_overlaps monthly_map dates stg_water stg_temp"
_GENERAL_JOIN = """FROM stg_water t1 FULL JOIN stg_temp t2 ON t1.key_id = t2.key_id
  JOIN dates dt ON t1.datetime_id = dt.datetime_id JOIN monthly_map mr ON t1.coord_id = mr.coord_id"""
_GENERAL_MEASURES = """t1.total_precipitation, t1.rayonnement_solaire_surface, t1.evaporation_reelle,
  t1.evaporation_potentielle, t1.ruissellement, t1.versionERA5, t2.temperature, t2.temperature_point_rosee,
  t2.vitesse_vent, t2.temperature_sol_couche1, t2.humidite_volumique_sol1"""


def general(t):
    bronze = monthly_bronze(t)
    regions = marts.monthly_region_map(bronze["general1"], region_edges(t))
    return marts.int_general(bronze["general1"], bronze["general2"], dates(t), regions)


@query(
    "int_general",
    with_ctes(
        _GENERAL_CTES,
        f"""SELECT t1.key_id, t1.datetime_id, dt.datetime, dt.year, dt.month_year, t1.latitude, t1.longitude,
              mr.region AS "Region", t1.coord_id, {_GENERAL_MEASURES} {_GENERAL_JOIN}""",
    ),
)
def int_general(t):
    return general(t)


@query(
    "fact_general",
    with_ctes(
        _GENERAL_CTES,
        f"""SELECT t1.key_id, dt.month_year AS "Mois_Années", t1.latitude, t1.longitude, {_GENERAL_MEASURES}
            {_GENERAL_JOIN}""",
    ),
)
def fact_general(t):
    return marts.fact_general(general(t))


@query(
    "join_full_then_inner",
    with_ctes(
        _GENERAL_CTES,
        f"SELECT t1.key_id, dt.year, mr.region, t1.total_precipitation, t2.temperature {_GENERAL_JOIN}",
    ),
)
def full_then_inner(t):
    """The join as written: full on the key, then inner on the left side's columns."""
    bronze = monthly_bronze(t)
    regions = marts.monthly_region_map(bronze["general1"], region_edges(t))
    water = staging.stg_general_water(bronze["general1"])
    temp = staging.stg_general_temp(bronze["general2"])
    t2 = temp.select(F.col("key_id").alias("key_2"), "temperature")
    return (
        water.join(t2, F.col("key_id") == F.col("key_2"), "full")
        .join(broadcast_if_small(dates(t)).select("datetime_id", "year"), "datetime_id")
        .join(broadcast_if_small(regions).select("coord_id", "region"), "coord_id")
        .select("key_id", "year", "region", "total_precipitation", "temperature")
    )


@query(
    "dim_waves",
    with_ctes(
        "general3 stg_waves",
        """SELECT DISTINCT key_id, datetime_id AS "Date", latitude, longitude, direction_moyenne_vagues,
             periode_moyenne_vagues, versionERA5 FROM stg_waves
           WHERE direction_moyenne_vagues IS NOT NULL AND periode_moyenne_vagues IS NOT NULL""",
    ),
)
def dim_waves(t):
    return marts.dim_waves(waves_bronze(t))


_AG_CTES = """temperature wind et precip humidity edges daily_overlaps daily_map dates
  stg_temperature stg_wind stg_et stg_precip stg_humidity"""
_AG_JOIN = """FROM stg_temperature t1 JOIN stg_wind t2 ON t1.key_id = t2.key_id JOIN stg_et t3 ON t1.key_id = t3.key_id
  JOIN stg_precip t4 ON t1.key_id = t4.key_id JOIN stg_humidity t5 ON t1.key_id = t5.key_id
  JOIN dates dt ON t1.datetime_id = dt.datetime_id JOIN daily_map mr ON t1.coord_id = mr.coord_id"""


def agriculture(t):
    bronze = daily_bronze(t)
    regions = marts.daily_region_map(bronze["temperature"], region_edges(t))
    return marts.int_agriculture(bronze, dates(t), regions)


@query(
    "int_agriculture",
    with_ctes(
        _AG_CTES,
        f"""SELECT t1.key_id, t1.coord_id, t1.datetime_id, dt.datetime, dt.year, dt.month_year, mr.region AS "Region",
              t1.lat, t1.lon, Temp_Max_24h, Temp_Mean_24h, Temp_Min_24h, Wind_Speed_10m_Mean_24h,
              Reference_Evapotranspiration, Precipitation_Flux, Relative_Humidity_12h {_AG_JOIN}""",
    ),
)
def int_agriculture(t):
    return agriculture(t)


@query(
    "join_multiway_inner",
    with_ctes(
        _AG_CTES,
        f"""SELECT mr.region, dt.year, count(*) AS n_rows, max(Temp_Max_24h) AS hottest,
              max(Wind_Speed_10m_Mean_24h) AS windiest, max(Relative_Humidity_12h) AS wettest {_AG_JOIN} GROUP BY 1, 2""",
    ),
)
def multiway_summary(t):
    """The five-product join summed up per region and year."""
    return agriculture(t).groupBy(F.col("Region").alias("region"), "year").agg(
        F.count("*").alias("n_rows"),
        F.max("Temp_Max_24h").alias("hottest"),
        F.max("Wind_Speed_10m_Mean_24h").alias("windiest"),
        F.max("Relative_Humidity_12h").alias("wettest"),
    )


@query(
    "fact_agriculture",
    with_ctes(
        _AG_CTES,
        f"""SELECT dt.datetime AS "Date", dt.year AS "Années", dt.month_year AS "Mois_Années", t1.lat AS latitude,
              t1.lon AS longitude, Temp_Max_24h, Temp_Mean_24h AS "Temp_Moyenne_24h", Temp_Min_24h,
              Wind_Speed_10m_Mean_24h AS "Vitesse_vent_10m_Moyenne", Reference_Evapotranspiration, Precipitation_Flux,
              Relative_Humidity_12h AS "Humidité_Relative" {_AG_JOIN}""",
    ),
)
def fact_agriculture(t):
    return marts.fact_agriculture(agriculture(t))
