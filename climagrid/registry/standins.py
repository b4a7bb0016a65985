"""Climate-shaped frames derived from the given tables, in Spark and in SQL.

The given tables hold no climate data. Keys become points of a lattice, dates
become observation times and amounts become measures, with the same expressions
on both sides. Every frame is built from a whole table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.functions.text import KEY_NULL
from climagrid.operators.calendar import dim_datetime
from climagrid.registry import Tables

TODAY = date(2001, 6, 1)

# --- daily products --------------------------------------------------------------

_DAILY_POINT = {
    "lat": "(109 + l_orderkey % 18) / 10e0",
    "lon": "(417 + l_partkey % 18) / 10e0",
}
_DAILY = {
    "temperature": (
        "lineitem",
        "l_shipdate",
        _DAILY_POINT,
        {
            "Temperature_Air_2m_Max_24h": "max(290e0 + l_quantity / 4e0 + l_discount)",
            "Temperature_Air_2m_Mean_24h": "max(285e0 + l_quantity / 4e0)",
            "Temperature_Air_2m_Min_24h": "min(280e0 + l_quantity / 4e0 - l_tax)",
        },
    ),
    "wind": ("lineitem", "l_shipdate", _DAILY_POINT, {"Wind_Speed_10m_Mean_24h": "max(l_extendedprice / 9999e0)"}),
    "et": ("lineitem", "l_shipdate", _DAILY_POINT, {"ReferenceET_PenmanMonteith_FAO56": "min(l_extendedprice / 20011e0)"}),
    "precip": ("lineitem", "l_shipdate", _DAILY_POINT, {"Precipitation_Flux": "max(l_discount * l_quantity)"}),
    "humidity": (
        "orders",
        "o_orderdate",
        {"lat": "(109 + o_orderkey % 18) / 10e0", "lon": "(417 + o_custkey % 18) / 10e0"},
        {"Relative_Humidity_2m_12h": "max(o_totalprice / 5000e0)"},
    ),
}

# --- monthly products ------------------------------------------------------------

_MONTHLY = {
    "general1": (
        "orders",
        "cast(date_trunc('month', o_orderdate) as {timestamp})",
        {
            "latitude": "(1100 + 25 * (o_orderkey % 7)) / 100e0",
            "longitude": "(4175 + 25 * (o_custkey % 8)) / 100e0",
            "number": "case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end",
            "expver": "case when o_orderdate < timestamp '2001-01-01 00:00:00' then '0001' else '0005' end",
        },
        {
            "tp": "max(o_totalprice / 1e8)",
            "ssrd": "max(o_totalprice * 100e0)",
            "e": "min(o_totalprice / -1e9)",
            "pev": "min(o_totalprice / -1e8)",
            "ro": "min(o_totalprice / 1e9)",
        },
    ),
    "general2": (
        "lineitem",
        "cast(date_trunc('month', l_shipdate) as {timestamp})",
        {
            "latitude": "(1100 + 25 * (l_orderkey % 7)) / 100e0",
            "longitude": "(4175 + 25 * (l_partkey % 8)) / 100e0",
            "number": "case l_returnflag when 'R' then 0 when 'A' then 1 else 2 end",
            "expver": "case when l_shipdate < timestamp '2001-01-01 00:00:00' then '0001' else '0005' end",
        },
        {
            "t2m": "max(290e0 + l_quantity / 4e0)",
            "d2m": "min(280e0 + l_quantity / 4e0)",
            "si10": "max(l_extendedprice / 9999e0)",
            "stl1": "max(295e0 + l_tax * 100e0)",
            "swvl1": "max(l_discount)",
            "sst": "max(nullif(300e0 + l_linenumber, 301e0))",
            "sp": "max(100000e0 + l_quantity)",
            "msl": "min(101000e0 + l_quantity)",
        },
    ),
}

# Waves are not aggregated: repeated rows are what the distinct mart removes.
_WAVES = {
    "valid_time": "cast(date_trunc('day', ts) as {timestamp})",
    "latitude": "(1100 + 25 * (user_id % 7)) / 100e0",
    "longitude": "(4175 + 25 * (user_id % 8)) / 100e0",
    "number": "case event_type when 'error' then 1 else 0 end",
    "expver": "'0001'",
    "mwd": "nullif(floor(value / 10e0) * 10e0, 0e0)",
    "mwp": "nullif(cast(floor(value / 50e0) as double), 9e0)",
}


def _grouped(definition, spark_side: bool) -> str:
    table, time, point, measures = definition
    time = time.format(timestamp="timestamp_ntz" if spark_side else "timestamp")
    name = "time" if "lat" in point else "valid_time"
    keys = {**point, name: time}
    columns = ", ".join(f"{e} AS {c}" for c, e in {**keys, **measures}.items())
    # Both engines group by the expressions behind the first columns.
    return f"SELECT {columns} FROM {table} GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))}"


def _frame(t: Tables, definition) -> DataFrame:
    return t.spark.sql(_grouped(definition, True).replace(f"FROM {definition[0]} ", "FROM {source} "), source=getattr(t, definition[0]))


def daily_bronze(t: Tables) -> dict[str, DataFrame]:
    return {name: _frame(t, d) for name, d in _DAILY.items()}


def monthly_bronze(t: Tables) -> dict[str, DataFrame]:
    return {name: _frame(t, d) for name, d in _MONTHLY.items()}


def waves_bronze(t: Tables) -> DataFrame:
    return t.events.selectExpr(*[f"{e.format(timestamp='timestamp_ntz')} AS {c}" for c, e in _WAVES.items()])


def dates(t: Tables) -> DataFrame:
    return dim_datetime(t.spark, TODAY)


# --- regions ---------------------------------------------------------------------

# Unit outlines: an L-shaped ring, and a square hole drawn in the same direction.
_SHAPE = [
    (0, 0, 0.0, 0.0, 1.0, 0.0),
    (0, 1, 1.0, 0.0, 1.0, 0.5),
    (0, 2, 1.0, 0.5, 0.5, 0.625),
    (0, 3, 0.5, 0.625, 0.5, 1.0),
    (0, 4, 0.5, 1.0, 0.0, 1.0),
    (0, 5, 0.0, 1.0, 0.0, 0.0),
    (1, 0, 0.125, 0.125, 0.25, 0.125),
    (1, 1, 0.25, 0.125, 0.25, 0.375),
    (1, 2, 0.25, 0.375, 0.125, 0.375),
    (1, 3, 0.125, 0.375, 0.125, 0.125),
]
_EDGE_FIELDS = ("ring", "seq", "x1", "y1", "x2", "y2")
_SHAPE_VALUES = ", ".join(
    f"({ring}, {seq}, {a!r}e0, {b!r}e0, {c!r}e0, {d!r}e0)" for ring, seq, a, b, c, d in _SHAPE
)
_SPELLED = "case r_name when 'AMERICA' then 'Djiboutii' when 'ASIA' then 'AliSabieh' else r_name end"
_EDGES = (
    "SELECT {name} AS region, n_nationkey AS poly, ring, seq, "
    + ", ".join(
        f"{base} + {c} * 0.4e0 AS {c}"
        for c, base in [
            ("x1", "(41.7e0 + (n_nationkey % 5) * 0.3e0)"),
            ("y1", "(10.9e0 + floor(n_nationkey / 5e0) * 0.3e0)"),
            ("x2", "(41.7e0 + (n_nationkey % 5) * 0.3e0)"),
            ("y2", "(10.9e0 + floor(n_nationkey / 5e0) * 0.3e0)"),
        ]
    )
    + " FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey "
    "CROSS JOIN (VALUES " + _SHAPE_VALUES + ") AS s(ring, seq, x1, y1, x2, y2)"
)


def region_edges(t: Tables, name: str = "r_name") -> DataFrame:
    """Five regions of five overlapping polygons each, every polygon with a hole."""
    west = F.expr("41.7e0 + (n_nationkey % 5) * 0.3e0")
    south = F.expr("10.9e0 + floor(n_nationkey / 5e0) * 0.3e0")
    # The ten template edges travel inside each nation row; no join is needed for them.
    template = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(row, _EDGE_FIELDS)]) for row in _SHAPE])
    return (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.expr(name).alias("region"), F.col("n_nationkey").alias("poly"), west.alias("w"), south.alias("s"), F.explode(template).alias("e"))
        .select(
            "region",
            "poly",
            "e.ring",
            "e.seq",
            (F.col("w") + F.col("e.x1") * 0.4).alias("x1"),
            (F.col("s") + F.col("e.y1") * 0.4).alias("y1"),
            (F.col("w") + F.col("e.x2") * 0.4).alias("x2"),
            (F.col("s") + F.col("e.y2") * 0.4).alias("y2"),
        )
    )


def misspelled_edges(t: Tables) -> DataFrame:
    return region_edges(t, _SPELLED)


# --- the same in SQL -------------------------------------------------------------


def _area_above(level: str) -> str:
    u, v = f"(a - {level})", f"(b - {level})"
    return (
        f"CASE WHEN {u} >= 0 AND {v} >= 0 THEN ({u} + {v}) / 2e0 * w "
        f"WHEN {u} <= 0 AND {v} <= 0 THEN 0e0 "
        f"ELSE pow(greatest({u}, {v}), 2) / (2e0 * abs({v} - {u})) * w END"
    )


def overlaps_sql(points: str, latitude: str, longitude: str, half: float) -> str:
    """Overlap areas, and mere touching, by clamping every edge to every cell."""
    return f"""
      SELECT latitude, longitude, region, round(abs(sum(part)), 12) AS overlap_area
      FROM (
        SELECT latitude, longitude, region, bool_or(least(a, b) <= y1c AND greatest(a, b) >= y0c) AS touching,
               CASE WHEN ring = 0 THEN 1 ELSE -1 END
               * abs(sum(sign(x2 - x1) * (({_area_above('y0c')}) - ({_area_above('y1c')})))) AS part
        FROM (
          SELECT *, CASE WHEN x0c <= least(x1, x2) THEN CASE WHEN x1 <= x2 THEN y1 ELSE y2 END ELSE
                 CASE WHEN x1 <= x2 THEN y1 ELSE y2 END + (y2 - y1) / (x2 - x1) * (x0c - least(x1, x2)) END AS a,
                 CASE WHEN x1c >= greatest(x1, x2) THEN CASE WHEN x1 <= x2 THEN y2 ELSE y1 END ELSE
                 CASE WHEN x1 <= x2 THEN y1 ELSE y2 END + (y2 - y1) / (x2 - x1) * (x1c - least(x1, x2)) END AS b, hi - lo AS w
          FROM (
            SELECT c.*, e.*, greatest(x0c, least(x1, x2)) AS lo, least(x1c, greatest(x1, x2)) AS hi
            FROM (SELECT latitude, longitude, longitude - {half}e0 AS x0c, latitude - {half}e0 AS y0c,
                         longitude + {half}e0 AS x1c, latitude + {half}e0 AS y1c
                  FROM (SELECT DISTINCT {latitude} AS latitude, {longitude} AS longitude FROM {points})) c
            CROSS JOIN edges e
          ) WHERE lo <= hi
        ) GROUP BY latitude, longitude, region, poly, ring
      ) GROUP BY latitude, longitude, region
      HAVING round(abs(sum(part)), 12) > 0 OR bool_or(touching)"""


def key_sql(*fields: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({f} AS VARCHAR), '{KEY_NULL}')" for f in fields) + "))"


def _map_sql(overlaps: str) -> str:
    return f"""
      SELECT {key_sql('latitude', 'longitude')} AS coord_id, latitude, longitude, region FROM (
        SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY overlap_area DESC, region) AS rn
        FROM {overlaps}) WHERE rn = 1"""


def date_parts_sql(column: str) -> str:
    return f"""strftime({column}, '%d/%m/%Y') AS datetime_id, CAST({column} AS DATE) AS datetime,
      CAST(year({column}) AS INTEGER) AS year, CAST(month({column}) AS INTEGER) AS month,
      strftime({column}, '%m/%Y') AS month_year, CAST(day({column}) AS INTEGER) AS day,
      CAST(dayofweek({column}) AS INTEGER) AS weekday"""


def _daily_stage(name: str, measures: dict[str, str]) -> str:
    day = "strftime(time, '%d/%m/%Y')"
    columns = ", ".join(f"round({e}, 2) AS {c}" for c, e in measures.items())
    return (
        f"SELECT {key_sql('lat', 'lon', day)} AS key_id, {key_sql('lat', 'lon')} AS coord_id, "
        f"{day} AS datetime_id, lat, lon, {columns} FROM {name}"
    )


def _monthly_stage(name: str, columns: str) -> str:
    day = "strftime(valid_time, '%d/%m/%Y')"
    return (
        f"SELECT {key_sql('latitude', 'longitude', day)} AS key_id, {key_sql('latitude', 'longitude')} AS coord_id, "
        f"{day} AS datetime_id, latitude, longitude, {columns}, expver AS versionERA5 FROM {name} WHERE number = 0"
    )


CTES = {
    **{name: _grouped(d, False) for name, d in _DAILY.items()},
    **{name: _grouped(d, False) for name, d in _MONTHLY.items()},
    "general3": "SELECT " + ", ".join(f"{e.format(timestamp='timestamp')} AS {c}" for c, e in _WAVES.items()) + " FROM events",
    "edges": _EDGES.format(name="r_name", nation="nation", region="region"),
    "misspelled": _EDGES.format(name=_SPELLED, nation="nation", region="region"),
    "daily_overlaps": overlaps_sql("temperature", "lat", "lon", 0.05),
    "monthly_overlaps": overlaps_sql("(SELECT * FROM general1 WHERE number = 0)", "latitude", "longitude", 0.125),
    "daily_map": _map_sql("daily_overlaps"),
    "monthly_map": _map_sql("monthly_overlaps"),
    "dates": f"""SELECT {date_parts_sql('d')} FROM
      generate_series(TIMESTAMP '1940-01-01', TIMESTAMP '{TODAY}' - INTERVAL 1 DAY, INTERVAL 1 DAY) AS g(d)""",
    "stg_temperature": _daily_stage(
        "temperature", {f"Temp_{s}_24h": f"Temperature_Air_2m_{s}_24h - 273.15e0" for s in ("Max", "Mean", "Min")}
    ),
    "stg_wind": _daily_stage("wind", {"Wind_Speed_10m_Mean_24h": "Wind_Speed_10m_Mean_24h"}),
    "stg_et": _daily_stage("et", {"Reference_Evapotranspiration": "ReferenceET_PenmanMonteith_FAO56"}),
    "stg_precip": _daily_stage("precip", {"Precipitation_Flux": "Precipitation_Flux"}),
    "stg_humidity": _daily_stage("humidity", {"Relative_Humidity_12h": "Relative_Humidity_2m_12h / 100e0"}),
    "stg_water": _monthly_stage(
        "general1",
        "valid_time, tp * 1000e0 AS total_precipitation, ssrd / 86400e0 AS rayonnement_solaire_surface, "
        "e * -1000e0 AS evaporation_reelle, pev * -1000e0 AS evaporation_potentielle, ro * 1000e0 AS ruissellement",
    ),
    "stg_temp": _monthly_stage(
        "general2",
        "t2m - 273.15e0 AS temperature, d2m - 273.15e0 AS temperature_point_rosee, si10 AS vitesse_vent, "
        "stl1 - 273.15e0 AS temperature_sol_couche1, swvl1 AS humidite_volumique_sol1, "
        "sst - 273.15e0 AS temperature_surface_mer, sp / 100e0 AS pression_surface, msl / 100e0 AS pression_niveau_mer",
    ),
    "stg_waves": _monthly_stage("general3", "mwd AS direction_moyenne_vagues, mwp AS periode_moyenne_vagues"),
}


def with_ctes(names: str, body: str) -> str:
    """``body`` after the named definitions, in the given order."""
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names.split()) + "\n" + body
