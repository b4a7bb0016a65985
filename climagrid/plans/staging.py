"""Bronze observations to staged frames: units, names and keys.

Each product is described by its measures; ``stage`` adds the keys. With
``native`` the keys are left out and the day stays a date in ``obs_day``, which is
what the marts join on before they add the keys to the rows that remain.

Measures are stored as single-precision floats, and converting them has to give
single-precision results. Arithmetic on the widened values, cut back to float
once, is exactly the float operation; the constants are cut to float first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climagrid.functions.arithmetic import round_half_away
from climagrid.functions.text import surrogate_key
from climagrid.operators.calendar import DAY_TEXT

# Unit conversions.
KELVIN_OFFSET = 273.15
MILLIMETRES_PER_METRE = 1000
SECONDS_PER_DAY = 86_400
PASCALS_PER_HECTOPASCAL = 100
PERCENT = 100

MEASURE_DIGITS = 2


def _own_type(df: DataFrame, name: str) -> T.DataType:
    """Float measures stay float, as they are stored; all other numbers become double."""
    kind = df.schema[name].dataType
    return kind if isinstance(kind, T.FloatType) else T.DoubleType()


def _operand(constant: float, kind: T.DataType) -> Column:
    """A constant rounded to the measure's type, for arithmetic in double."""
    return F.lit(float(constant)).cast(kind).cast("double")


def celsius(df: DataFrame, name: str) -> Column:
    kind = _own_type(df, name)
    return (F.col(name).cast("double") - _operand(KELVIN_OFFSET, kind)).cast(kind)


def times(df: DataFrame, name: str, factor: float) -> Column:
    kind = _own_type(df, name)
    return (F.col(name).cast("double") * _operand(factor, kind)).cast(kind)


def divided(df: DataFrame, name: str, divisor: float) -> Column:
    kind = _own_type(df, name)
    return (F.col(name).cast("double") / _operand(divisor, kind)).cast(kind)


def filter_member(df: DataFrame, member: int = 0) -> DataFrame:
    """Rows of one ensemble member."""
    return df.where(F.col("number") == member)


def with_keys(df: DataFrame, coordinates: Sequence[str]) -> DataFrame:
    """Put ``key_id`` and ``coord_id`` in front; ``coordinates`` name latitude, then longitude."""
    return df.select(
        surrogate_key(df, [*coordinates, "datetime_id"]).alias("key_id"),
        surrogate_key(df, list(coordinates)).alias("coord_id"),
        "*",
    )


def stage(
    df: DataFrame, time: str, coordinates: Sequence[str], measures: Sequence[Column], native: bool = False
) -> DataFrame:
    """Coordinates, day and measures, with keys and day text unless ``native``."""
    if native:
        return df.select(*coordinates, F.col(time).cast("date").alias("obs_day"), *measures)
    day_text = F.date_format(time, DAY_TEXT).alias("datetime_id")
    return with_keys(df.select(day_text, *coordinates, *measures), coordinates)


def _monthly(df: DataFrame, measures: Sequence[Column], native: bool) -> DataFrame:
    version = F.col("expver").alias("versionERA5")
    return stage(filter_member(df), "valid_time", ["latitude", "longitude"], [*measures, version], native)


def stg_general_water(df: DataFrame, native: bool = False) -> DataFrame:
    return _monthly(
        df,
        [
            F.col("valid_time"),
            times(df, "tp", MILLIMETRES_PER_METRE).alias("total_precipitation"),
            divided(df, "ssrd", SECONDS_PER_DAY).alias("rayonnement_solaire_surface"),
            times(df, "e", -MILLIMETRES_PER_METRE).alias("evaporation_reelle"),
            times(df, "pev", -MILLIMETRES_PER_METRE).alias("evaporation_potentielle"),
            times(df, "ro", MILLIMETRES_PER_METRE).alias("ruissellement"),
        ],
        native,
    )


def stg_general_temp(df: DataFrame, native: bool = False) -> DataFrame:
    return _monthly(
        df,
        [
            celsius(df, "t2m").alias("temperature"),
            celsius(df, "d2m").alias("temperature_point_rosee"),
            F.col("si10").alias("vitesse_vent"),
            celsius(df, "stl1").alias("temperature_sol_couche1"),
            F.col("swvl1").alias("humidite_volumique_sol1"),
            celsius(df, "sst").alias("temperature_surface_mer"),
            divided(df, "sp", PASCALS_PER_HECTOPASCAL).alias("pression_surface"),
            divided(df, "msl", PASCALS_PER_HECTOPASCAL).alias("pression_niveau_mer"),
        ],
        native,
    )


def stg_general_waves(df: DataFrame, native: bool = False) -> DataFrame:
    return _monthly(
        df,
        [
            F.col("mwd").alias("direction_moyenne_vagues"),
            F.col("mwp").alias("periode_moyenne_vagues"),
        ],
        native,
    )


def _daily(df: DataFrame, measures: dict[str, tuple[str, Column]], native: bool) -> DataFrame:
    """Measures by name as (source column, expression), rounded in the source's type."""
    rounded = [
        round_half_away(expression, MEASURE_DIGITS).cast(_own_type(df, source)).alias(name)
        for name, (source, expression) in measures.items()
    ]
    return stage(df, "time", ["lat", "lon"], rounded, native)


def stg_ag_temperature(df: DataFrame, native: bool = False) -> DataFrame:
    sources = {f"Temp_{stat}_24h": f"Temperature_Air_2m_{stat}_24h" for stat in ("Max", "Mean", "Min")}
    return _daily(df, {name: (source, celsius(df, source)) for name, source in sources.items()}, native)


def stg_ag_wind(df: DataFrame, native: bool = False) -> DataFrame:
    source = "Wind_Speed_10m_Mean_24h"
    return _daily(df, {"Wind_Speed_10m_Mean_24h": (source, F.col(source))}, native)


def stg_ag_humidity(df: DataFrame, native: bool = False) -> DataFrame:
    source = "Relative_Humidity_2m_12h"
    return _daily(df, {"Relative_Humidity_12h": (source, divided(df, source, PERCENT))}, native)


def stg_ag_precip(df: DataFrame, native: bool = False) -> DataFrame:
    source = "Precipitation_Flux"
    return _daily(df, {"Precipitation_Flux": (source, F.col(source))}, native)


def stg_ag_et(df: DataFrame, native: bool = False) -> DataFrame:
    source = "ReferenceET_PenmanMonteith_FAO56"
    return _daily(df, {"Reference_Evapotranspiration": (source, F.col(source))}, native)
