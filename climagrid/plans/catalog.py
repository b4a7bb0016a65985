"""The catalogue of published datasets: column descriptions and upsert."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.sinks.tables import UNPUBLISHED, published_sizes

# Description and unit of known columns, by lower-case name.
COLUMN_INFO = {
    "time": ("Date de la mesure", ""),
    "date": ("Date de la mesure", ""),
    "valid_time": ("Date et heure de validité", ""),
    "number": ("Numéro d'ensemble", ""),
    "expver": ("Version de l'expérience", ""),
    "latitude": ("Latitude", "°N"),
    "longitude": ("Longitude", "°E"),
    "t2m": ("Température à 2 mètres", "K"),
    "d2m": ("Température du point de rosée à 2m", "K"),
    "tp": ("Précipitations totales", "m"),
    "u10": ("Composante U du vent à 10m", "m/s"),
    "v10": ("Composante V du vent à 10m", "m/s"),
    "si10": ("Vitesse du vent à 10m", "m/s"),
    "sp": ("Pression de surface", "Pa"),
    "msl": ("Pression au niveau de la mer", "Pa"),
    "tcc": ("Couverture nuageuse totale", "0-1"),
    "ssr": ("Rayonnement solaire net en surface", "J/m²"),
    "ssrd": ("Rayonnement solaire descendant en surface", "J/m²"),
    "strd": ("Rayonnement thermique descendant en surface", "J/m²"),
    "str": ("Rayonnement thermique net en surface", "J/m²"),
    "e": ("Évaporation", "m"),
    "pev": ("Évaporation potentielle", "m"),
    "ro": ("Ruissellement", "m"),
    "skt": ("Température de surface du sol", "K"),
    "sst": ("Température de surface de la mer", "K"),
    "stl1": ("Température du sol niveau 1", "K"),
    "swvl1": ("Teneur en eau du sol niveau 1", "m³/m³"),
    "datetime_id": ("Identifiant date-heure", ""),
    "versionera5": ("Version ERA5 de l'extraction", ""),
    "mwd": ("Direction moyenne des vagues", "°"),
    "mwp": ("Période moyenne des vagues", "s"),
    "direction_moyenne_vagues": ("Direction moyenne des vagues", "°"),
    "periode_moyenne_vagues": ("Période moyenne des vagues", "s"),
    "années": ("Année de la mesure", ""),
    "mois_années": ("Mois et année de la mesure", ""),
    "region": ("Région administrative (GADM niveau 1)", ""),
    "temp_max_24h": ("Température maximale de l'air à 2 m sur 24 h", "°C"),
    "temp_moyenne_24h": ("Température moyenne de l'air à 2 m sur 24 h", "°C"),
    "temp_min_24h": ("Température minimale de l'air à 2 m sur 24 h", "°C"),
    "vitesse_vent_10m_moyenne": ("Vitesse moyenne du vent à 10 m sur 24 h", "m/s"),
    "reference_evapotranspiration": ("Évapotranspiration de référence (Penman-Monteith FAO-56)", "mm/jour"),
    "precipitation_flux": ("Flux de précipitations", "mm/jour"),
    "humidité_relative": ("Humidité relative à 2 m (12h00 UTC)", "fraction 0-1"),
    "coord_id": ("Identifiant de coordonnée", ""),
}

# The published datasets, by the name of their mart.
DATASETS = {
    "general": {
        "group": "general",
        "file_path": "Copernicus/General/GeneralEra5",
        "name": "ERA5 - Données climatiques mensuelles - Djibouti",
        "description": (
            "Données de réanalyse climatique ERA5 (ECMWF) — extraction mensuelle pour Djibouti. "
            "Inclut les principales variables atmosphériques et de surface : température, "
            "précipitations, vent, pression, rayonnement solaire, humidité."
        ),
        "source": "Copernicus Climate Change Service (ECMWF) — ERA5",
        "theme_slug": "meteorologie_climat",
        "tags": ["ERA5", "climat", "mensuel", "Djibouti", "réanalyse", "ECMWF"],
    },
    "waves": {
        "group": "general",
        "file_path": "Copernicus/General/vagues",
        "name": "ERA5 - Données de vagues océaniques - Djibouti",
        "description": (
            "Données de réanalyse ERA5 (ECMWF) — vagues océaniques pour Djibouti. "
            "Inclut la direction moyenne et la période moyenne des vagues."
        ),
        "source": "Copernicus Climate Change Service (ECMWF) — ERA5",
        "theme_slug": "meteorologie_climat",
        "tags": ["ERA5", "vagues", "océanographie", "houle", "Djibouti", "réanalyse", "ECMWF"],
    },
    "agriculture": {
        "group": "agriculture",
        "file_path": "Copernicus/Agriculture/AgricultureEra5",
        "name": "ERA5 - Indicateurs agrométéorologiques journaliers - Djibouti",
        "description": (
            "Indicateurs agrométéorologiques journaliers dérivés de la réanalyse ERA5 "
            "(Copernicus C3S / AgERA5), depuis 2021 pour Djibouti, sur une grille de 0,1° "
            "(324 points) rattachée aux 6 régions administratives. Variables : températures "
            "de l'air à 2 m (maximale, moyenne, minimale sur 24 h), vitesse moyenne du vent "
            "à 10 m, humidité relative à 12h00, flux de précipitations et évapotranspiration "
            "de référence (Penman-Monteith FAO-56)."
        ),
        "source": "Copernicus Climate Change Service (ECMWF) — AgERA5 / ERA5",
        "theme_slug": "meteorologie_climat",
        "tags": [
            "ERA5", "AgERA5", "agrométéorologie", "journalier", "Djibouti",
            "agriculture", "évapotranspiration", "réanalyse", "ECMWF",
        ],
    },
}

# Type names that count as date, boolean and number, in this order.
PORTAL_TYPES = {
    "date": ("TIMESTAMP", "DATE", "TIME"),
    "boolean": ("BOOL",),
    "number": ("INT", "DOUBLE", "FLOAT", "DECIMAL", "REAL", "HUGEINT"),
}

# Fixed value: state of a newly created entry.
NEW_STATUS = "validated"


def portal_type(type_name: Column) -> Column:
    """date, boolean, number or string, by the parts of a type's name."""
    name = F.upper(type_name)
    result = F.lit("string")
    for kind, marks in reversed(PORTAL_TYPES.items()):
        result = F.when(name.rlike("|".join(marks)), kind).otherwise(result)
    return result


def column_info(spark: SparkSession, info: Mapping[str, tuple[str, str]] = COLUMN_INFO) -> DataFrame:
    rows = [(name, description, unit) for name, (description, unit) in info.items()]
    return spark.createDataFrame(rows, "column_key string, description string, unit string")


def described_columns(
    df: DataFrame, dataset: str, info: DataFrame, hidden: tuple[str, ...] = UNPUBLISHED
) -> DataFrame:
    """One row per published column: ordinal, name, description, unit and type.

    Unknown columns are described by their own name and have no unit.
    """
    spark = df.sparkSession
    fields = [f for f in df.schema if f.name.lower() not in hidden]
    rows = [(dataset, i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    schema = spark.createDataFrame(rows, "dataset string, ordinal int, name string, type_name string")
    known = schema.join(info, F.lower("name") == F.col("column_key"), "left")
    return known.select(
        "dataset",
        "ordinal",
        "name",
        F.coalesce("description", "name").alias("description"),
        F.coalesce("unit", F.lit("")).alias("unit"),
        portal_type(F.col("type_name")).alias("type"),
    )


def nested_columns(described: DataFrame) -> DataFrame:
    """(dataset, columns): the described columns of each dataset as one ordered list."""
    column = F.struct("ordinal", "name", "description", "unit", "type")
    ordered = described.groupBy("dataset").agg(F.sort_array(F.collect_list(column)).alias("columns"))
    return ordered.select(
        "dataset",
        F.transform(
            "columns",
            lambda c: F.struct(
                c["name"].alias("name"), c["description"].alias("description"),
                c["unit"].alias("unit"), c["type"].alias("type"),
            ),
        ).alias("columns"),
    )


def dataset_rows(spark: SparkSession, group: str | None = None, prefix: str = "", extension: str = "csv") -> DataFrame:
    """The published datasets of one group, or of all, as rows.

    ``prefix`` and ``extension`` make the paths equal to those of an existing catalogue.
    """
    groups = {d["group"] for d in DATASETS.values()}
    if group is not None and group not in groups:
        raise ValueError(f"unknown group {group!r}, known are {sorted(groups)}")
    rows = [
        (mart, d["name"], d["description"], d["source"], d["theme_slug"], d["tags"], f"{prefix}{d['file_path']}.{extension}")
        for mart, d in DATASETS.items()
        if group in (None, d["group"])
    ]
    schema = (
        "dataset string, name string, description string, source string, theme_slug string, "
        "tags array<string>, file_path string"
    )
    return spark.createDataFrame(rows, schema)


def catalog_rows(datasets: DataFrame, described: DataFrame, themes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Full catalogue rows of published datasets.

    ``datasets`` has dataset, name, description, source, theme_slug, tags and
    file_path; datasets of an unknown theme are left out. ``sizes`` gives
    (dataset, file_size_bytes) and ``themes`` (slug, id).
    """
    return (
        datasets.join(themes.select(F.col("slug").alias("theme_slug"), F.col("id").alias("theme_id")), "theme_slug")
        .join(sizes, "dataset")
        .join(nested_columns(described), "dataset")
        .select(
            "name",
            "description",
            "source",
            "theme_id",
            "file_path",
            F.lit("csv").alias("file_type"),
            "file_size_bytes",
            "columns",
            "tags",
            F.lit(NEW_STATUS).alias("status"),
            F.lit(None).cast("string").alias("created_by"),
        )
    )


def catalog_upsert(
    existing: DataFrame, incoming: DataFrame, key: str = "file_path", refreshed: str = "file_size_bytes"
) -> DataFrame:
    """Existing entries with a refreshed size, plus incoming entries not there yet.

    Everything else in an existing entry is kept as edited. One full join does both.
    Of incoming rows with one key the smallest is taken. NULL keys match nothing: such
    entries stay as they are, such incoming rows are all added.
    """
    rows = incoming.select(*[F.col(f"`{c}`") for c in existing.columns])
    own_key = F.col(f"`{key}`")
    new = rows.where(own_key.isNotNull()).groupBy(own_key.alias("_key")).agg(F.min(F.struct("*")).alias("_new"))
    known = F.col("_known").isNotNull()
    columns = []
    for name in existing.columns:
        own, other = F.col(f"`{name}`"), F.col("_new").getField(name)
        if name == refreshed:
            value = F.coalesce(other, own)
        else:
            value = F.when(known, own).otherwise(other)
        columns.append(value.alias(name))
    joined = existing.withColumn("_known", F.lit(True)).join(new, own_key == F.col("_key"), "full")
    return joined.select(*columns).unionAll(rows.where(own_key.isNull()))


def refresh_catalog(
    existing: DataFrame,
    exported: Mapping[str, str],
    published: Mapping[str, str],
    themes: DataFrame,
    group: str | None = None,
    prefix: str = "",
    extension: str = "csv",
) -> DataFrame:
    """The catalogue after publishing: sizes refreshed, unknown datasets of ``group`` added.

    ``exported`` gives the Parquet path and ``published`` the CSV path of each mart;
    ``prefix`` and ``extension`` are those of the paths in ``existing``.
    """
    spark = existing.sparkSession
    info = column_info(spark)
    marts = {mart: spark.read.parquet(path) for mart, path in exported.items()}
    described = reduce(DataFrame.unionAll, [described_columns(df, mart, info) for mart, df in marts.items()])
    marts_by_path = spark.createDataFrame([(p, m) for m, p in published.items()], "path string, dataset string")
    sizes = published_sizes(spark, list(published.values())).join(marts_by_path, "path").drop("path")
    return catalog_upsert(existing, catalog_rows(dataset_rows(spark, group, prefix, extension), described, themes, sizes))
