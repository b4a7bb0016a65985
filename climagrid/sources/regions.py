"""Region polygons: GeoJSON features to an edge table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_POLYGON = "array<array<array<double>>>"
_MULTI_POLYGON = f"array<{_POLYGON}>"
_FEATURE = "properties map<string,string>, geometry struct<type:string,coordinates:string>"

# Region names whose published spelling differs from the source.
REGION_SPELLING = {"Djiboutii": "Djibouti", "AliSabieh": "Ali Sabieh"}


def read_features(spark: SparkSession, path: str, line_delimited: bool = False) -> DataFrame:
    """Features as (properties, polygons).

    A FeatureCollection is one document and is read as such; large sets should be
    stored with one feature per line, which Spark splits over tasks.
    """
    if line_delimited:
        features = spark.read.schema(_FEATURE).json(path)
    else:
        collection = spark.read.schema(f"features array<struct<{_FEATURE}>>").json(path, multiLine=True)
        features = collection.select(F.inline("features"))
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    polygons = F.when(kind == "Polygon", F.array(F.from_json(text, _POLYGON))).when(
        kind == "MultiPolygon", F.from_json(text, _MULTI_POLYGON)
    )
    return features.select("properties", polygons.alias("polygons"))


def polygon_edges(features: DataFrame, name_property: str = "NAME_1") -> DataFrame:
    """Edges (region, poly, ring, seq, x1, y1, x2, y2) of every ring.

    A ring sits in one array, so each point finds the next one by position and no
    window or shuffle is needed. Ring 0 is the outline, later rings are holes.
    """
    rings = (
        features.select(
            F.col("properties")[name_property].alias("region"), F.posexplode("polygons").alias("poly", "_rings")
        )
        .select("region", "poly", F.posexplode("_rings").alias("ring", "_points"))
        .where(F.size("_points") > 1)
    )
    starts = F.slice("_points", 1, F.size("_points") - 1)
    ends = F.slice("_points", 2, F.size("_points") - 1)
    edges = rings.select(
        "region", "poly", "ring", F.posexplode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("seq", "_edge")
    )
    return edges.select(
        "region",
        "poly",
        "ring",
        "seq",
        F.col("_edge.a")[0].alias("x1"),
        F.col("_edge.a")[1].alias("y1"),
        F.col("_edge.b")[0].alias("x2"),
        F.col("_edge.b")[1].alias("y2"),
    )


def regions_from_geojson(
    spark: SparkSession, path: str, name_property: str = "NAME_1", line_delimited: bool = False
) -> DataFrame:
    return polygon_edges(read_features(spark, path, line_delimited), name_property)


def published_name(name: str | Column, spelling: Mapping[str, str] = REGION_SPELLING) -> Column:
    """A region's published name; unlisted names stay as they are."""
    column = F.col(name) if isinstance(name, str) else name
    result = column
    for source, published in spelling.items():
        result = F.when(column == source, published).otherwise(result)
    return result


def region_names(edges: DataFrame, spelling: Mapping[str, str] = REGION_SPELLING) -> DataFrame:
    return edges.withColumn("region", published_name("region", spelling))
