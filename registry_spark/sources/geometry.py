"""Polygons given as text, WKT or GeoJSON, to rings: one row per ring, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.functions.projection import DEGREES, to_degrees

_OBJECT = "type string, coordinates string, geometry string, properties string, features array<string>, geometries array<string>"
_WKT = r"(?is)^\s*(?:SRID\s*=\s*(\d+)\s*;)?\s*(MULTIPOLYGON|POLYGON)\s*(?:ZM|Z|M)?\s*(\(.*\)|EMPTY)\s*$"


def _in_degrees(points: Column, srid: Column) -> Column:
    """Points (x, y) of a reference system in degrees; a ring that is in degrees stays as it is."""

    def moved(p: Column) -> Column:
        lon, lat = to_degrees(p["x"], p["y"], srid)
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.when(srid == DEGREES, points).otherwise(F.transform(points, moved))


def wkt_rings(df: DataFrame, geometry: str, *, keep: list[str], srid: int = DEGREES) -> DataFrame:
    """Rings of POLYGON and MULTIPOLYGON texts: ``keep``, part, ring (0: the outer one), points (x, y in degrees).

    A leading ``SRID=n;`` goes before ``srid``; heights are left out. NULL, EMPTY and other texts have no rings
    (``unread`` lists them); a coordinate that is no number is NULL. A text is cut into rings first, and points
    are read ring by ring.
    """
    text = F.col(geometry)
    system = F.coalesce(F.regexp_extract(text, _WKT, 1).try_cast("int"), F.lit(srid))
    bodies = F.split(F.regexp_extract(text, _WKT, 3), r"\)\s*\)\s*,\s*\(\s*\(")
    parts = df.select(*keep, system.alias("__srid"), F.posexplode(bodies).alias("part", "__part"))
    texts = parts.filter("__part <> '' AND upper(__part) <> 'EMPTY'").select(
        *keep, "__srid", "part", F.posexplode(F.regexp_extract_all("__part", F.lit(r"([^\s(),][^()]*)"), F.lit(1))).alias("ring", "__ring"))
    pairs = F.transform(F.split(F.regexp_replace("__ring", r"\s*,\s*", ","), ","), lambda p: F.split(p, r"\s+"))
    points = F.transform(pairs, lambda xy: F.struct(
        F.get(xy, F.lit(0)).try_cast("double").alias("x"), F.get(xy, F.lit(1)).try_cast("double").alias("y")))
    return texts.select(*keep, "part", "ring", _in_degrees(points, F.col("__srid")).alias("points"))


def geojson_features(df: DataFrame, document: str, *, keep: list[str] = ()) -> DataFrame:
    """One row per feature of GeoJSON documents: ``keep``, geometry (text), properties (map of texts).

    A document is a FeatureCollection, a Feature, or a bare geometry (properties NULL).
    """
    doc = F.from_json(F.col(document), _OBJECT)
    features = F.coalesce(doc["features"], F.array(F.col(document)))
    rows = df.select(*keep, F.explode(features).alias("__feature")).withColumn("__read", F.from_json("__feature", _OBJECT))
    bare = F.when(F.col("__read.type") != "Feature", F.col("__feature"))
    return rows.select(
        *keep, F.coalesce("__read.geometry", bare).alias("geometry"),
        F.from_json("__read.properties", "map<string,string>").alias("properties"),
    )


def geojson_rings(df: DataFrame, geometry: str, *, keep: list[str], srid: int = DEGREES) -> DataFrame:
    """Rings of Polygon and MultiPolygon geometries, also those of a GeometryCollection, as ``wkt_rings``."""
    members = F.coalesce(F.from_json(geometry, _OBJECT)["geometries"], F.array(F.col(geometry)))
    rows = df.select(*keep, F.explode(members).alias("__member")).withColumn("__read", F.from_json("__member", _OBJECT))
    one = F.array(F.from_json("__read.coordinates", "array<array<array<double>>>"))
    many = F.from_json("__read.coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("__read.type") == "Polygon", one).when(F.col("__read.type") == "MultiPolygon", many)

    found = rows.select(*keep, F.posexplode(parts).alias("part", "__rings")).select(
        *keep, "part", F.posexplode("__rings").alias("ring", "__points"))
    points = F.transform("__points", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return found.select(*keep, "part", "ring", _in_degrees(points, F.lit(srid)).alias("points"))


def unread(df: DataFrame, geometry: str) -> DataFrame:
    """Rows whose geometry is given but is no polygon in either form."""
    read = F.from_json(geometry, _OBJECT)
    polygon = F.coalesce(read["type"].isin("Polygon", "MultiPolygon", "GeometryCollection"), F.lit(False))
    return df.filter(F.col(geometry).isNotNull() & ~F.col(geometry).rlike(_WKT) & ~polygon)


def read_geojson(spark: SparkSession, path: str, name: str, *, key: str = "country", srid: int = DEGREES, one_document: bool = True) -> DataFrame:
    """Rings of a GeoJSON file, ``key`` from the property ``name``.

    ``one_document=False`` reads a feature a line, in parallel; boundaries larger than one task holds come so.
    """
    text = spark.read.text(path, wholetext=one_document)
    features = geojson_features(text, "value").select(F.col("properties")[name].alias(key), "geometry")
    return geojson_rings(features, "geometry", keep=[key], srid=srid)
