"""Coordinates: coercion, plausibility, and the geocode cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.countries import BOXES, Box
from registry_spark.functions.text import to_double, trim_ws
from registry_spark.operators.lookups import first_per_key, lookup_join


def coerce_coordinates(df: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_double(F.col(c), types[c]) for c in ("latitude", "longitude")})


def has_coordinates() -> Column:
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def drop_missing(df: DataFrame) -> DataFrame:
    return df.filter(has_coordinates())


def plausible(lat: Column, lon: Column, country: Column, boxes: dict[str, Box] = BOXES) -> Column:
    """FALSE off the globe or outside the country's box, edges inside; NULL without coordinates.

    A country without a box only gets the global test.
    """
    test = (
        F.when(lat.isNull() | lon.isNull(), F.lit(None).cast("boolean"))
        .when(~lat.between(F.lit(-90.0), F.lit(90.0)), F.lit(False))
        .when(~lon.between(F.lit(-180.0), F.lit(180.0)), F.lit(False))
    )
    if boxes:
        entries = []
        for name, b in boxes.items():
            entries += [F.lit(name), F.struct(
                *[F.lit(float(v)).alias(k) for k, v in
                  (("lat_min", b.lat_min), ("lat_max", b.lat_max), ("lon_min", b.lon_min), ("lon_max", b.lon_max))]
            )]
        box = F.element_at(F.create_map(*entries), F.lower(country))
        inside = lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])
        test = test.when(box.isNotNull() & ~inside, F.lit(False))
    return test.otherwise(F.lit(True))


def clean_coordinates(
    df: DataFrame, *, on_missing: str = "drop", boxes: dict[str, Box] = BOXES, country: str = "country"
) -> DataFrame:
    """Numeric coordinates, rows without them dropped (or kept), ``coordinate_valid`` set."""
    if on_missing not in ("drop", "keep"):
        raise ValueError("on_missing must be 'drop' or 'keep'")
    df = coerce_coordinates(df)
    if on_missing == "drop":
        df = drop_missing(df)
    return df.withColumn(
        "coordinate_valid", plausible(F.col("latitude"), F.col("longitude"), F.col(country), boxes)
    )


def geocode_query(name: Column, admin1: Column, country: Column) -> Column:
    """Text a place is looked up by: the known parts, joined by a comma."""
    return F.concat_ws(", ", trim_ws(name), trim_ws(admin1), trim_ws(country))


def fill_from_cache(df: DataFrame, cache: DataFrame, *, method: str = "auto") -> DataFrame:
    """Coordinates of rows that lack them, from earlier lookups.

    Adds ``geocode_query`` and ``geocode_status``: NULL for rows that had
    coordinates, else ``cached``, ``failed`` (looked up before, not found) or
    ``pending`` (never looked up). Needs numeric coordinates.
    """
    if "admin1" not in df.columns:
        df = df.withColumn("admin1", F.lit(None).cast("string"))
    if "coordinate_source" not in df.columns:
        df = df.withColumn("coordinate_source", F.lit(None).cast("string"))
    query = geocode_query(F.col("facility_name"), F.col("admin1"), F.col("country"))
    asked = df.withColumn("geocode_query", F.when(~has_coordinates(), query))

    known = cache.select("query", F.col("result_lat").isNull().alias("unresolved"), "result_lat", "result_lon")
    known = first_per_key(known, ["query"], ["unresolved", "result_lat", "result_lon"])
    found = lookup_join(asked, known, [("geocode_query", "query")], method=method)

    status = (
        F.when(F.col("geocode_query").isNull(), F.lit(None).cast("string"))
        .when(F.col("unresolved").isNull(), "pending")
        .when(F.col("unresolved"), "failed")
        .otherwise("cached")
    )
    hit = F.col("geocode_status") == "cached"
    return (
        found.withColumn("geocode_status", status)
        .withColumns({
            "latitude": F.when(hit, F.col("result_lat")).otherwise(F.col("latitude")),
            "longitude": F.when(hit, F.col("result_lon")).otherwise(F.col("longitude")),
            "coordinate_source": F.when(hit, F.lit("OSM")).otherwise(F.col("coordinate_source")),
        })
        .drop("unresolved", "result_lat", "result_lon")
    )


def geocode_failures(df: DataFrame) -> DataFrame:
    return df.filter(F.col("geocode_status") == "failed")


def geocode_pending(df: DataFrame) -> DataFrame:
    """Queries to look up outside, each once."""
    return df.filter(F.col("geocode_status") == "pending").select("geocode_query").distinct()


def merged_answers(cache: DataFrame, answers: DataFrame, *, order: str | None = None) -> tuple[DataFrame, bool]:
    """What a cache lacks of landed answers, or the whole new cache (then True) where answers stand for cached ones.

    Columns of both: query, result_lat, result_lon, result_type. A NULL latitude says that the place was not found.
    Answers without a query are left out.
    """
    values = ["result_lat", "result_lon", "result_type"]
    keys = [F.col(order)] if order else []
    # Of answers that nothing else tells apart, one that found the place.
    best = F.max(F.struct(*[k.alias("at") for k in keys], F.col("result_lat").isNotNull().alias("found"), *values)).alias("last")
    landed = answers.filter(F.col("query").isNotNull()).groupBy("query").agg(best).select("query", *[F.col(f"last.{v}").alias(v) for v in values])
    known = cache.select("query", F.lit(True).alias("known"), F.struct(*values).alias("old")).dropDuplicates(["query"])
    changed = landed.join(known, "query", "left").filter(F.col("known").isNull() | ~F.struct(*values).eqNullSafe(F.col("old")))
    fresh = changed.select("query", *values)
    if changed.filter("known").isEmpty():
        return fresh, False
    return cache.join(fresh.select("query"), "query", "left_anti").select("query", *values).unionByName(fresh), True
