"""Point in polygon against boundaries given as an edge table.

Edges are rows ``(country, x1, y1, x2, y2)`` in degrees, all rings together: an
even-odd test makes holes and several parts work alike. Edges are straight in degrees
(``surface="plane"``) or arcs of great circles (``surface="sphere"``, see ``spherical``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.operators import spherical
from registry_spark.operators.coordinates import has_coordinates
from registry_spark.operators.lookups import lookup_join

BAND_DEGREES = 0.05


def band_edges(edges: DataFrame, width: float = BAND_DEGREES) -> DataFrame:
    """One row per edge and latitude band it touches."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    return edges.select(
        F.col("country").alias("edge_country"),
        F.explode(F.sequence(F.floor(low / width), F.floor(high / width))).alias("edge_band"),
        F.struct("x1", "y1", "x2", "y2").alias("edge"),
    )


def bands(edges: DataFrame, width: float = BAND_DEGREES) -> DataFrame:
    """One row per (country, latitude band) with its edges; narrower bands hold fewer."""
    return (
        band_edges(edges, width).groupBy("edge_country", "edge_band").agg(F.collect_list("edge").alias("edges"))
    )


def _side(e: Column, lat: Column, lon: Column) -> Column:
    return (lat - e["y1"]) * (e["x2"] - e["x1"]) - (lon - e["x1"]) * (e["y2"] - e["y1"])


def inside(edges: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """(odd number of edges east of the point, point lies on an edge)."""

    def crossed(e: Column) -> Column:
        straddles = (e["y1"] <= lat) != (e["y2"] <= lat)
        side = _side(e, lat, lon)
        return straddles & (side != 0) & ((side > 0) == (e["y2"] > e["y1"]))

    def touched(e: Column) -> Column:
        in_box = lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])) & lon.between(
            F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
        )
        return in_box & (_side(e, lat, lon) == 0)

    odd = F.size(F.filter(edges, crossed)) % 2 == 1
    return F.coalesce(odd, F.lit(False)), F.coalesce(F.exists(edges, touched), F.lit(False))


def with_verdict(
    df: DataFrame, edges: DataFrame, *, country: str = "country", width: float = BAND_DEGREES, method: str = "auto"
) -> DataFrame:
    """Add ``in_interior`` and ``on_boundary``; both NULL where the country has no boundary.

    A point meets one row, its own band's edges, so no point is multiplied and
    nothing is regrouped per point.
    """
    banded = df.withColumn("__band", F.floor(F.col("latitude") / width))
    covered = edges.select(F.col("country").alias("covered_country"), F.lit(True).alias("covered")).distinct()
    joined = lookup_join(banded, covered, [(country, "covered_country")], method=method)
    joined = lookup_join(
        joined, bands(edges, width), [(country, "edge_country"), ("__band", "edge_band")], method=method
    )
    odd, touching = inside(F.col("edges"), F.col("latitude"), F.col("longitude"))
    return joined.withColumns({
        "on_boundary": F.when(F.col("covered"), touching),
        "in_interior": F.when(F.col("covered"), odd & ~touching),
    }).drop("__band", "covered", "edges")


def judged(df: DataFrame, edges: DataFrame, surface: str, options: dict) -> DataFrame:
    if surface not in ("plane", "sphere"):
        raise ValueError("surface must be 'plane' or 'sphere'")
    return (with_verdict if surface == "plane" else spherical.with_verdict)(df, edges, **options)


def filter_within(df: DataFrame, edges: DataFrame, *, surface: str = "plane", **options) -> DataFrame:
    """Keep plausible points inside or on their country's boundary.

    Rows of countries without a boundary stay as they are.
    """
    keep = F.col("in_interior").isNull() | (F.col("coordinate_valid") & (F.col("in_interior") | F.col("on_boundary")))
    return judged(df, edges, surface, options).filter(keep).drop("in_interior", "on_boundary")


def flag_within(df: DataFrame, edges: DataFrame, *, surface: str = "plane", **options) -> DataFrame:
    """``coordinate_valid`` also FALSE unless strictly inside the boundary.

    An earlier FALSE stays; missing coordinates give NULL; countries without a
    boundary keep their flag.
    """
    flag = (
        F.when(~has_coordinates(), F.lit(None).cast("boolean"))
        .when(F.col("in_interior").isNull(), F.col("coordinate_valid"))
        .otherwise(F.coalesce(F.col("coordinate_valid"), F.lit(True)) & F.col("in_interior"))
    )
    return judged(df, edges, surface, options).withColumn("coordinate_valid", flag).drop("in_interior", "on_boundary")
