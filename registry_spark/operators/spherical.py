"""Point in polygon on the sphere: edges are arcs of great circles, the shorter way round.

A point looks due north: it is inside when an odd number of arcs lie between it and the pole, turned round where the
pole itself is inside. Edges are prepared once (unit normal, middle, bands of longitude), so a point and
an edge cost one product of vectors and no trigonometry.

* An edge across the date line falls into the bands on both sides of it.
* An edge with an end on a pole runs along a meridian and then along the pole; one between opposite
  meridians is cut at the pole it passes, the nearer one (north, if both are equally near).
* A country holds a pole when its rings go round it an odd number of times: the pole of the half in which most of
  its edges' ends lie. Both poles at once are not told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.operators.lookups import lookup_join

BANDS = 7_200  # of longitude, 0.05 degrees each
TOUCH = 1e-11  # radians from an arc that still count as on it, 0.06 mm on the ground
Vector = tuple[Column, Column, Column]


def turned(degrees: Column) -> Column:
    """The same direction in [-180, 180)."""
    return F.pmod(degrees + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def unit(lat: Column, lon: Column) -> Vector:
    """Point of the unit sphere."""
    a, b = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def _fields(name: str) -> Vector:
    return F.col(f"{name}x"), F.col(f"{name}y"), F.col(f"{name}z")


def _vector(name: str, v: Vector) -> list[Column]:
    return [c.alias(f"{name}{axis}") for c, axis in zip(v, "xyz")]


def without_opposite(edges: DataFrame) -> DataFrame:
    """Edges between opposite meridians cut at the pole they pass; the others as they are, without those of no length."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    pole = F.when(y1 + y2 >= 0, F.lit(90.0)).otherwise(F.lit(-90.0))

    def piece(*ends) -> Column:
        return F.struct(*[(e if isinstance(e, Column) else F.lit(e)).alias(n) for e, n in zip(ends, ("x1", "y1", "x2", "y2"))])

    beside = x1 + F.lit(90.0)
    opposite = (F.abs(turned(x2 - x1)) == 180) & (F.abs(y1) < 90) & (F.abs(y2) < 90)
    pieces = F.when(opposite, F.array(
        piece(x1, y1, x1, pole), piece(x1, pole, beside, pole), piece(beside, pole, x2, pole), piece(x2, pole, x2, y2),
    )).otherwise(F.array(piece(x1, y1, x2, y2)))
    some = ((turned(x1) != turned(x2)) | (y1 != y2)) & x1.isNotNull() & x2.isNotNull() & y1.isNotNull() & y2.isNotNull()
    return edges.filter(some).select("country", F.inline(pieces))


def arcs(edges: DataFrame) -> DataFrame:
    """One row per arc with what a test of a point needs.

    The normal is taken from the difference and the sum of the ends, which keeps short arcs exact. ``at_pole``:
    1 for arcs with an end on the north pole, -1 on the south pole, else 0.
    """
    x1, x2 = turned(F.col("x1")), turned(F.col("x2"))
    ends = without_opposite(edges).select(
        "country", x1.alias("x1"), "y1", x2.alias("x2"), "y2", *_vector("p", unit(F.col("y1"), x1)), *_vector("q", unit(F.col("y2"), x2)),
        F.when(F.greatest("y1", "y2") >= 90, 1).when(F.least("y1", "y2") <= -90, -1).otherwise(0).alias("at_pole"),
    )
    p, q = _fields("p"), _fields("q")
    middle = tuple(a + b for a, b in zip(p, q))
    normal = cross(tuple(a - b for a, b in zip(p, q)), middle)
    found = ends.select("country", "x1", "y1", "x2", "y2", "at_pole", *_vector("m", middle), *_vector("n", normal))
    m, n = _fields("m"), _fields("n")
    long, size = F.sqrt(dot(n, n)), F.sqrt(dot(m, m))
    return found.select(
        "country", "x1", "y1", "x2", "y2", "at_pole", (size / 2).alias("reach"),
        *_vector("n", tuple(F.when(long > 0, a / long).otherwise(F.lit(0.0)) for a in n)),
        *_vector("m", tuple(F.when(size > 0, a / size).otherwise(F.lit(0.0)) for a in m)),
    )


def band_of(lon: Column, bands: int = BANDS) -> Column:
    return F.floor((turned(lon) + 180) / F.lit(360.0) * bands)


def lune_bands(edges: DataFrame, bands: int = BANDS) -> DataFrame:
    """One row per (country, band of longitude) with the arcs that touch it; more bands hold fewer each."""
    step = turned(F.col("x2") - F.col("x1"))
    first, last = F.least(F.lit(0.0), step), F.greatest(F.lit(0.0), step)

    def number(by: Column) -> Column:
        return F.floor((F.col("x1") + by + 180) / F.lit(360.0) * bands)

    # A band more on either side: the ends' degrees are rounded.
    covered = F.sequence(number(first) - 1, number(last) + 1)
    banded = arcs(edges).withColumn("edge_band", F.explode(F.array_distinct(F.transform(covered, lambda b: F.pmod(b, F.lit(bands))))))
    fields = ["x1", "x2", "at_pole", "reach", "nx", "ny", "nz", "mx", "my", "mz"]
    return banded.groupBy(F.col("country").alias("edge_country"), "edge_band").agg(F.collect_list(F.struct(*fields)).alias("edges"))


def _spans(x1: Column, x2: Column, lon: Column) -> Column:
    """The arc meets the meridian; its western end counts, its eastern end does not."""
    a, b = turned(x1 - lon), turned(x2 - lon)
    return ((a < 0) != (b < 0)) & (F.abs(a - b) < 180)


def poles(edges: DataFrame) -> DataFrame:
    """Per country with a boundary: whether the north pole is inside, and which poles lie on an edge."""
    x1, x2 = turned(F.col("x1")), turned(F.col("x2"))
    odd = F.sum(F.when(_spans(x1, x2, F.lit(0.0)), 1).otherwise(0)) % 2 == 1
    north = F.sum(F.sin(F.radians("y1")) + F.sin(F.radians("y2"))) > 0
    return without_opposite(edges).groupBy(F.col("country").alias("covered_country")).agg(
        (odd & north).alias("pole_inside"),
        F.max(F.greatest("y1", "y2") >= 90).alias("north_touched"), F.max(F.least("y1", "y2") <= -90).alias("south_touched"),
    )


def verdicts(edges: Column, lat: Column, lon: Column, point: Vector) -> tuple[Column, Column]:
    """(odd number of arcs north of the point, point lies on an arc)."""

    def side(e: Column) -> Column:
        return dot((e["nx"], e["ny"], e["nz"]), point)

    def north(e: Column) -> Column:
        eastward = turned(e["x2"] - e["x1"]) > 0
        beyond = F.when(e["at_pole"] != 0, e["at_pole"] > 0).otherwise(F.when(eastward, side(e) < 0).otherwise(side(e) > 0))
        return _spans(e["x1"], e["x2"], lon) & beyond

    def touched(e: Column) -> Column:
        near = dot((e["mx"], e["my"], e["mz"]), point) >= e["reach"] - F.lit(1e-15)
        return (e["reach"] > 0) & (F.abs(side(e)) <= TOUCH) & near

    odd = F.size(F.filter(edges, north)) % 2 == 1
    return F.coalesce(odd, F.lit(False)), F.coalesce(F.exists(edges, touched), F.lit(False))


def with_verdict(df: DataFrame, edges: DataFrame, *, country: str = "country", bands: int = BANDS, method: str = "auto") -> DataFrame:
    """Add ``in_interior`` and ``on_boundary``; both NULL where the country has no boundary.

    A point meets one row, the arcs of its own band of longitude. Points without coordinates are neither
    inside nor on the boundary.
    """
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    banded = df.withColumns({"__band": band_of(lon, bands), **{f"__{axis}": c for c, axis in zip(unit(lat, lon), "xyz")}})
    joined = lookup_join(banded, poles(edges), [(country, "covered_country")], method=method)
    joined = lookup_join(joined, lune_bands(edges, bands), [(country, "edge_country"), ("__band", "edge_band")], method=method)
    odd, touching = verdicts(F.col("edges"), lat, lon, _fields("__"))
    at_pole = (F.col("north_touched") & (lat >= 90)) | (F.col("south_touched") & (lat <= -90))
    touching = touching | F.coalesce(at_pole, F.lit(False))
    covered, known = F.col("pole_inside").isNotNull(), lat.isNotNull() & lon.isNotNull()
    return joined.withColumns({
        "on_boundary": F.when(covered, known & touching),
        "in_interior": F.when(covered, known & (odd != F.col("pole_inside")) & ~touching),
    }).drop("__band", "__x", "__y", "__z", "pole_inside", "north_touched", "south_touched", "edges")
