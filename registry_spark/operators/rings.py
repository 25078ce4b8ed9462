"""Rings of polygons (columns ``points``: x, y in degrees) to edges, and what is wrong with a ring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.sources.shared import written


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def _readable() -> Column:
    return F.forall("points", lambda p: _finite(p["x"]) & _finite(p["y"]))


def _ends_meet() -> Column:
    first, last = F.get("points", F.lit(0)), F.get("points", F.size("points") - 1)
    return F.coalesce((first["x"] == last["x"]) & (first["y"] == last["y"]), F.lit(False))


def _corners() -> Column:
    return F.size(F.array_distinct("points"))


def _edges() -> Column:
    """Edges of a ring in order, the closing one added where it is missing, those without length left out."""
    closed = F.when(_ends_meet(), F.col("points")).otherwise(F.concat("points", F.slice("points", 1, 1)))
    n = F.greatest(F.size(closed) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(closed, F.lit(1), n), F.slice(closed, F.lit(2), n),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
    )
    return F.filter(pairs, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def edge_table(rings: DataFrame, *, key: str = "country") -> DataFrame:
    """Edges (country, x1, y1, x2, y2) of all rings, as the boundary tests take them.

    Rings of fewer than three corners or with a coordinate that is no number have no edges; open rings are closed.
    Edges that run both ways between two parts cancel in the even-odd test, which also gives rings that cross
    themselves the area that splitting them at the crossings would give.
    """
    usable = rings.filter(_readable() & (_corners() >= 3))
    return usable.select(F.col(key).alias("country"), F.inline(_edges()))


def _pieces(edges: DataFrame) -> DataFrame:
    """Edges cut by bands and cells as high and wide as their ring's mean edge: about three rows an edge, however long one is."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.withColumn("band", F.explode(F.sequence(F.floor(low / F.col("high")), F.floor(high / F.col("high")))))

    def x_at(y: Column) -> Column:
        run = (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
        return F.col("x1") + run

    bottom, top = F.greatest(low, F.col("band") * F.col("high")), F.least(high, (F.col("band") + 1) * F.col("high"))
    a, b = F.coalesce(x_at(bottom), F.col("x1")), F.coalesce(x_at(top), F.col("x2"))
    slack = F.col("wide") * 1e-6
    left, right = F.floor((F.least(a, b) - slack) / F.col("wide")), F.floor((F.greatest(a, b) + slack) / F.col("wide"))
    return banded.withColumn("cell", F.explode(F.sequence(left, right)))


def _crosses() -> Column:
    """Whether edges l and r cross at a point inside both."""

    def side(e: str, x: Column, y: Column) -> Column:
        return F.signum(
            (F.col(f"{e}.x2") - F.col(f"{e}.x1")) * (y - F.col(f"{e}.y1")) - (F.col(f"{e}.y2") - F.col(f"{e}.y1")) * (x - F.col(f"{e}.x1"))
        )

    def parts(e: str, o: str) -> Column:
        return side(e, F.col(f"{o}.x1"), F.col(f"{o}.y1")) * side(e, F.col(f"{o}.x2"), F.col(f"{o}.y2")) < 0

    return parts("l", "r") & parts("r", "l")


def ring_report(rings: DataFrame, *, keep: list[str]) -> DataFrame:
    """Per ring: ``keep``, part, ring, n_points, n_crossings (pairs of its edges that cross), problem.

    ``problem`` is the first that applies of no_number, few_corners, open, crossing, else NULL. Edges meet only
    those of their ring in the same cell of a grid as fine as the ring's mean edge, not all others.
    """
    numbered = written(rings.withColumn("__ring", F.monotonically_increasing_id()))
    usable = numbered.filter(_readable() & (_corners() >= 3)).select("__ring", _edges().alias("__edges"))

    def mean(a: str, b: str) -> Column:
        total = F.aggregate("__edges", F.lit(0.0), lambda s, e: s + F.abs(e[a] - e[b]))
        return F.coalesce(F.nullif(total / F.size("__edges"), F.lit(0.0)), F.lit(1.0))

    edges = usable.select(
        "__ring", mean("x1", "x2").alias("wide"), mean("y1", "y2").alias("high"), F.posexplode("__edges").alias("place", "e")
    ).select("__ring", "wide", "high", "place", "e.*")
    cut = _pieces(edges).select("__ring", "band", "cell", "place", "x1", "y1", "x2", "y2")
    together = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("__ring", "band", "cell")]
    # Merged: the optimizer takes the size of the rings' files for that of their pieces and would send all pieces to every task.
    other = cut.alias("r").hint("merge")
    met = cut.alias("l").join(other, [*together, F.col("l.place") < F.col("r.place")]).filter(_crosses())
    crossings = met.select("l.__ring", F.col("l.place").alias("one"), F.col("r.place").alias("other")).distinct()
    counted = crossings.groupBy("__ring").agg(F.count(F.lit(1)).alias("n_crossings"))
    n = F.coalesce("n_crossings", F.lit(0)).cast("long")
    problem = (
        F.when(~_readable(), F.lit("no_number")).when(_corners() < 3, F.lit("few_corners"))
        .when(~_ends_meet(), F.lit("open")).when(n > 0, F.lit("crossing"))
    )
    return numbered.join(counted, "__ring", "left").select(
        *keep, "part", "ring", F.size("points").alias("n_points"), n.alias("n_crossings"), problem.alias("problem")
    )
