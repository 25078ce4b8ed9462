import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from registry_spark.functions.projection import to_degrees
from registry_spark.operators import boundaries, rings
from registry_spark.sources import geometry

SQUARE = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
HOLE = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
FAR = [[20, 0], [24, 0], [22, 3.5], [20, 0]]


def wkt_ring(points):
    return "(" + " , ".join(f"{x}  {y}" for x, y in points) + ")"


def as_edges(*all_rings):
    return sorted(tuple(map(float, (*a, *b))) for r in all_rings for a, b in zip(r, r[1:]))


def edges_of(found):
    return sorted((r.x1, r.y1, r.x2, r.y2) for r in rings.edge_table(found).collect())


@pytest.mark.parametrize("text,expected", [
    (f"POLYGON({wkt_ring(SQUARE)},\n{wkt_ring(HOLE)})", [SQUARE, HOLE]),
    (f" multipolygon ( ( {wkt_ring(SQUARE)} , {wkt_ring(HOLE)} ) , ( {wkt_ring(FAR)} ) ) ", [SQUARE, HOLE, FAR]),
    ("POLYGON Z ((0 0 5, 10 0 5, 10 10 5, 0 10 5, 0 0 5))", [SQUARE]),
    ("SRID=4326;POLYGON((0 0,10 0,10 10,0 10))", [SQUARE]),
    ("POLYGON EMPTY", []), ("POINT(1 2)", []), ("", []), (None, []), ("POLYGON((0 0, x 1, 2 2, 0 0))", []), ("POLYGON((0 0, 1, 2 2, 0 0))", []),
    ("POLYGON((0 0, 1 1, 0 0))", []), ("SRID=99;POLYGON((0 0, 1 1, 0 1, 0 0))", []), ("POLYGON((0 0,0 0,10 0,10 10,0 10,0 0))", [SQUARE]),
])
def test_wkt(frame, text, expected):
    found = geometry.wkt_rings(frame([("A", text)], "country string, g string"), "g", keep=["country"])
    assert edges_of(found) == as_edges(*expected)


def test_parts_and_rings_are_numbered(frame):
    text = f"MULTIPOLYGON(({wkt_ring(SQUARE)},{wkt_ring(HOLE)}),({wkt_ring(FAR)}))"
    found = geometry.wkt_rings(frame([("A", text)], "country string, g string"), "g", keep=["country"]).orderBy("part", "ring").collect()
    assert [(r.part, r.ring, len(r.points)) for r in found] == [(0, 0, 5), (0, 1, 5), (1, 0, 4)]


POLYGON = {"type": "Polygon", "coordinates": [SQUARE, HOLE]}
MULTI = {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [FAR]]}


@pytest.mark.parametrize("document,expected", [
    (POLYGON, [SQUARE, HOLE]), (MULTI, [SQUARE, HOLE, FAR]),
    ({"type": "Feature", "properties": {"name": "A"}, "geometry": MULTI}, [SQUARE, HOLE, FAR]),
    ({"type": "Feature", "properties": None, "geometry": None}, []),
    ({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": g} for g in (POLYGON, MULTI)]},
     [SQUARE, HOLE, SQUARE, HOLE, FAR]),
    ({"type": "GeometryCollection", "geometries": [POLYGON, {"type": "Point", "coordinates": [1, 2]}]}, [SQUARE, HOLE]),
    ({"type": "Point", "coordinates": [1, 2]}, []), ("no json", []), (None, []),
])
def test_geojson(frame, document, expected):
    text = document if document is None or isinstance(document, str) else json.dumps(document)
    rows = frame([("A", text)], "country string, d string")
    found = geometry.geojson_rings(geometry.geojson_features(rows, "d", keep=["country"]), "geometry", keep=["country"])
    assert edges_of(found) == as_edges(*expected)


@pytest.mark.parametrize("one_document", [True, False])
def test_geojson_file(spark, tmp_path, one_document):
    features = [{"type": "Feature", "properties": {"name": n}, "geometry": g} for n, g in (("A", POLYGON), ("B", {"type": "Polygon", "coordinates": [FAR]}))]
    path = tmp_path / "bounds.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1) if one_document else "\n".join(map(json.dumps, features)))
    edges = rings.edge_table(geometry.read_geojson(spark, str(path), "name", one_document=one_document))
    points = spark.createDataFrame([("A", 5.0, 2.0), ("A", 5.0, 5.0), ("B", 1.0, 22.0), ("B", 9.0, 22.0), ("C", 0.0, 0.0)], "country string, latitude double, longitude double")
    out = boundaries.with_verdict(points, edges).orderBy("country", "latitude", "longitude").collect()
    assert [r.in_interior for r in out] == [True, False, True, False, None]


def test_unread(frame):
    rows = [("POLYGON EMPTY",), ("POINT(1 2)",), (json.dumps(POLYGON),), ("words",), (None,), ("",)]
    assert {r.g for r in geometry.unread(frame(rows, "g string"), "g").collect()} == {"POINT(1 2)", "words", ""}


def utm(lon, lat, zone, south):
    """Forward transverse Mercator by the standard power series in longitude difference, for the inverse to be held against."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, dl = math.radians(lat), math.radians(lon - (6 * zone - 183))
    n, t, c = a / math.sqrt(1 - e2 * math.sin(phi) ** 2), math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2
    p = math.cos(phi) * dl
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
             + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi) - 35 * e2**3 / 3072 * math.sin(6 * phi))
    x = k0 * n * (p + (1 - t + c) * p**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * p**5 / 120) + 500_000
    y = k0 * (m + n * math.tan(phi) * (p * p / 2 + (5 - t + 9 * c + 4 * c * c) * p**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * p**6 / 720))
    return x, y + (10_000_000 if south else 0)


def test_projections(frame):
    cases = [(lon, lat) for lon in (34.2, 36.8, 39.0, 41.5) for lat in (-11.0, -1.25, 0.5, 8.0)]
    rows = [(lon, lat, *utm(lon, lat, 37, lat < 0), 32737 if lat < 0 else 32637) for lon, lat in cases]
    rows += [(lon, lat, math.radians(lon) * 6378137, math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) * 6378137, 3857) for lon, lat in cases]
    rows += [(lon, lat, lon, lat, code) for lon, lat in cases for code in (4326, None)]
    df = frame(rows, "lon double, lat double, x double, y double, srid int")
    lon, lat = to_degrees(F.col("x"), F.col("y"), F.col("srid"))
    for r in df.select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
        assert abs(r.lon - r.a) < 1e-7 and abs(r.lat - r.b) < 1e-7
    assert df.select(to_degrees(F.col("x"), F.col("y"), F.lit(1))[0].alias("v")).filter("v IS NOT NULL").count() == 0


def crossings(points):
    closed = points if points[0] == points[-1] else [*points, points[0]]
    edges = [(a, b) for a, b in zip(closed, closed[1:]) if a != b]

    def side(e, p):
        v = (e[1][0] - e[0][0]) * (p[1] - e[0][1]) - (e[1][1] - e[0][1]) * (p[0] - e[0][0])
        return (v > 0) - (v < 0)

    return sum(
        side(a, b[0]) * side(a, b[1]) < 0 and side(b, a[0]) * side(b, a[1]) < 0
        for i, a in enumerate(edges) for b in edges[i + 1:])


def test_ring_report_against_brute_force(frame):
    rng = random.Random(3)
    shapes = [[(float(rng.randrange(-20, 20)), float(rng.randrange(-20, 20))) for _ in range(rng.randrange(3, 40))] for _ in range(60)]
    shapes = [s if i % 2 else [*s, s[0]] for i, s in enumerate(shapes)]
    shapes.append([(math.cos(i / 50 * math.pi) * 3, math.sin(i / 50 * math.pi)) for i in range(100)])
    shapes.append([(0.0, 0.0), (1000.0, 0.1), *[(i % 2 * 0.01, i * 0.01) for i in range(200)]])
    shapes = [s for s in shapes if len(set(s)) >= 3]
    rows = [(i, 0, 0, s) for i, s in enumerate(shapes)] + [(-1, 0, 0, [(0.0, None), (1.0, 1.0)]), (-2, 0, 0, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]), (-3, 0, 0, [])]
    df = frame(rows, "i int, part int, ring int, points array<struct<x:double,y:double>>")
    out = {r.i: r for r in rings.ring_report(df, keep=["i"]).collect()}
    assert len(out) == len(rows)
    for i, s in enumerate(shapes):
        n = crossings(s)
        assert out[i].n_crossings == n, (i, s)
        assert out[i].problem == ("open" if s[0] != s[-1] else "crossing" if n else None)
    assert (out[-1].problem, out[-2].problem, out[-3].problem) == ("no_number", "few_corners", "few_corners")


def test_ring_pieces_are_not_broadcast(frame, capsys):
    """The pieces are many times larger than the file of the rings, by which the optimizer judges them."""
    df = frame([(1, 0, 0, [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)])],
               "i int, part int, ring int, points array<struct<x: double, y: double>>")
    report = rings.ring_report(df, keep=["i"])
    report.explain()
    assert not re.search(r"BroadcastHashJoin \[__ring#\d+L, band", capsys.readouterr().out)
    assert [r.n_crossings for r in report.collect()] == [1]
