"""Great-circle boundaries against exact reasoning and a brute force that cuts every arc into short steps."""

import math
import random

import pytest

from registry_spark.operators import boundaries, spherical

RINGS = {
    "wide": [[(-60, 40), (60, 40), (60, 10), (-60, 10)]],  # its northern edge bulges to 59 degrees
    "date line": [[(170, -20), (-170, -20), (-165, 5), (172, 8)], [(178, -10), (-178, -10), (-178, -5), (178, -5)]],
    "arctic": [[(0, 70), (90, 65), (180, 70), (-90, 60)]],
    "antarctic": [[(-120, -70), (0, -65), (120, -75)]],
    "wedge": [[(10, 50), (40, 50), (0, 90)]],
    "over the pole": [[(20, 60), (-160, 60), (110, 40)]],
}


def ring(country, corners):
    return [(country, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]])]


@pytest.fixture
def edges(frame):
    rows = [r for country, parts in RINGS.items() for corners in parts for r in ring(country, corners)]
    return frame(rows, "country string, x1 double, y1 double, x2 double, y2 double")


def points(frame, rows):
    return frame([(i, *r, True) for i, r in enumerate(rows)],
                 "i int, country string, latitude double, longitude double, coordinate_valid boolean")


def vector(lon, lat):
    a, b = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)


def angle_around(p, parts, steps=150):
    """Times the rings go round a point, by the bearing of many short steps: no meridians, bands or poles."""
    x, y, z = p
    east = (-y, x, 0.0)
    size = math.hypot(*east)
    east = tuple(c / size for c in east)
    north = (y * east[2] - z * east[1], z * east[0] - x * east[2], x * east[1] - y * east[0])
    total = 0.0
    for corners in parts:
        for a, b in zip(corners, [*corners[1:], corners[0]]):
            u, v = vector(*a), vector(*b)
            last = None
            for k in range(steps + 1):
                q = tuple(s + (t - s) * k / steps for s, t in zip(u, v))
                if math.hypot(*q) < 1e-9:
                    continue
                bearing = math.atan2(sum(i * j for i, j in zip(q, east)), sum(i * j for i, j in zip(q, north)))
                if last is not None:
                    total += (bearing - last + math.pi) % (2 * math.pi) - math.pi
                last = bearing
    return round(total / (2 * math.pi))


# A bearing also turns round for rings about the point's antipode, so points are taken from the ring's half of the sphere.
HALVES = {"wide": (0, 35), "date line": (180, -7), "arctic": (0, 89), "antarctic": (0, -89), "wedge": (20, 60)}


def test_random_points_against_bearings(frame, edges):
    rng = random.Random(11)
    rows = []
    for country, middle in HALVES.items():
        m = vector(*middle)
        while sum(r[0] == country for r in rows) < 250:
            lat, lon = math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)
            if sum(a * b for a, b in zip(vector(lon, lat), m)) > 0.6:
                rows.append((country, lat, lon))
    want = [angle_around(vector(lon, lat), RINGS[country]) % 2 == 1 for country, lat, lon in rows]
    for bands in (36, 7_200):
        out = spherical.with_verdict(points(frame, rows), edges, bands=bands).orderBy("i").collect()
        wrong = [(r.country, r.latitude, r.longitude, w) for r, w in zip(out, want) if r.in_interior != w]
        assert not wrong
        assert 100 < sum(want) < 1_100 and not any(r.on_boundary for r in out)


CASES = [  # country, latitude, longitude, inside, on the boundary
    ("wide", 50.0, 0.0, True, False), ("wide", 58.0, 0.0, True, False), ("wide", 60.0, 0.0, False, False),
    ("wide", 15.0, 0.0, False, False), ("wide", 40.0, 60.0, False, True), ("wide", 25.0, 60.0, False, True),
    ("date line", 0.0, 180.0, True, False), ("date line", 0.0, -180.0, True, False), ("date line", -7.0, 179.0, False, False),
    ("date line", 0.0, 175.0, True, False), ("date line", 0.0, 0.0, False, False), ("date line", -7.0, 178.0, False, True),
    ("arctic", 90.0, 0.0, True, False), ("arctic", 89.0, 33.0, True, False), ("arctic", 40.0, 33.0, False, False),
    ("arctic", -89.0, 33.0, False, False), ("antarctic", -90.0, 12.0, True, False), ("antarctic", -89.0, 12.0, True, False),
    ("antarctic", 0.0, 12.0, False, False), ("antarctic", 90.0, 0.0, False, False),
    ("wedge", 80.0, 25.0, True, False), ("wedge", 80.0, 45.0, False, False), ("wedge", 80.0, 5.0, False, False),
    ("wedge", 70.0, 10.0, False, True), ("wedge", 90.0, 77.0, False, True),
    ("over the pole", 85.0, 110.0, True, False), ("over the pole", 85.0, -70.0, False, False),
    ("over the pole", 75.0, 20.0, False, True),
]


def test_long_edges_date_line_and_poles(frame, edges):
    out = spherical.with_verdict(points(frame, [c[:3] for c in CASES]), edges).orderBy("i").collect()
    assert [(r.country, r.latitude, r.longitude, r.in_interior, r.on_boundary) for r in out] == CASES


def test_short_edges_agree_with_the_plane(frame):
    rng = random.Random(3)
    corners = [(30 + rng.uniform(0.6, 1) * math.cos(t / 40 * math.tau), -2 + rng.uniform(0.6, 1) * math.sin(t / 40 * math.tau)) for t in range(40)]
    edges = frame(ring("A", corners), "country string, x1 double, y1 double, x2 double, y2 double")
    df = points(frame, [("A", rng.uniform(-3, -1), rng.uniform(29, 31)) for _ in range(1_000)])
    flat = {r.i: r.in_interior for r in boundaries.with_verdict(df, edges).collect()}
    round_ = {r.i: r.in_interior for r in spherical.with_verdict(df, edges).collect()}
    assert 300 < sum(flat.values()) < 900 and sum(flat[i] != round_[i] for i in flat) <= 2


def test_missing_values_and_names(frame, edges):
    rows = [("wide", None, 0.0), ("wide", 30.0, None), (None, 30.0, 0.0), ("elsewhere", 30.0, 0.0)]
    out = spherical.with_verdict(points(frame, rows), edges).orderBy("i").collect()
    assert [(r.in_interior, r.on_boundary) for r in out] == [(False, False)] * 2 + [(None, None)] * 2
    kept = boundaries.filter_within(points(frame, [("wide", 58.0, 0.0), ("wide", 60.0, 0.0), ("x", 0.0, 0.0)]), edges, surface="sphere")
    assert [r.i for r in kept.orderBy("i").collect()] == [0, 2]
    with pytest.raises(ValueError):
        boundaries.flag_within(points(frame, rows), edges, surface="cube")
    none = edges.limit(0)
    assert spherical.with_verdict(points(frame, rows), none).filter("in_interior IS NOT NULL").count() == 0
