import random

import pytest

from registry_spark.operators import boundaries

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6)]
TRIANGLE = [(20, 0), (24, 0), (22, 3)]


def ring(country, corners):
    return [(country, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]])]


@pytest.fixture
def edges(frame):
    rows = ring("A", SQUARE) + ring("A", HOLE) + ring("A", TRIANGLE)
    return frame(rows, "country string, x1 double, y1 double, x2 double, y2 double")


def points(frame, rows):
    return frame([(i, *r) for i, r in enumerate(rows)],
                 "i int, country string, latitude double, longitude double, coordinate_valid boolean")


CASES = [  # latitude, longitude, inside, on the boundary
    (5, 2, True, False), (5, 5, False, False), (5, 11, False, False), (1, 22, True, False), (2.9, 20.5, False, False),
    (0, 0, False, True), (0, 5, False, True), (10, 5, False, True), (5, 10, False, True), (4, 5, False, True),
    (1.5, 21, False, True), (-1, 5, False, False), (5, 4, False, True), (11, 22, False, False), (3, 22, False, True),
]


@pytest.mark.parametrize("width", [0.05, 1.0, 7.0])
@pytest.mark.parametrize("method", ["broadcast", "shuffle"])
def test_verdicts(frame, edges, width, method):
    df = points(frame, [("A", float(a), float(b), True) for a, b, _, _ in CASES])
    out = boundaries.with_verdict(df, edges, width=width, method=method).orderBy("i").collect()
    assert [(r.in_interior, r.on_boundary) for r in out] == [(i, b) for _, _, i, b in CASES]


def test_filter_keeps_the_boundary_and_uncovered_countries(frame, edges):
    rows = [("A", 5.0, 2.0, True), ("A", 0.0, 5.0, True), ("A", 5.0, 5.0, True), ("A", 5.0, 2.0, False),
            ("B", 5.0, 5.0, False)]
    out = boundaries.filter_within(points(frame, rows), edges).orderBy("i").collect()
    assert [r.i for r in out] == [0, 1, 4]


def test_flag_is_strict_and_keeps_false(frame, edges):
    rows = [("A", 5.0, 2.0, True), ("A", 0.0, 5.0, True), ("A", 5.0, 2.0, False), ("A", None, 2.0, True),
            ("B", 5.0, 5.0, True), ("A", 5.0, 2.0, None)]
    out = boundaries.flag_within(points(frame, rows), edges).orderBy("i").collect()
    assert [r.coordinate_valid for r in out] == [True, False, False, None, True, True]


def brute_force(corner_rings, x, y):
    odd, touching = False, False
    for corners in corner_rings:
        for (x1, y1), (x2, y2) in zip(corners, [*corners[1:], corners[0]]):
            cross = (y - y1) * (x2 - x1) - (x - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                touching = True
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd and not touching, touching


def test_grid_against_brute_force(frame, edges):
    rng = random.Random(7)
    grid = [(rng.randrange(-4, 48) / 4, rng.randrange(-4, 108) / 4) for _ in range(2000)]
    df = points(frame, [("A", y, x, True) for y, x in grid])
    out = boundaries.with_verdict(df, edges, width=0.3).orderBy("i").collect()
    want = [brute_force([SQUARE, HOLE, TRIANGLE], x, y) for y, x in grid]
    assert [(r.in_interior, r.on_boundary) for r in out] == want
    assert sum(b for _, b in want) > 50
