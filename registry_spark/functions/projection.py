"""Projected coordinates to degrees on the WGS 84 ellipsoid, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# EPSG codes, the ellipsoid, and the constants of the UTM grid.
DEGREES, WEB_MERCATOR, UTM_NORTH, UTM_SOUTH = 4326, 3857, 32600, 32700
RADIUS, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, EASTING, SOUTHERN_NORTHING = 0.9996, 500_000.0, 10_000_000.0

_N = FLATTENING / (2 - FLATTENING)
_MERIDIAN = RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Kruger's series up to the third power of the third flattening.
_BETA = (_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, _N**2 / 48 + _N**3 / 15, 17 / 480 * _N**3)
_DELTA = (2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3)


def _of_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


def _of_utm(x: Column, y: Column, srid: Column) -> tuple[Column, Column]:
    south = srid > UTM_SOUTH
    zone = srid - F.when(south, F.lit(UTM_SOUTH)).otherwise(F.lit(UTM_NORTH))
    north = (y - F.when(south, F.lit(SOUTHERN_NORTHING)).otherwise(F.lit(0.0))) / (SCALE * _MERIDIAN)
    east = (x - EASTING) / (SCALE * _MERIDIAN)
    xi, eta = north, east
    for j, b in enumerate(_BETA, 1):
        xi = xi - b * F.sin(2 * j * north) * F.cosh(2 * j * east)
        eta = eta - b * F.cos(2 * j * north) * F.sinh(2 * j * east)
    conformal = F.asin(F.sin(xi) / F.cosh(eta))
    lat = conformal
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * conformal)
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + zone * 6 - 183, F.degrees(lat)


def to_degrees(x: Column, y: Column, srid: Column) -> tuple[Column, Column]:
    """(longitude, latitude) of a point of a reference system: degrees, web Mercator, or a WGS 84 UTM zone.

    Other systems give NULL; a NULL system counts as degrees.
    """
    code = F.coalesce(srid, F.lit(DEGREES))
    mercator, utm = _of_mercator(x, y), _of_utm(x, y, code)
    in_zone = code.between(UTM_NORTH + 1, UTM_NORTH + 60) | code.between(UTM_SOUTH + 1, UTM_SOUTH + 60)

    def pick(plain: Column, m: Column, u: Column) -> Column:
        return F.when(code == DEGREES, plain).when(code == WEB_MERCATOR, m).when(in_zone, u)

    return pick(x, mercator[0], utm[0]), pick(y, mercator[1], utm[1])
