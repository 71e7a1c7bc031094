"""Planar to geographic coordinates as pure column arithmetic.

Inverse of the Lambert conformal conic projection with two standard parallels, as in
Snyder, "Map Projections: A Working Manual" (1987), with the closed series for the
latitude, so that no iteration and no UDF is needed.  The grid constants follow from
the ellipsoid and the parallels and are worked out here once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions import fixed

_FLATTENING = 1.0 / fixed.GRS80_INVERSE_FLATTENING
_E2 = _FLATTENING * (2.0 - _FLATTENING)
_E = math.sqrt(_E2)


def _parallel_radius(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1.0 - _E2 * math.sin(lat) ** 2)


def _conformal(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


def _grid_constants() -> tuple[float, float, float]:
    south, north = (math.radians(p) for p in fixed.GRID_PARALLELS)
    origin = math.radians(fixed.GRID_ORIGIN[0])
    cone = math.log(_parallel_radius(south) / _parallel_radius(north)) / math.log(
        _conformal(south) / _conformal(north)
    )
    scale = _parallel_radius(south) / (cone * _conformal(south) ** cone)
    return cone, scale, fixed.GRS80_SEMI_MAJOR * scale * _conformal(origin) ** cone


CONE, SCALE, ORIGIN_RADIUS = _grid_constants()

# Coefficients of sin 2k(chi) in the latitude series, by powers of the eccentricity.
SERIES = (
    _E2 / 2 + 5 * _E2**2 / 24 + _E2**3 / 12 + 13 * _E2**4 / 360,
    7 * _E2**2 / 48 + 29 * _E2**3 / 240 + 811 * _E2**4 / 11520,
    7 * _E2**3 / 120 + 81 * _E2**4 / 1120,
    4279 * _E2**4 / 161280,
)


def latitude_longitude(x: Column, y: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees, rounded to 6 digits."""
    east = x - F.lit(fixed.GRID_FALSE_EASTING)
    south = F.lit(ORIGIN_RADIUS) - (y - F.lit(fixed.GRID_FALSE_NORTHING))
    radius = F.sqrt(east * east + south * south)
    t = F.pow(radius / F.lit(fixed.GRS80_SEMI_MAJOR * SCALE), F.lit(1.0 / CONE))
    chi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
    latitude = chi
    for k, coefficient in enumerate(SERIES, start=1):
        latitude = latitude + F.lit(coefficient) * F.sin(F.lit(2.0 * k) * chi)
    longitude = F.lit(fixed.GRID_ORIGIN[1]) + F.degrees(F.atan2(east, south) / F.lit(CONE))
    return F.round(F.degrees(latitude), 6), F.round(longitude, 6)


def within_bounds(latitude: Column, longitude: Column) -> Column:
    return latitude.between(*map(F.lit, fixed.LATITUDE_BOUNDS)) & longitude.between(
        *map(F.lit, fixed.LONGITUDE_BOUNDS)
    )
