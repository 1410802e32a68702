"""Scalar geodesy as Column expressions.

All functions take and return ``Column``s so they stay inside whole-stage codegen.
Angles follow the reference definitions: radians in, raw ``atan2`` bearings in
(-pi, pi], degree bearings folded into [0, 360).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
EARTH_RADIUS_M = 6371000.0
EARTH_RADIUS_KM = 6371.0

ColumnOrName = Column | str


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def rad(x) -> Column:
    return F.radians(_c(x))


def deg(x) -> Column:
    return _c(x) * F.lit(180.0) / F.lit(math.pi)


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance (G1 metres, G2 with ``radius=EARTH_RADIUS_KM``).

    ``1 - a`` is clamped at 0: rounding can push ``a`` a hair above 1 for antipodal
    points, and ``sqrt`` of a negative number is NaN in Spark.
    """
    p1, p2 = rad(lat1), rad(lat2)
    dlat = p2 - p1
    dlon = rad(lon2) - rad(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    c = F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(1.0) - a, F.lit(0.0))))
    return F.lit(radius) * c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    return haversine(lat1, lon1, lat2, lon2, EARTH_RADIUS_KM)


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Initial great-circle bearing in radians, (-pi, pi]."""
    p1, p2 = rad(lat1), rad(lat2)
    dlon = rad(lon2) - rad(lon1)
    y = F.sin(dlon) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dlon)
    return F.atan2(y, x)


def mod360(x) -> Column:
    """Non-negative remainder, like Python's ``x % 360`` for finite x."""
    return F.pmod(_c(x), F.lit(360.0))


def bearing_deg(radians_col) -> Column:
    """Radian bearing -> degrees in [0, 360)."""
    return mod360(deg(radians_col))


def smallest_angle(d, full: float = 360.0) -> Column:
    """``min(d, full - d)`` for an absolute angle difference."""
    d = _c(d)
    return F.least(d, F.lit(full) - d)


def to_local_xy(lat0, lon0, lat, lon) -> tuple[Column, Column]:
    """Equirectangular offset (dx east, dy north) in metres of (lat, lon) from (lat0, lon0)."""
    phi, phi0 = rad(lat), rad(lat0)
    dx = (rad(lon) - rad(lon0)) * F.cos((phi + phi0) / 2.0) * F.lit(EARTH_RADIUS_M)
    dy = (phi - phi0) * F.lit(EARTH_RADIUS_M)
    return dx, dy


def from_local_xy(lat0, lon0, dx, dy) -> tuple[Column, Column]:
    """Inverse of :func:`to_local_xy`: latitude first, then longitude at the mean latitude."""
    phi0 = rad(lat0)
    phi = phi0 + _c(dy) / F.lit(EARTH_RADIUS_M)
    lam = rad(lon0) + _c(dx) / (F.lit(EARTH_RADIUS_M) * F.cos((phi + phi0) / 2.0))
    return deg(phi), deg(lam)


def clean_number(x) -> Column:
    """NULL, NaN and +-inf -> 0."""
    x = _c(x).cast("double")
    # NaN and NULL both fail the comparison, so one test covers all three cases.
    return F.when(F.abs(x) < F.lit(float("inf")), x).otherwise(F.lit(0.0))
