"""Unit conversions, wind and humidity, and distances, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CALM_BELOW = 1e-12
EARTH_RADIUS_M = 6371008.8


def finite(value: Column) -> Column:
    """Double of a value, null where it is not finite."""
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def is_calm(u: Column, v: Column) -> Column:
    return F.hypot(u, v) <= CALM_BELOW


def direction_from(u: Column, v: Column) -> Column:
    """Degrees the wind comes from, in [0, 360); null when calm."""
    angle = F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0))
    return F.when(~is_calm(u, v), angle)


def relative_humidity(t: Column, td: Column) -> Column:
    """Percent, from temperature and dew point in degrees Celsius."""
    part = lambda c: F.try_divide(F.lit(17.67) * c, c + 243.5)
    return 100 * F.exp(part(td) - part(t))


def humidity_outside(t: Column, td: Column) -> Column:
    """Both inputs are there, but the humidity is not defined for them."""
    rh = relative_humidity(t, td)
    wrong = rh.isNull() | F.isnan(rh) | (rh < 0) | (rh > 100.01) | (td < -123.15)
    return t.isNotNull() & td.isNotNull() & wrong


def haversine_m(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    a = (
        F.pow(F.sin(F.radians(lat1 - lat0) / 2), 2)
        + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * F.pow(F.sin(F.radians(lon1 - lon0) / 2), 2)
    )
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))))
