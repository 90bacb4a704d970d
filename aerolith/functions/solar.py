"""Geometric solar position (low-precision Meeus series) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elevations that part day, the three twilights and night.
THRESHOLDS = (-50 / 60, -6.0, -12.0, -18.0)
PHASES = ("daylight", "civil_twilight", "nautical_twilight", "astronomical_twilight", "night")


def terms(seconds: Column) -> tuple[Column, Column]:
    """Declination (radians) and equation of time (minutes) at Unix seconds."""
    t = (seconds / 86400 + 2440587.5 - 2451545) / 36525
    mean = F.radians(F.pmod(280.46646 + t * (36000.76983 + 0.0003032 * t), F.lit(360.0)))
    anomaly = F.radians(357.52911 + t * (35999.05029 - 0.0001537 * t))
    ecc = 0.016708634 - t * (0.000042037 + 0.0000001267 * t)
    centre = (
        F.sin(anomaly) * (1.914602 - t * (0.004817 + 0.000014 * t))
        + F.sin(2 * anomaly) * (0.019993 - 0.000101 * t)
        + F.sin(3 * anomaly) * 0.000289
    )
    node = F.radians(125.04 - 1934.136 * t)
    apparent = mean + F.radians(centre - 0.00569 - 0.00478 * F.sin(node))
    tilt = F.radians(
        23 + (26 + (21.448 - t * (46.815 + t * (0.00059 - t * 0.001813))) / 60) / 60 + 0.00256 * F.cos(node)
    )
    y = F.pow(F.tan(tilt / 2), 2)
    minutes = 4 * F.degrees(
        y * F.sin(2 * mean)
        - 2 * ecc * F.sin(anomaly)
        + 4 * ecc * y * F.sin(anomaly) * F.cos(2 * mean)
        - 0.5 * y * y * F.sin(4 * mean)
        - 1.25 * ecc * ecc * F.sin(2 * anomaly)
    )
    return F.asin(F.sin(tilt) * F.sin(apparent)), minutes


def position(seconds: Column, latitude: Column, longitude: Column) -> tuple[Column, Column]:
    """Elevation and azimuth in degrees; the azimuth is null at zenith and nadir."""
    declination, minutes = terms(seconds)
    hour = F.radians(F.pmod((F.pmod(seconds, F.lit(86400.0)) / 60 + 4 * longitude + minutes) / 4, F.lit(360.0)) - 180)
    lat = F.radians(latitude)
    sine = F.sin(lat) * F.sin(declination) + F.cos(lat) * F.cos(declination) * F.cos(hour)
    elevation = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine))))
    turn = F.degrees(F.atan2(F.sin(hour), F.cos(hour) * F.sin(lat) - F.tan(declination) * F.cos(lat)))
    return elevation, F.when(F.abs(sine) < 1 - 1e-14, F.pmod(turn + 180, F.lit(360.0)))


def in_domain(seconds: Column, latitude: Column, longitude: Column) -> Column:
    """Where the series holds: 1900 to 2100, within 72 degrees of latitude."""
    ok = (seconds >= -2208988800) & (seconds < 4133980800) & (F.abs(latitude) <= 72) & (F.abs(longitude) <= 180)
    return F.coalesce(ok & ~F.isnan(latitude) & ~F.isnan(longitude), F.lit(False))


def phase(elevation: Column) -> Column:
    """A boundary value belongs to the brighter phase."""
    out = F.when(elevation >= THRESHOLDS[0], PHASES[0])
    for limit, name in zip(THRESHOLDS[1:], PHASES[1:], strict=False):
        out = out.when(elevation >= limit, name)
    return out.when(elevation.isNotNull(), PHASES[-1])
