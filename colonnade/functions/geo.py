"""Geometry and physics formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    dp, dl = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dp) * F.sin(dp) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dl) * F.sin(dl)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(12742.0 * asin(sqrt(least(1.0, sin(radians({lat2} - {lat1}) / 2) ** 2 + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* sin(radians({lon2} - {lon1}) / 2) ** 2))))"
    )


def location(key: str) -> tuple[Column, Column]:
    """A latitude and longitude spread from an integer key."""
    return 40 + F.expr(f"{key} * 37 % 1000") / F.lit(500.0), 28 + F.expr(f"{key} * 91 % 1000") / F.lit(500.0)


def location_sql(key: str) -> str:
    return f"40 + ({key} * 37 % 1000) / 500.0::DOUBLE AS lat, 28 + ({key} * 91 % 1000) / 500.0::DOUBLE AS lon"


# fixed values of the turbine
AIR_DENSITY, ROTOR_RADIUS, POWER_COEFFICIENT = 1.225, 45.0, 0.4
CUT_IN, RATED_SPEED, CUT_OUT, RATED_KW = 4.0, 13.0, 25.0, 2000.0


def turbine_power(v: Column) -> Column:
    """Power in kW: nothing outside the working range, cubic up to the rated speed, then flat."""
    cubic = F.lit(0.5 * AIR_DENSITY * math.pi * ROTOR_RADIUS**2 * POWER_COEFFICIENT / 1000) * v * v * v
    working = v.between(CUT_IN, CUT_OUT)
    return F.when(working & (v <= RATED_SPEED), F.least(cubic, F.lit(RATED_KW))).when(working, F.lit(RATED_KW)).otherwise(F.lit(0.0))


def turbine_power_sql(v: str) -> str:
    k = 0.5 * AIR_DENSITY * math.pi * ROTOR_RADIUS**2 * POWER_COEFFICIENT / 1000
    return (
        f"CASE WHEN {v} < {CUT_IN} OR {v} > {CUT_OUT} THEN 0.0::DOUBLE WHEN {v} <= {RATED_SPEED} "
        f"THEN least({k!r}::DOUBLE * {v} * {v} * {v}, {RATED_KW}::DOUBLE) ELSE {RATED_KW}::DOUBLE END"
    )


# fixed values of the day-length formula: axial tilt, latitude, a winter solstice
AXIAL_TILT, LATITUDE, SOLSTICE = 23.44, 47.61, "2000-12-21"


def daylight_hours(date: Column) -> Column:
    """Hours between sunrise and sunset: twice the hour angle at which the sun stands on the horizon.

    The sunrise equation with the southward tilt of the sun; where it has no root the sun stays up or down all day.
    """
    turn = F.datediff(date, F.lit(SOLSTICE).cast("date")) * F.lit(2 * math.pi / 365.25)
    product = F.lit(math.tan(math.radians(LATITUDE))) * F.tan(F.radians(F.lit(AXIAL_TILT) * F.cos(turn)))
    hour_angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product)))
    return hour_angle * F.lit(24 / math.pi)
