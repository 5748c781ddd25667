"""Distances and directions on latitude / longitude columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import EARTH_RADIUS_KM, MILES_PER_KM, NOT_MEASURABLE, TINY_VECTOR_DEG


def great_circle_miles(lat_a: Column, long_a: Column, lat_b: Column, long_b: Column) -> Column:
    """Haversine distance in miles between two points given in degrees.

    Callers pass coordinates already rounded to five places, so a bucket is rounded once
    and not again for each of its two segments.
    """
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_lat = F.sin((phi_b - phi_a) / 2)
    half_long = F.sin((F.radians(long_b) - F.radians(long_a)) / 2)
    chord = half_lat * half_lat + F.cos(phi_a) * F.cos(phi_b) * half_long * half_long
    # rounding can lift the chord a hair above 1 for antipodes
    rest = F.greatest(F.lit(0.0), F.lit(1.0) - chord)
    return F.atan2(F.sqrt(chord), F.sqrt(rest)) * F.lit(2 * EARTH_RADIUS_KM * MILES_PER_KM)


def turn_between(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Angle in radians between the vectors a and b; pi when they point apart.

    Not measurable when a vector has no length, or when both are shorter than the
    resolution of the coordinates.
    """
    len_a = F.sqrt(ax * ax + ay * ay)
    len_b = F.sqrt(bx * bx + by * by)
    cosine = (ax * bx + ay * by) / len_a / len_b
    degenerate = (
        (len_a == 0)
        | (len_b == 0)
        | ((len_a < TINY_VECTOR_DEG) & (len_b < TINY_VECTOR_DEG))
        # Spark orders NaN above every number, so the clamp alone would turn NaN into cosine 1
        | F.isnan(len_a)
        | F.isnan(len_b)
    )
    angle = F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))
    return F.when(degenerate, F.lit(NOT_MEASURABLE)).otherwise(angle)
