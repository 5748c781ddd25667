"""Fixed values of the motion rules and the parameters a caller may change."""

from __future__ import annotations

from dataclasses import dataclass

# Column names, grades, units and status prefixes that results depend on.
RESULT_KEYS = ("logType", "y", "m", "d", "h", "stage", "isFilled", "confScore")
RUN_KEYS = ("country", "stage", "y", "m", "d", "h")
FOOTPRINT_RUN_KEYS = ("dt", "hr")
PADDED_KEYS = ("m", "d", "h")
USABLE_GRADES = (94, 95)
NOT_MEASURABLE = -1.0
EARTH_RADIUS_KM = 6373.0
MILES_PER_KM = 0.621371
COORDINATE_PLACES = 5
TINY_VECTOR_DEG = 0.00001
INPUT_PREFIX = "ard/"
RESULT_PREFIX = "derived_speed/"


@dataclass(frozen=True)
class MotionParams:
    """Thresholds of the motion rules.

    upper_min    a segment counts while its time gap is below this (minutes, exclusive)
    lower_s      width of a time bucket (seconds)
    thres_s      reach of the turn angle to either side (seconds, inclusive)
    cap_mph      a speed counts while it is below this (exclusive)
    min_points   shorter trajectories are not measured
    """

    upper_min: float = 20.0
    lower_s: float = 5.0
    thres_s: float = 300.0
    cap_mph: float = 100.0
    min_points: int = 4


DEFAULTS = MotionParams()
