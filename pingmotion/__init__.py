"""Motion facts (speed and turn angle) from large tables of device location pings."""

from .plans.motion import derived_speed, footprint_speed, request_speed
from .settings import DEFAULTS, MotionParams

__all__ = ["DEFAULTS", "MotionParams", "derived_speed", "footprint_speed", "request_speed"]
