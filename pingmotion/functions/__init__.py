"""Column expressions; everything here stays inside Spark's generated code."""

from .geo import great_circle_miles, turn_between
from .scalar import answer_json, mean_measured, round_half_up, time_bucket, zero_padded

__all__ = [
    "answer_json",
    "great_circle_miles",
    "mean_measured",
    "round_half_up",
    "time_bucket",
    "turn_between",
    "zero_padded",
]
