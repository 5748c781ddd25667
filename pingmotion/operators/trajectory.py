"""Speed and turn angle along a trajectory, as window expressions.

A trajectory is the set of buckets of one device in one run. Its length is limited by the
time span of the run and not by the number of pings: 721 buckets of five seconds in an
hour, also for the group without uid. All expressions share one partitioning and order:
one exchange, one sort, one Window node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import great_circle_miles, mean_measured, round_half_up, turn_between
from ..settings import COORDINATE_PLACES, DEFAULTS, NOT_MEASURABLE, RUN_KEYS, MotionParams

_MISSING = NOT_MEASURABLE


def _along(run_keys: Sequence[str]):
    # uid comes first because the sort compares the first key by its leading bytes, and the
    # run keys are nearly constant
    return Window.partitionBy("uid", *run_keys).orderBy("sec")


def measurable_buckets(buckets: DataFrame) -> DataFrame:
    """Buckets with a time and a position; the others take no part in a trajectory."""
    return buckets.where(
        F.col("sec").isNotNull() & F.col("lat").isNotNull() & F.col("long").isNotNull()
    )


def with_neighbours(buckets: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Add the buckets before and after, and the length of the trajectory."""
    w = _along(run_keys)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = measurable_buckets(buckets).withColumns(
        {
            "lat_r": round_half_up(F.col("lat"), COORDINATE_PLACES),
            "long_r": round_half_up(F.col("long"), COORDINATE_PLACES),
        }
    )
    moved = {"n_buckets": F.count("*").over(whole)}
    for c in ("sec", "lat", "long", "lat_r", "long_r"):
        moved[f"prev_{c}"] = F.lag(c).over(w)
        moved[f"next_{c}"] = F.lead(c).over(w)
    return placed.withColumns(moved)


def with_segments(neighbours: DataFrame, params: MotionParams = DEFAULTS) -> DataFrame:
    """Gap (minutes), distance (miles) and speed (mph) of the segments that end (``in_``)
    and start (``out_``) here. ``_raw`` is the plain speed, ``_clip`` is not measurable
    when the gap or the speed is too large. Null where there is no such segment."""

    def miles(side: str) -> Column:
        return great_circle_miles(
            F.col(f"{side}_lat_r"), F.col(f"{side}_long_r"), F.col("lat_r"), F.col("long_r")
        )

    spans = neighbours.withColumns(
        {
            "in_min": (F.col("sec") - F.col("prev_sec")) / 60.0,
            "out_min": (F.col("next_sec") - F.col("sec")) / 60.0,
            "in_miles": miles("prev"),
            "out_miles": miles("next"),
        }
    ).withColumns(
        {
            "in_raw": F.col("in_miles") / F.col("in_min") * 60.0,
            "out_raw": F.col("out_miles") / F.col("out_min") * 60.0,
        }
    )

    def clipped(side: str) -> Column:
        keep = (F.col(f"{side}_min") < params.upper_min) & (F.col(f"{side}_raw") < params.cap_mph)
        return F.when(
            F.col(f"{side}_min").isNotNull(),
            F.when(keep, F.col(f"{side}_raw")).otherwise(F.lit(_MISSING)),
        )

    return spans.withColumns({"in_clip": clipped("in"), "out_clip": clipped("out")})


def with_point_speed(segments: DataFrame, params: MotionParams = DEFAULTS) -> DataFrame:
    """Speed at a bucket, from the segments on its two sides.

    The outgoing segment enters the mean with its plain speed and only the mean is held
    against the cap; the incoming one enters clipped. A bucket at an end has one segment.
    """
    blended = mean_measured(F.col("in_clip"), F.col("out_raw"))
    inner = F.when(
        F.col("out_min") < params.upper_min,
        F.when(blended < params.cap_mph, blended).otherwise(F.lit(_MISSING)),
    ).otherwise(F.col("in_clip"))
    speed = (
        F.when(F.col("n_buckets") < params.min_points, F.lit(_MISSING))
        .when(F.col("in_min").isNull(), F.col("out_clip"))
        .when(F.col("out_min").isNull(), F.col("in_clip"))
        .otherwise(inner)
    )
    return segments.withColumn("dspd", F.coalesce(speed, F.lit(_MISSING)))


def with_turn_angle(neighbours: DataFrame, params: MotionParams = DEFAULTS) -> DataFrame:
    """Angle between the ways to the two neighbours, in the plane of degrees; pi is
    straight on. Both neighbours must be within reach."""
    within = (
        (F.col("n_buckets") >= params.min_points)
        & (F.col("sec") - F.col("prev_sec") <= params.thres_s)
        & (F.col("next_sec") - F.col("sec") <= params.thres_s)
    )
    angle = turn_between(
        F.col("prev_lat") - F.col("lat"),
        F.col("prev_long") - F.col("long"),
        F.col("next_lat") - F.col("lat"),
        F.col("next_long") - F.col("long"),
    )
    return neighbours.withColumn("angle", F.when(within, angle).otherwise(F.lit(_MISSING)))


def with_mean_turn_angle(
    turned: DataFrame, run_keys: Sequence[str] = RUN_KEYS, params: MotionParams = DEFAULTS
) -> DataFrame:
    """Mean of the measurable turn angles within reach to either side.

    The last bucket within reach is left out of the mean. There must be a bucket within
    reach on both sides. The frame reuses the order of the other expressions and needs no
    array: it is a sum and a count, less the share of the last bucket.
    """
    reach = f"{float(params.thres_s)}D"
    # as text, because rangeBetween takes whole numbers only
    frame = (
        f"(PARTITION BY {', '.join(f'`{k}`' for k in ('uid', *run_keys))} ORDER BY sec"
        f" RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING)"
    )
    sums = turned.withColumns(
        {
            "_sum": F.expr(f"sum(if(angle >= 0, angle, null)) OVER {frame}"),
            "_n": F.expr(f"count(if(angle >= 0, angle, null)) OVER {frame}"),
            "_last": F.expr(f"last(angle) OVER {frame}"),
        }
    )
    drops_last = F.col("_last") >= 0
    total = F.col("_sum") - F.when(drops_last, F.col("_last")).otherwise(F.lit(0.0))
    n = F.col("_n") - F.when(drops_last, F.lit(1)).otherwise(F.lit(0))
    reachable = (
        (F.col("n_buckets") >= params.min_points)
        & (F.col("sec") - F.col("prev_sec") <= params.thres_s)
        & (F.col("next_sec") - F.col("sec") <= params.thres_s)
    )
    mean = F.when(reachable & (n > 0), F.greatest(total, F.lit(0.0)) / n)
    return sums.withColumn("mean_angle", F.coalesce(mean, F.lit(_MISSING))).drop(
        "_sum", "_n", "_last"
    )


def bucket_motion(
    buckets: DataFrame, run_keys: Sequence[str] = RUN_KEYS, params: MotionParams = DEFAULTS
) -> DataFrame:
    """Speed and turn angle of every measurable bucket: (run, uid, sec, dspd, angle)."""
    steps = with_neighbours(buckets, run_keys)
    moved = with_turn_angle(with_point_speed(with_segments(steps, params), params), params)
    return moved.select(*run_keys, "uid", "sec", "dspd", "angle")


def short_trajectories(
    buckets: DataFrame, run_keys: Sequence[str] = RUN_KEYS, params: MotionParams = DEFAULTS
) -> DataFrame:
    """Buckets that stay unmeasured because their trajectory is too short."""
    return (
        with_neighbours(buckets, run_keys)
        .where(F.col("n_buckets") < params.min_points)
        .select(*run_keys, "uid", "sec", "n_buckets")
    )
