"""Hours around a target hour as extra input, so that a trajectory is not cut at the hour.

The run of a context job is (country, stage, target hour): the hour of the ping itself is
not part of the bucket or the window, because a ping just before the hour may round into
the first bucket of the next one.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.buckets import bucket_members, bucket_sums, merged_positions, with_time_bucket
from ..operators.fanout import fan_out
from ..operators.gates import eligible_pings
from ..operators.trajectory import (
    bucket_motion,
    with_neighbours,
    with_point_speed,
    with_segments,
    with_turn_angle,
)
from ..settings import DEFAULTS, RESULT_KEYS, MotionParams
from ..sources.scratch import settled
from .motion import in_a_run

CONTEXT_RUN_KEYS = ("country", "stage", "target_hour")


def own_hour():
    """The hour a ping is filed under, from its partition columns."""
    return F.expr("try_make_timestamp_ntz(y, m, d, h, 0, 0)")


def hours_between(pings: DataFrame, first: datetime, last: datetime) -> DataFrame:
    """Pings filed under the hours first..last, as plain equalities on partition columns
    so that the source can skip the other directories."""
    n = int((last - first).total_seconds() // 3600)
    wanted = [first + timedelta(hours=i) for i in range(n + 1)]
    return pings.where(
        reduce(
            lambda a, b: a | b,
            [
                (F.col("y") == t.year)
                & (F.col("m") == t.month)
                & (F.col("d") == t.day)
                & (F.col("h") == t.hour)
                for t in wanted
            ],
        )
    )


def _copied(sums: DataFrame, offset: int, target: datetime | None, params: MotionParams) -> DataFrame:
    """Motion for each target hour from a copy of every bucket that the hour sees: right for any reach,
    with ``2 * offset + 1`` copies when every hour is a target."""
    if target is None:
        reach = f"interval {int(offset)} hour"
        seen_by = F.explode(
            F.expr(f"sequence(own_hour - {reach}, own_hour + {reach}, interval 1 hour)")
        )
    else:
        seen_by = F.expr(f"timestamp_ntz'{target:%Y-%m-%d %H:00:00}'")
    # the hours of a bucket are merged per target hour: each sees the pings of its own reach
    positions = merged_positions(sums.withColumn("target_hour", seen_by), CONTEXT_RUN_KEYS)
    return bucket_motion(positions, CONTEXT_RUN_KEYS, params)


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
DEVICE = ("country", "stage", "uid")


def _stray() -> Column:
    """Sums that are filed under an hour which is not that of their time, or lack a position where two
    hours share a bucket. What a target hour sees of their device does not follow from time alone."""
    own = F.expr(f"timestampdiff(HOUR, {_EPOCH}, own_hour)")
    on_the_hour = F.col("sec") % 3600 == 0
    filed = (own == F.floor(F.col("sec") / 3600)) | (on_the_hour & (own + 1 == F.floor(F.col("sec") / 3600)))
    placed = ~on_the_hour | ((F.col("lat_n") > 0) & (F.col("long_n") > 0))
    return ~(filed & placed)


def _framed(sums: DataFrame, offset: int, params: MotionParams) -> DataFrame:
    """Motion for every target hour with each bucket once.

    Neighbours come from all hours: one too far off to be seen is also too far off to count, which is
    as if there were none. What depends on the hour is only the length of the trajectory, a sum
    over the hours around it. A bucket on the hour may hold pings of two hours and is then answered for both.
    """
    own = F.expr(f"timestampdiff(HOUR, {_EPOCH}, own_hour)")
    at = F.floor(F.col("sec") / 3600).cast("long")
    run = ("country", "stage")
    flagged = sums.withColumns(
        {"at": at, "late": (own == at).cast("int"), "early": (own < at).cast("int")}
    )
    merged = flagged.groupBy(*run, "uid", "sec", "at").agg(
        F.try_divide(F.sum("lat_sum"), F.sum("lat_n")).alias("lat"),
        F.try_divide(F.sum("long_sum"), F.sum("long_n")).alias("long"),
        F.max("late").alias("late"),
        F.max("early").alias("early"),
    )
    steps = with_neighbours(merged, run)

    def total(value: str, first: int, last: int) -> str:
        def bound(n: int) -> str:
            return "CURRENT ROW" if n == 0 else f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}"

        frame = f"PARTITION BY uid, country, stage ORDER BY at RANGE BETWEEN {bound(first)} AND {bound(last)}"
        return f"coalesce(sum({value}) OVER ({frame}), 0)"

    def length(hour: int) -> Column:
        """Buckets seen from the hour that lies so many hours from the bucket's: those with pings of their
        own hour, those on the hour with pings of the hour before only, and the last one with both."""
        a, b = hour - offset, hour + offset
        return F.expr(
            f"{total('late', a, b)} + {total('early * (1 - late)', a + 1, b + 1)} + {total('early * late', b + 1, b + 1)}"
        )

    seen = steps.withColumns({"_late_n": length(0), "_early_n": length(-1)})
    answers = F.filter(
        F.array(
            F.struct(F.col("at").alias("hour"), F.col("_late_n").alias("n"), F.col("late").alias("is")),
            F.struct((F.col("at") - 1).alias("hour"), F.col("_early_n").alias("n"), F.col("early").alias("is")),
        ),
        lambda x: x["is"] == 1,
    )
    rows = seen.withColumn("_for", F.explode(answers)).withColumns(
        {
            "n_buckets": F.col("_for.n"),
            "target_hour": F.expr(f"{_EPOCH} + make_dt_interval(0, cast(_for.hour AS int))"),
        }
    )
    moved = with_turn_angle(with_point_speed(with_segments(rows, params), params), params)
    return moved.select(*CONTEXT_RUN_KEYS, "uid", "sec", "dspd", "angle")


def _of_devices(sums: DataFrame, devices: DataFrame, how: str) -> DataFrame:
    renamed = devices.select(*[F.col(c).alias(f"_{c}") for c in DEVICE])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DEVICE])
    return sums.join(renamed, same, how)


def context_speed(
    pings: DataFrame,
    offset: int = 1,
    target: datetime | None = None,
    params: MotionParams = DEFAULTS,
) -> DataFrame:
    """Speed and angle of every eligible request, measured with the ``offset`` hours
    before and after its own hour in sight. ``offset=0`` equals the plain hourly answer.
    Without ``target`` every hour is a target, in one job.

    Where the reach covers all that a speed or an angle looks at, a bucket is windowed once for any
    ``offset``; only devices with pings filed under another hour than that of their time
    are measured from copies, one per target hour, as are all devices under a shorter reach.
    """
    if target is not None:
        reach = timedelta(hours=offset)
        pings = hours_between(pings, target - reach, target + reach)
    eligible = with_time_bucket(eligible_pings(in_a_run(pings)), params).withColumn(
        "own_hour", own_hour()
    )
    members = eligible.withColumn("target_hour", F.col("own_hour"))
    if target is not None:
        members = hours_between(members, target, target)
    sums = bucket_sums(eligible, ("country", "stage", "own_hour"))
    if max(params.upper_min * 60, params.thres_s) + params.lower_s > offset * 3600:
        motion = _copied(sums, offset, target, params)
    else:
        sums = settled(sums)
        odd = settled(sums.where(_stray()).select(*DEVICE).distinct())
        regular = sums.where(F.col("sec").isNotNull() & F.col("own_hour").isNotNull())
        if odd.limit(1).count():
            motion = _framed(_of_devices(regular, odd, "left_anti"), offset, params).unionByName(
                _copied(_of_devices(sums, odd, "left_semi"), offset, target, params)
            )
        else:
            motion = _framed(regular, offset, params)
        if target is not None:
            motion = motion.where(F.expr(f"target_hour = timestamp_ntz'{target:%Y-%m-%d %H:00:00}'"))
    answered = fan_out(
        bucket_members(members, ("request_id", *RESULT_KEYS), CONTEXT_RUN_KEYS),
        motion,
        CONTEXT_RUN_KEYS,
    )
    return answered.select("country", "request_id", *RESULT_KEYS, "dspd", "angle")
