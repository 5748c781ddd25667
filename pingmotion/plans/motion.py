"""From request pings to one answered row per request.

Any number of countries, stages and hours go through one job: the run keys are part of
every grouping and window, so the answer is the same as from one job per hour.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import answer_json, zero_padded
from ..operators.buckets import bucket_members, bucket_positions, with_time_bucket
from ..operators.fanout import fan_out
from ..operators.gates import eligible_pings, sentinel_pings
from ..operators.trajectory import bucket_motion
from ..schema import require
from ..settings import (
    DEFAULTS,
    FOOTPRINT_RUN_KEYS,
    NOT_MEASURABLE,
    PADDED_KEYS,
    RESULT_KEYS,
    RUN_KEYS,
    MotionParams,
)
from ..sources.scratch import settled

POSITION_COLS = ("r_timestamp", "latitude", "longitude")
GATE_COLS = ("too_freq_uid", "r_s_info", "sl_adjusted_confidence")


def _every(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def in_a_run(pings: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Pings whose run is known; a run is picked by equality, which null never meets."""
    return pings.where(_every(F.col(key).isNotNull() for key in run_keys))


def answer_members(
    pings: DataFrame,
    member_cols: Sequence[str],
    run_keys: Sequence[str] = RUN_KEYS,
    params: MotionParams = DEFAULTS,
) -> DataFrame:
    """Distinct bucket members of ungated pings with the speed and angle of their bucket.

    The pings are scanned twice with different columns: narrow for positions and windows,
    wide for the members. The wide rows never pass a window.
    """
    bucketed = with_time_bucket(in_a_run(pings, run_keys), params)
    motion = bucket_motion(bucket_positions(bucketed, run_keys), run_keys, params)
    return fan_out(bucket_members(bucketed, member_cols, run_keys), motion, run_keys)


def request_speed(pings: DataFrame, params: MotionParams = DEFAULTS) -> DataFrame:
    """Speed and angle of every eligible request, as numbers."""
    answered = answer_members(
        eligible_pings(pings), ("request_id", *RESULT_KEYS), RUN_KEYS, params
    )
    return answered.select("country", "request_id", *RESULT_KEYS, "dspd", "angle")


def unmeasured_requests(pings: DataFrame, wide: bool = False) -> DataFrame:
    """Sentinel requests with the constant answer; repeats are kept."""
    missing = F.lit(NOT_MEASURABLE)
    return sentinel_pings(in_a_run(pings), wide).select(
        "country", "request_id", *RESULT_KEYS, missing.alias("dspd"), missing.alias("angle")
    )


def as_stored(answers: DataFrame) -> DataFrame:
    """Result rows as they are written: padded time parts and the answer as JSON."""
    padded = {c: zero_padded(F.col(c)) for c in PADDED_KEYS}
    return answers.withColumns(
        {**padded, "derived_speed": answer_json(F.col("angle"), F.col("dspd"))}
    ).select("request_id", "country", *RESULT_KEYS, "derived_speed")


def derived_speed(
    pings: DataFrame, params: MotionParams = DEFAULTS, wide: bool = False
) -> DataFrame:
    """All result rows of all runs in ``pings``, sentinel and measured, for one write."""
    require(pings, ("uid", "request_id", "country", *RESULT_KEYS, *POSITION_COLS, *GATE_COLS))
    rows = unmeasured_requests(pings, wide).unionByName(request_speed(pings, params))
    return as_stored(rows)


def footprint_speed(
    pings: DataFrame,
    params: MotionParams = DEFAULTS,
    run_keys: Sequence[str] = FOOTPRINT_RUN_KEYS,
) -> DataFrame:
    """Place matches of every bucket with its speed and angle. No quality gate applies."""
    require(pings, ("uid", "fp_matches", *run_keys, *POSITION_COLS))
    answered = answer_members(pings, ("fp_matches",), run_keys, params)
    return answered.select(*run_keys, "fp_matches", "dspd", "angle", "uid")


def only_hours(
    pings: DataFrame, hours: DataFrame, run_keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """Keep the runs listed in ``hours``, whose rows are settled first.

    The distinct values of each run key are few, however many runs there are. They are
    gathered into one row and become plain filters, from which the source skips the
    partition directories of other runs in every scan; a semi-join then picks the runs.
    """
    runs = settled(hours.select(*run_keys).distinct())
    values = runs.agg(*[F.collect_set(key).alias(key) for key in run_keys]).first()
    near = pings.where(_every(F.col(key).isin(sorted(values[key])) for key in run_keys))
    return near.join(runs, list(run_keys), "left_semi")


def days_union(tables: Sequence[DataFrame]) -> DataFrame:
    """The per-day tables of a backfill as one table, so that all days run in one job."""
    return reduce(DataFrame.unionByName, tables)
