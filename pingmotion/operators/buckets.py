"""Time buckets of a device: where it was, and which requests belong to the bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import round_half_up, time_bucket
from ..settings import COORDINATE_PLACES, DEFAULTS, RUN_KEYS, MotionParams


def with_time_bucket(pings: DataFrame, params: MotionParams = DEFAULTS) -> DataFrame:
    return pings.withColumn("sec", time_bucket(F.col("r_timestamp"), params.lower_s))


def bucket_sums(bucketed: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Per (run, device, bucket) the sums and counts from which its position follows."""
    lat = round_half_up(F.col("latitude"), COORDINATE_PLACES)
    long = round_half_up(F.col("longitude"), COORDINATE_PLACES)
    return bucketed.groupBy(*run_keys, "uid", "sec").agg(
        F.sum(lat).alias("lat_sum"),
        F.count(lat).alias("lat_n"),
        F.sum(long).alias("long_sum"),
        F.count(long).alias("long_n"),
        F.count("*").alias("n_pings"),
    )


def merged_positions(sums: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Bucket positions from sums, several rows of a bucket merged."""
    return sums.groupBy(*run_keys, "uid", "sec").agg(
        F.try_divide(F.sum("lat_sum"), F.sum("lat_n")).alias("lat"),
        F.try_divide(F.sum("long_sum"), F.sum("long_n")).alias("long"),
        F.sum("n_pings").alias("n_pings"),
    )


def bucket_positions(bucketed: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """One row per (run, device, bucket) with the mean of the rounded coordinates.

    Repeated requests weigh in. Only sums and counts cross the network: each input task
    folds its rows first, so a bucket or device holding a large share of all rows costs
    one partial row per task.
    """
    return bucketed.groupBy(*run_keys, "uid", "sec").agg(
        F.avg(round_half_up(F.col("latitude"), COORDINATE_PLACES)).alias("lat"),
        F.avg(round_half_up(F.col("longitude"), COORDINATE_PLACES)).alias("long"),
        F.count("*").alias("n_pings"),
    )


def bucket_members(
    bucketed: DataFrame, member_cols: Sequence[str], run_keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """The set of distinct members of every bucket, one row each.

    The set is kept as rows and never as an array per bucket, so no bucket has to fit in
    memory. Copies are folded before the shuffle and the shuffle key holds the whole
    member, so neither many copies nor a crowded bucket end up in one task.
    """
    cols = list(dict.fromkeys([*run_keys, "uid", "sec", *member_cols]))
    return bucketed.select(*cols).distinct()


def trajectory_summary(buckets: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Length and time span of each device's trajectory."""
    return buckets.groupBy(*run_keys, "uid").agg(
        F.count("*").alias("n_buckets"),
        F.min("sec").alias("first_sec"),
        F.max("sec").alias("last_sec"),
    )
