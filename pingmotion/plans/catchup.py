"""Run every hour that has input but no result, as one job, and log it afterwards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import zero_padded
from ..operators.status import TIME_PARTS, as_hour_text, pending_hours, status_rows, task_key
from ..settings import DEFAULTS, PADDED_KEYS, RESULT_PREFIX, RUN_KEYS, MotionParams
from ..sources.folders import qualified
from ..sources.publish import publish_runs, run_leaves
from ..sources.scratch import settled
from .motion import derived_speed, only_hours


def hour_range(
    spark: SparkSession,
    countries: Sequence[str],
    stages: Sequence[int],
    first: date,
    days: int,
) -> DataFrame:
    """Every hour of a range of days for a list of countries and stages, as runs."""
    start = f"timestamp_ntz'{first.isoformat()} 00:00:00'"
    hours = spark.range(days * 24).selectExpr(
        f"{start} + make_dt_interval(0, cast(id AS int)) AS hour"
    )
    listed = hours.select(
        "hour", F.explode(F.array(*[F.lit(c) for c in countries])).alias("country")
    ).select("*", F.explode(F.array(*[F.lit(int(s)) for s in stages])).alias("stage"))
    return listed.select(
        "country",
        "stage",
        F.year("hour").alias("y"),
        F.month("hour").alias("m"),
        F.day("hour").alias("d"),
        F.hour("hour").alias("h"),
        as_hour_text(F.col("hour")).alias("time"),
    )


def backfill(pings: DataFrame, hours: DataFrame, params: MotionParams = DEFAULTS) -> DataFrame:
    """Result rows of the listed runs (country, stage, y, m, d, h), computed at once."""
    return derived_speed(only_hours(pings, hours), params)


def done_events(hours: DataFrame) -> DataFrame:
    """Status events for finished hours."""
    return hours.select(
        task_key(RESULT_PREFIX, F.col("country"), F.col("stage")).alias("key"), "time"
    )


def as_filed(hours: DataFrame) -> DataFrame:
    """Run keys as result directories hold them: time parts of two characters."""
    return hours.withColumns({c: zero_padded(F.col(c)) for c in PADDED_KEYS})


def replace_runs(
    pings: DataFrame,
    hours: DataFrame,
    output: str,
    params: MotionParams = DEFAULTS,
    on_step: Callable[[str], None] = lambda step: None,
) -> None:
    """Compute the listed runs and make ``output`` hold just these rows of them: rows of an
    earlier computation go, also those filed under other keys or of an hour now empty.
    Other runs stay. The rows are computed and written before the old ones are touched, and a job
    killed at any point leaves every run as it was or as it becomes (``sources.publish``)."""
    hours = settled(hours)
    publish_runs(backfill(pings, hours, params), output, as_filed(hours), on_step=on_step)


def catch_up(
    pings: DataFrame,
    log: DataFrame,
    output: str,
    append_status: Callable[[DataFrame], None],
    params: MotionParams = DEFAULTS,
) -> DataFrame:
    """Compute and write the pending hours, then hand their status rows to
    ``append_status``. Whole runs are replaced, so a run that failed before its status was
    logged can be repeated. The pending hours are settled first: an hour whose input is
    logged while the job runs is neither computed nor logged as done. Returns them."""
    hours = settled(pending_hours(log))
    replace_runs(pings, hours, output, params)
    append_status(status_rows(done_events(hours)))
    return hours


def input_bytes(
    spark: SparkSession, path: str, hours: DataFrame, keys: Sequence[str], padded: bool = False
) -> DataFrame:
    """``n_bytes`` of the stored pings of each listed run, from the listing of its directories.
    ``padded`` says that the time parts of the directories have two characters."""
    filed = as_filed(hours) if padded else hours
    leaves = run_leaves(qualified(spark, path), filed.select(*RUN_KEYS), keys)
    kinds = dict(hours.dtypes)
    return leaves.groupBy(*[F.col(k).cast(kinds[k]).alias(k) for k in RUN_KEYS]).agg(
        F.sum("n_bytes").alias("n_bytes")
    )


def batches(hours: DataFrame, sizes: DataFrame, batch_bytes: int) -> DataFrame:
    """The listed runs with the number of their ``batch``, from 0: hours one after the other, all
    places of an hour together, as many as begin within ``batch_bytes`` of input. A run without
    input takes part with no bytes."""
    when = ["y", "m", "d", "h"]
    sized = hours.join(sizes.select(*RUN_KEYS, "n_bytes"), list(RUN_KEYS), "left")
    per_hour = sized.groupBy(*when).agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))
    # one row per hour of the calendar, so one task is enough for the running sum
    before = F.sum("n_bytes").over(Window.orderBy(*when)) - F.col("n_bytes")
    slot = F.floor(before / F.lit(batch_bytes))
    numbered = per_hour.withColumn("slot", slot).withColumn(
        "batch", (F.dense_rank().over(Window.orderBy("slot")) - 1).cast("int")
    )
    return sized.join(numbered.select(*when, "batch"), when).select(
        *hours.columns, F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"), "batch"
    )


def backfill_in_batches(
    pings: DataFrame,
    hours: DataFrame,
    log: DataFrame,
    output: str,
    append_status: Callable[[DataFrame], None],
    job: str,
    sizes: DataFrame,
    batch_bytes: int,
    params: MotionParams = DEFAULTS,
) -> DataFrame:
    """Compute the listed runs batch by batch; each is published and then logged under the name ``job``.

    Runs that the log has under this name are done and left alone, so a call after a failure
    carries on with the batch that failed, whatever other jobs have logged. The result is that of
    one job over all hours. Returns the runs of this call with their batch.
    """
    done = log.where((F.col("metadata") == job) & (F.col("status") == 1)).select("key", *TIME_PARTS).distinct()
    keyed = hours.withColumn("_key", task_key(RESULT_PREFIX, F.col("country"), F.col("stage")))
    same = (F.col("_key") == F.col("key")) & (F.col("y") == F.col("year")) & (F.col("m") == F.col("month"))
    same = same & (F.col("d") == F.col("day")) & (F.col("h") == F.col("hour"))
    todo = keyed.join(done, same, "left_anti").select(*hours.columns)
    plan = settled(batches(todo, sizes, batch_bytes))
    last = plan.agg(F.max("batch")).first()[0]
    for number in range(-1 if last is None else last + 1):
        part = plan.where(F.col("batch") == number)
        replace_runs(pings, part.select(*hours.columns), output, params)
        append_status(status_rows(done_events(part).withColumn("metadata", F.lit(job))))
    return plan
