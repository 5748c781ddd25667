"""The registered queries. Each reads whole tables and names every column it returns.

Speeds and angles are rounded to four places here, not in the library, because two engines
may differ in the last bits of a double.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingmotion.operators import status as st
from pingmotion.operators.buckets import (
    bucket_members,
    bucket_positions,
    trajectory_summary,
    with_time_bucket,
)
from pingmotion.operators.gates import (
    confident_pings,
    eligible_pings,
    gate_census,
    sentinel_pings,
)
from pingmotion.operators.trajectory import (
    short_trajectories,
    with_mean_turn_angle,
    with_neighbours,
    with_point_speed,
    with_segments,
    with_turn_angle,
)
from pingmotion.plans.catchup import (
    backfill,
    backfill_in_batches,
    catch_up,
    hour_range,
    input_bytes,
    replace_runs,
)
from pingmotion.plans.context import context_speed
from pingmotion.plans.motion import (
    as_stored,
    days_union,
    derived_speed,
    footprint_speed,
    request_speed,
    unmeasured_requests,
)
from pingmotion.schema import FOOTPRINT, ping_schema, result_schema
from pingmotion.settings import INPUT_PREFIX, RESULT_KEYS, RESULT_PREFIX, RUN_KEYS
from pingmotion.sources.orc import hour_slice, read_partitioned, write_partitioned
from pingmotion.sources.paths import constant_columns, read_slices
from pingmotion.sources.publish import read_published
from pingmotion.sources.scratch import new_folder
from pingmotion.sources.statuslog import append_rows, compact, read_compact
from pingmotion.sources.tables import (
    create_footprint_table,
    insert_partitions,
    name_result,
    read_days,
)

from . import inputs

BUCKET = (*RUN_KEYS, "uid", "sec")
PINGS = ping_schema(T.LongType(), T.LongType())
RESULTS = result_schema(T.LongType())


def _r(name: str, places: int = 4) -> Column:
    return F.round(name, places).alias(name)


def _decoded(stored: DataFrame) -> DataFrame:
    """Read the two numbers back from the stored JSON."""
    answer = F.from_json("derived_speed", "angle double, dspd double")
    return stored.select(
        "country",
        "request_id",
        *RESULT_KEYS,
        F.round(answer["dspd"], 4).alias("dspd"),
        F.round(answer["angle"], 4).alias("angle"),
    )


def _stored_pings(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = RUN_KEYS) -> DataFrame:
    path = new_folder(spark, "pings")
    write_partitioned(inputs.request_pings(spark, sf_dir), path, keys)
    return read_partitioned(spark, path, PINGS)


def _buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_positions(with_time_bucket(eligible_pings(inputs.pings(spark, sf_dir))))


# sources and sinks


def orc_roundtrip(spark, sf_dir):
    stored = _stored_pings(spark, sf_dir, ("country", *RESULT_KEYS))
    return stored.select(*[f.name for f in PINGS])


def hour_slice_query(spark, sf_dir):
    picked = hour_slice(_stored_pings(spark, sf_dir), 2024, 1, 1, 9, 1, "us")
    return picked.select("request_id", "uid", "r_timestamp", *RUN_KEYS)


def path_partitions(spark, sf_dir):
    path = new_folder(spark, "slices")
    levels = {
        "country": None,
        "logType": ["display", "display_dr", "euwest1", "exchange"],
        "y": None,
        "m": None,
        "d": None,
        "h": None,
        "isFilled": ["fill", "nf"],
        "confScore": ["pos", "rest", "tll"],
    }
    write_partitioned(inputs.request_pings(spark, sf_dir), path, tuple(levels))
    body = T.StructType([f for f in PINGS if f.name not in levels])
    read = read_slices(
        spark,
        path,
        {name: wanted and [f"{name}={v}" for v in wanted] for name, wanted in levels.items()},
        body,
        {k: "int" for k in ("y", "m", "d", "h")},
        named=levels,
    )
    return constant_columns(read, {"dt": "2024-01-01"}).select(
        "request_id", "uid", "stage", *levels, "dt"
    )


def context_hours(spark, sf_dir):
    answered = context_speed(inputs.request_pings(spark, sf_dir), offset=1)
    return answered.select("country", "request_id", *RESULT_KEYS, _r("dspd"), _r("angle"))


def context_hours_target(spark, sf_dir):
    """One hour with its neighbours in sight; only the directories of the three are read."""
    stored = _stored_pings(spark, sf_dir)
    answered = context_speed(stored, offset=1, target=datetime(2024, 1, 1, 9))
    return answered.select("country", "request_id", *RESULT_KEYS, _r("dspd"), _r("angle"))


def context_hours_wide(spark, sf_dir):
    """Six hours in sight on either side."""
    answered = context_speed(inputs.request_pings(spark, sf_dir), offset=6)
    return answered.select("country", "request_id", *RESULT_KEYS, _r("dspd"), _r("angle"))


def context_hours_wide_target(spark, sf_dir):
    answered = context_speed(_stored_pings(spark, sf_dir), offset=6, target=datetime(2024, 1, 1, 9))
    return answered.select("country", "request_id", *RESULT_KEYS, _r("dspd"), _r("angle"))


_POSITIONS: dict[str, list[str] | None] = {"country": ["us", "gb"], "isFilled": ["fill", "nf"], "confScore": None}


def _positional(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "positional")
    pings = inputs.request_pings(spark, sf_dir)
    for country in ("us", "gb"):
        for filled in ("fill", "nf"):
            for score in ("pos", "rest", "tll"):
                here = (
                    (F.col("country") == country)
                    & (F.col("isFilled") == filled)
                    & (F.col("confScore") == score)
                )
                pings.where(here).drop(*_POSITIONS).write.orc(f"{path}/{country}/{filled}/{score}")
    return path


def _read_positional(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    body = T.StructType([f for f in PINGS if f.name not in _POSITIONS])
    read = read_slices(spark, path, _POSITIONS, body, where=where)
    return read.select("request_id", "uid", "stage", *_POSITIONS)


def positional_slices(spark, sf_dir):
    """Directories that hold bare values: country / isFilled / confScore."""
    return _read_positional(spark, _positional(spark, sf_dir))


def positional_slices_filtered(spark, sf_dir):
    """Only the directories that a condition on their values leaves are read."""
    where = (F.col("isFilled") == "fill") & (F.col("confScore") != "rest")
    return _read_positional(spark, _positional(spark, sf_dir), where)


# gates


def confidence_gate(spark, sf_dir):
    return confident_pings(inputs.pings(spark, sf_dir)).select(
        "request_id", "uid", "sl_adjusted_confidence", *RUN_KEYS
    )


def eligible(spark, sf_dir):
    return eligible_pings(inputs.pings(spark, sf_dir)).select(
        "request_id", "uid", "r_timestamp", "latitude", "longitude", *RUN_KEYS
    )


def sentinel(spark, sf_dir):
    return _decoded(as_stored(unmeasured_requests(inputs.pings(spark, sf_dir))))


def sentinel_wide(spark, sf_dir):
    return sentinel_pings(inputs.pings(spark, sf_dir), wide=True).select(
        "country", "request_id", *RESULT_KEYS
    )


def census(spark, sf_dir):
    return gate_census(inputs.pings(spark, sf_dir))


# scalar rules


def zero_padded_keys(spark, sf_dir):
    stored = as_stored(unmeasured_requests(inputs.pings(spark, sf_dir)))
    return stored.select("request_id", "y", "m", "d", "h", "stage")


def time_buckets(spark, sf_dir):
    return with_time_bucket(inputs.pings(spark, sf_dir)).select(
        "request_id",
        "uid",
        "r_timestamp",
        "sec",
        F.round("latitude", 5).alias("lat5"),
        F.round("longitude", 5).alias("long5"),
    )


# buckets


def positions(spark, sf_dir):
    return _buckets(spark, sf_dir).select(*BUCKET, _r("lat", 7), _r("long", 7), "n_pings")


def members(spark, sf_dir):
    bucketed = with_time_bucket(eligible_pings(inputs.pings(spark, sf_dir)))
    return bucket_members(bucketed, ("request_id", *RESULT_KEYS))


def summary(spark, sf_dir):
    return trajectory_summary(_buckets(spark, sf_dir))


# windows


def short(spark, sf_dir):
    return short_trajectories(_buckets(spark, sf_dir))


def segments(spark, sf_dir):
    return with_segments(with_neighbours(_buckets(spark, sf_dir))).select(
        *BUCKET, _r("in_min"), _r("in_miles", 6), _r("in_raw"), _r("in_clip")
    )


def point_speed(spark, sf_dir):
    steps = with_segments(with_neighbours(_buckets(spark, sf_dir)))
    return with_point_speed(steps).select(*BUCKET, _r("dspd"))


def turn_angle(spark, sf_dir):
    return with_turn_angle(with_neighbours(_buckets(spark, sf_dir))).select(*BUCKET, _r("angle"))


def mean_turn_angle(spark, sf_dir):
    turned = with_turn_angle(with_neighbours(_buckets(spark, sf_dir)))
    return with_mean_turn_angle(turned).select(*BUCKET, _r("mean_angle"))


# end to end


def request_speed_query(spark, sf_dir):
    return request_speed(inputs.pings(spark, sf_dir)).select(
        "country", "request_id", *RESULT_KEYS, _r("dspd"), _r("angle")
    )


def derived_speed_hourly(spark, sf_dir):
    return _decoded(derived_speed(inputs.request_pings(spark, sf_dir)))


def derived_speed_days(spark, sf_dir):
    """Two days in one job; pings without uid are one device of each run."""
    return _decoded(derived_speed(inputs.two_day_pings(spark, sf_dir)))


def derived_speed_backfill(spark, sf_dir):
    hours = hour_range(spark, ["us"], range(4), date(2024, 1, 1), days=7)
    return _decoded(backfill(_stored_pings(spark, sf_dir), hours))


def _footprints(spark, sf_dir):
    """Place matches of one day's table with speed and angle, as the result table holds them."""
    tag = uuid.uuid4().hex[:8]
    name_result(inputs.footprint_pings(spark, sf_dir), f"day_pings_{tag}_240101")
    days = read_days(spark, "day_pings_" + tag + "_{yymmdd}", date(2024, 1, 1), 1)
    return footprint_speed(days_union(days))


def _flat_footprints(rows: DataFrame) -> DataFrame:
    match = F.col("fp")
    return rows.select("*", F.explode("fp_matches").alias("fp")).select(
        "dt",
        "hr",
        F.col("uid").cast("string").alias("uid"),
        match["proximity_mode"].alias("proximity_mode"),
        match["fp_brand"].alias("fp_brand"),
        match["is_poly"].alias("is_poly"),
        _r("dspd"),
        _r("angle"),
    )


def footprints(spark, sf_dir):
    return _flat_footprints(_footprints(spark, sf_dir))


def footprint_matches(spark, sf_dir):
    """None to three matches a ping, all ten fields, one row per match and one for none."""
    day = inputs.matched_pings(spark, sf_dir).withColumns({"dt": F.lit("2024-01-01"), "hr": F.col("hour")})
    rows = footprint_speed(day).select("*", F.posexplode_outer("fp_matches").alias("place", "fp"))
    fields = [f.name for f in FOOTPRINT]
    return rows.select(
        "dt",
        "hr",
        F.col("uid").cast("string").alias("uid"),
        F.coalesce(F.col("place") + 1, F.lit(0)).cast("int").alias("place"),
        *[F.col(f"fp.{name}").alias(name) for name in fields],
        _r("dspd"),
        _r("angle"),
    )


def table_insert(spark, sf_dir):
    table = f"footprint_speed_{uuid.uuid4().hex[:8]}"
    create_footprint_table(spark, table, new_folder(spark, "footprints"))
    insert_partitions(_footprints(spark, sf_dir), table)
    return _flat_footprints(spark.table(table))


# status log


def status_parse_time(spark, sf_dir):
    return st.with_time_parts(inputs.event_times(spark, sf_dir)).select(
        "event_id", "time", *st.TIME_PARTS
    )


def status_latest(spark, sf_dir):
    places = inputs.pings(spark, sf_dir).select("country", "stage").distinct()
    prefix = F.explode(F.array(F.lit(INPUT_PREFIX), F.lit(RESULT_PREFIX))).alias("prefix")
    tasks = places.select("*", prefix).withColumn(
        "key", st.task_key(F.col("prefix"), F.col("country"), F.col("stage"))
    )
    latest = st.latest_hours(inputs.status_log(spark, sf_dir))
    return tasks.join(latest, "key", "left").select(
        "country", "stage", "key", st.as_hour_text(F.col("latest")).alias("latest")
    )


def status_lookup(spark, sf_dir):
    log = inputs.status_log(spark, sf_dir)
    asked = inputs.event_times(spark, sf_dir)
    return st.lookup(log, asked, "status", "metadata").select(
        "event_id", "key", "time", "status", "metadata"
    )


def pending_hours(spark, sf_dir):
    return st.pending_hours(inputs.status_log(spark, sf_dir))


def status_head(spark, sf_dir):
    return st.status_head(inputs.status_log(spark, sf_dir))


def status_append(spark, sf_dir):
    path = new_folder(spark, "status")
    inputs.status_log(spark, sf_dir).write.orc(path)
    st.append_status(st.status_rows(inputs.event_times(spark, sf_dir)), path)
    return st.read_status(spark, path).select("key", *st.TIME_PARTS, "status", "metadata")


def catch_up_query(spark, sf_dir):
    stored = _stored_pings(spark, sf_dir)
    output, log = new_folder(spark, "results"), new_folder(spark, "status")
    inputs.hour_log(spark, sf_dir).write.orc(log)
    catch_up(
        stored, st.read_status(spark, log), output, lambda rows: st.append_status(rows, log)
    )
    return _decoded(read_partitioned(spark, output, RESULTS))


def pending_first_runs(spark, sf_dir):
    """Places without any result, and with daily results only."""
    return st.pending_hours(inputs.first_runs_log(spark, sf_dir))


def replay_hour(spark, sf_dir):
    """All hours, then hour 9 again after some of its requests were filed under another grade."""
    pings, output = inputs.request_pings(spark, sf_dir), new_folder(spark, "results")
    hours = pings.select("country", "stage", "y", "m", "d", "h").distinct()
    replace_runs(pings, hours, output)
    moved = F.when(F.expr("request_id % 7 = 0"), "moved").otherwise(F.col("confScore"))
    again = pings.where("h = 9").withColumn("confScore", moved)
    replace_runs(again, hours.where("h = 9"), output)
    return _decoded(read_partitioned(spark, output, RESULTS))


class _Killed(Exception):
    """Stands for a job that ends in the middle."""


def _killed_after(step: str) -> Callable[[str], None]:
    def on_step(done: str) -> None:
        if done == step:
            raise _Killed(step)

    return on_step


def publish_killed(spark, sf_dir):
    """All hours; then hours 9 and 10 with other grades, by one job that ends before its commit and
    one that ends right after it, so that the first leaves no trace and the second is visible."""
    pings, output = inputs.request_pings(spark, sf_dir), new_folder(spark, "results")
    hours = pings.select(*RUN_KEYS).distinct()
    replace_runs(pings, hours, output)
    moved = pings.withColumn("confScore", F.lit("moved"))
    for hour, step in ((9, "listed"), (10, "committed")):
        try:
            replace_runs(moved.where(F.col("h") == hour), hours.where(F.col("h") == hour), output, on_step=_killed_after(step))
        except _Killed:
            pass
    return _decoded(read_published(spark, output, RESULTS))


def backfill_batches(spark, sf_dir):
    """A backfill in batches of input that ends after the second one and is called again."""
    path, output, log = (new_folder(spark, name) for name in ("pings", "results", "status"))
    write_partitioned(inputs.request_pings(spark, sf_dir), path, RUN_KEYS)
    stored = read_partitioned(spark, path, PINGS)
    hours = hour_range(spark, ["us"], range(4), date(2024, 1, 1), days=7)
    sizes = input_bytes(spark, path, hours, RUN_KEYS)
    third = sizes.agg(F.sum("n_bytes")).first()[0] // 3
    inputs.hour_log(spark, sf_dir).write.orc(log)
    logged = []

    def append(rows: DataFrame) -> None:
        st.append_status(rows, log)
        logged.append(1)
        if len(logged) == 2:
            raise _Killed

    for _ in range(2):
        try:
            backfill_in_batches(
                stored, hours, st.read_status(spark, log), output, append, "backfill-1", sizes, third
            )
        except _Killed:
            pass
    return _decoded(read_partitioned(spark, output, RESULTS))


def status_lookup_any(spark, sf_dir):
    """The newest row for requests that leave out any parts, the key included."""
    found = st.lookup(
        inputs.status_log(spark, sf_dir), inputs.partial_times(spark, sf_dir), "status", "metadata"
    )
    return found.select("event_id", "key", "time", "status", "metadata")


def pending_hours_compacted(spark, sf_dir):
    """Pending hours from two snapshots, one on the other, and the days after them."""
    log = new_folder(spark, "status")
    append_rows(inputs.status_log(spark, sf_dir), log)
    compact(spark, log, date(2024, 1, 12))
    compact(spark, log, date(2024, 1, 25))
    return st.pending_hours(read_compact(spark, log))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orc_roundtrip": orc_roundtrip,
    "hour_slice": hour_slice_query,
    "path_partitions": path_partitions,
    "context_hours": context_hours,
    "confidence_gate": confidence_gate,
    "eligible_pings": eligible,
    "sentinel_pings": sentinel,
    "sentinel_pings_wide": sentinel_wide,
    "gate_census": census,
    "zero_padded_keys": zero_padded_keys,
    "time_buckets": time_buckets,
    "bucket_positions": positions,
    "bucket_members": members,
    "trajectory_summary": summary,
    "short_trajectories": short,
    "segments": segments,
    "point_speed": point_speed,
    "turn_angle": turn_angle,
    "mean_turn_angle": mean_turn_angle,
    "request_speed": request_speed_query,
    "derived_speed_hourly": derived_speed_hourly,
    "derived_speed_days": derived_speed_days,
    "derived_speed_backfill": derived_speed_backfill,
    "footprint_speed": footprints,
    "footprint_matches": footprint_matches,
    "table_insert": table_insert,
    "status_parse_time": status_parse_time,
    "status_latest": status_latest,
    "status_lookup": status_lookup,
    "pending_hours": pending_hours,
    "status_head": status_head,
    "status_append": status_append,
    "catch_up": catch_up_query,
    "context_hours_target": context_hours_target,
    "positional_slices": positional_slices,
    "pending_first_runs": pending_first_runs,
    "replay_hour": replay_hour,
    "publish_killed": publish_killed,
    "backfill_batches": backfill_batches,
    "status_lookup_any": status_lookup_any,
    "context_hours_wide": context_hours_wide,
    "context_hours_wide_target": context_hours_wide_target,
    "positional_slices_filtered": positional_slices_filtered,
    "pending_hours_compacted": pending_hours_compacted,
}
