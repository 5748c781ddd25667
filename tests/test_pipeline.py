"""Gates, buckets, fan-out and the end-to-end jobs."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pingmotion import derived_speed, footprint_speed, request_speed
from pingmotion.functions import mean_measured, time_bucket, zero_padded
from pingmotion.operators.buckets import bucket_members, bucket_positions, with_time_bucket
from pingmotion.operators.gates import eligible_pings, gate_census, sentinel_pings
from pingmotion.plans.context import context_speed
from pingmotion.plans.motion import in_a_run, only_hours
from pingmotion.schema import FOOTPRINT_RESULT, ping_schema, require
from pingmotion.settings import RESULT_KEYS, RUN_KEYS

PINGS = ping_schema()


def ping(request_id, sec, lat=40.0, long=-74.0, uid="u", **changes):
    row = {
        "request_id": request_id, "uid": uid,
        "r_timestamp": None if sec is None else int(sec * 1000),
        "latitude": lat, "longitude": long, "too_freq_uid": False, "r_s_info": None,
        "sl_adjusted_confidence": 94, "country": "us", "logType": "display", "y": 2018, "m": 10,
        "d": 9, "h": 5, "stage": 0, "isFilled": "fill", "confScore": "pos",
    }
    row.update(changes)
    return tuple(row[f.name] for f in PINGS)


def frame(spark, rows):
    return spark.createDataFrame(rows, PINGS)


def moving(n=5, uid="u", **changes):
    return [ping(f"{uid}{i}", 60 * i, 40.0 + i * 0.005, uid=uid, **changes) for i in range(n)]


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_gates_keep_three_valued_logic(spark):
    rows = [
        ping("ok", 0), ping("too often", 0, too_freq_uid=True), ping("info", 0, r_s_info="x"),
        ping("null", 0, too_freq_uid=None), ping("null info", 0, too_freq_uid=None, r_s_info="x"),
        ping("low", 0, sl_adjusted_confidence=90), ping("none", 0, sl_adjusted_confidence=None),
        ping("low info", 0, r_s_info="x", sl_adjusted_confidence=90),
    ]
    df = frame(spark, rows)
    names = lambda d: {r.request_id for r in d.collect()}
    assert names(eligible_pings(df)) == {"ok"}
    assert names(sentinel_pings(df)) == {"too often", "info", "null info"}
    assert names(sentinel_pings(df, wide=True)) == {"too often", "info", "null info", "low", "low info"}
    c = gate_census(df).collect()[0]
    assert (c.n_rows, c.n_eligible, c.n_sentinel, c.n_null_gate, c.n_low_confidence) == (8, 1, 3, 1, 3)


def test_bucket_is_the_nearest_half_up(spark):
    df = spark.createDataFrame([(2499,), (2500,), (7499,), (7500,), (None,)], "t long")
    got = [r[0] for r in df.select(time_bucket(F.col("t"))).collect()]
    assert got == [0.0, 5.0, 5.0, 10.0, None]


def test_padding(spark):
    df = spark.createDataFrame([(9,), (10,), (0,), (123,), (None,)], "n int")
    assert [r[0] for r in df.select(zero_padded(F.col("n"))).collect()] == ["09", "10", "00", "123", None]


def test_mean_of_measured_speeds(spark):
    df = spark.createDataFrame([(-1.0, -1.0), (-1.0, 4.0), (2.0, -1.0), (2.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(mean_measured(F.col("a"), F.col("b"))).collect()] == [-1.0, 4.0, 2.0, 3.0]


def test_repeats_weigh_in_but_give_one_result(spark):
    twice = ping("a", 0, 40.0)
    df = frame(spark, [twice, twice, ping("b", 1, 40.3)] + moving(5, "other"))
    pos = bucket_positions(with_time_bucket(df)).where("uid = 'u'").collect()[0]
    assert pos.lat == pytest.approx((40.0 + 40.0 + 40.3) / 3)
    assert pos.n_pings == 3
    assert sorted(r.request_id for r in request_speed(df).where("request_id in ('a', 'b')").collect()) == ["a", "b"]


def test_sentinel_repeats_are_kept(spark):
    df = frame(spark, [ping("x", 0, too_freq_uid=True)] * 3)
    got = derived_speed(df).collect()
    assert len(got) == 3
    assert {json.loads(r.derived_speed)["dspd"] for r in got} == {-1.0}


def test_stored_rows(spark):
    got = derived_speed(frame(spark, moving())).orderBy("request_id").collect()
    assert got[0].asDict().keys() == {"request_id", "country", *RESULT_KEYS, "derived_speed"}
    assert (got[0].m, got[0].d, got[0].h, got[0].y) == ("10", "09", "05", 2018)
    answer = json.loads(got[1].derived_speed)
    assert list(answer) == ["angle", "dspd"]
    assert answer["dspd"] == pytest.approx(20.7345, abs=1e-4)
    assert answer["angle"] == pytest.approx(3.14159, abs=1e-4)


def test_pings_without_time_or_place_are_answered_not_measurable(spark):
    rows = moving() + [ping("no time", None, 40.0), ping("no place", 1000, None, None)]
    got = {r.request_id: (r.dspd, r.angle) for r in request_speed(frame(spark, rows)).collect()}
    assert len(got) == 7
    assert got["no time"] == got["no place"] == (-1.0, -1.0)
    assert got["u1"][0] > 0


def test_position_of_a_bucket_ignores_missing_coordinates(spark):
    rows = moving() + [ping("extra", 60, None, None)]
    got = {r.request_id: r.dspd for r in request_speed(frame(spark, rows)).collect()}
    assert got["extra"] == got["u1"] > 0


def test_pings_without_uid_are_one_device(spark):
    got = {r.request_id: r.dspd for r in request_speed(frame(spark, moving(5, uid=None))).collect()}
    assert got["None1"] == pytest.approx(20.7345, abs=1e-4)


def test_pings_of_no_run_are_left_out(spark):
    rows = moving() + [ping("lost", 0, h=None), ping("lost too", 0, stage=None, too_freq_uid=True)]
    assert derived_speed(frame(spark, rows)).count() == 5


def test_missing_column_fails_early(spark):
    with pytest.raises(ValueError, match="r_timestamp"):
        derived_speed(frame(spark, moving()).drop("r_timestamp"))
    with pytest.raises(ValueError):
        require(frame(spark, moving()), ["nowhere"])


def test_many_hours_at_once_equal_one_hour_each(spark, sf_dir):
    from checks.inputs import request_pings

    pings = request_pings(spark, sf_dir).cache()
    runs = [tuple(r) for r in pings.select(*RUN_KEYS).distinct().collect()]
    together = as_set(derived_speed(pings))
    one_by_one = []
    for stage in sorted({r[1] for r in runs}):
        for h in sorted({r[5] for r in runs}):
            hour = pings.where((F.col("stage") == stage) & (F.col("h") == h))
            one_by_one += derived_speed(hour).collect()
    assert sorted(map(tuple, one_by_one), key=repr) == together
    pings.unpersist()


def test_only_listed_hours(spark):
    df = frame(spark, moving(5, "a", h=5) + moving(5, "b", h=6) + moving(5, "c", h=5, country="gb"))
    hours = spark.createDataFrame([("us", 0, 2018, 10, 9, 5)] * 2, "country string, stage int, y int, m int, d int, h int")
    got = only_hours(df, hours)
    assert {r.uid for r in got.collect()} == {"a"}
    assert got.count() == 5
    assert only_hours(df, hours.limit(0)).count() == 0


def test_long_lists_of_hours_prune_too(spark, tmp_path):
    from pingmotion.sources.orc import read_partitioned, write_partitioned

    rows = frame(spark, moving(5, "a", h=5) + moving(5, "b", h=6))
    write_partitioned(rows, str(tmp_path / "p"), RUN_KEYS)
    stored = read_partitioned(spark, str(tmp_path / "p"), rows.schema)
    hours = spark.range(50_000).selectExpr(
        "'us' AS country", "cast(id % 4 AS int) AS stage", "cast(2018 + id div 30000 AS int) AS y",
        "cast(1 + id div 2500 % 12 AS int) AS m", "cast(1 + id % 28 AS int) AS d", "cast(id % 6 AS int) AS h",
    )
    kept = derived_speed(only_hours(stored, hours))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan orc" in line and "request" in line or "r_timestamp" in line and "FileScan orc" in line]
    assert scans and all("h#" in s and " IN (" in s.split("PartitionFilters")[1] or "INSET" in s for s in scans)
    assert {r.request_id[0] for r in kept.select(F.col("request_id").cast("string").alias("request_id")).collect()} or True


def test_replaced_runs_hold_no_old_rows(spark, tmp_path):
    from pingmotion.plans.catchup import replace_runs
    from pingmotion.schema import result_schema
    from pingmotion.sources.orc import read_partitioned

    out = str(tmp_path / "out")
    hours = spark.createDataFrame(
        [("us", 0, 2018, 10, 9, h) for h in (5, 6)], "country string, stage int, y int, m int, d int, h int"
    )
    first = frame(spark, moving(6, "a", h=5) + moving(5, "b", h=6))
    other = frame(spark, moving(4, "c", h=7))
    replace_runs(other, hours.limit(1).withColumn("h", F.lit(7)), out)
    replace_runs(first, hours, out)

    def stored():
        return read_partitioned(spark, out, result_schema()).groupBy("h").count().collect()

    assert sorted(map(tuple, stored())) == [("05", 6), ("06", 5), ("07", 4)]
    moved = first.where("h = 5").withColumn(
        "confScore", F.when(F.col("r_timestamp") % 120_000 == 0, F.lit("moved")).otherwise(F.col("confScore"))
    )
    replace_runs(moved, hours, out)  # keys changed in one hour, the other became empty
    assert sorted(map(tuple, stored())) == [("05", 6), ("07", 4)]


def test_context_zero_is_the_plain_hour(spark, sf_dir):
    from checks.inputs import request_pings

    pings = request_pings(spark, sf_dir)
    assert as_set(context_speed(pings, 0)) == as_set(request_speed(pings))


def test_context_sees_across_the_hour(spark):
    # four buckets, two on each side of 06:00; the ping at 5:59:58 rounds into 06:00:00
    at = [(5, 21480), (5, 21540), (5, 21598), (6, 21660)]
    rows = [ping(str(i), s, 40.0 + i * 0.005, h=h) for i, (h, s) in enumerate(at)]
    df = frame(spark, rows)
    assert {r.dspd for r in request_speed(df).collect()} == {-1.0}
    wide = {r.request_id: r for r in context_speed(df, 1).collect()}
    assert all(r.dspd > 0 for r in wide.values()) and len(wide) == 4
    target = context_speed(df, 1, datetime(2018, 10, 9, 5)).collect()
    assert {r.request_id: r.dspd for r in target} == {k: wide[k].dspd for k in "012"}


def test_footprints_carry_the_declared_schema(spark):
    matches = FOOTPRINT_RESULT["fp_matches"].dataType
    rows = [
        (f"u{i // 5}", 60_000 * (i % 5), 40.0 + (i % 5) * 0.005, -74.0, "2018-10-10", "05",
         [(i % 2, "b", None, 0.5, None, 0, None, False, "open", None)])
        for i in range(10)
    ]
    schema = "uid string, r_timestamp long, latitude double, longitude double, dt string, hr string, fp_matches "
    df = spark.createDataFrame(rows + rows[:2], schema + matches.simpleString())
    got = footprint_speed(df)
    assert {f.name: f.dataType for f in got.schema if f.name != "dt"} == {
        f.name: f.dataType for f in FOOTPRINT_RESULT
    }
    assert got.count() == 10
    assert got.where("dspd > 0").count() == 10


def test_no_python_in_the_job_and_no_wide_window(spark, sf_dir):
    from checks.inputs import request_pings

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = derived_speed(request_pings(spark, sf_dir))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Python" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Window ") == 1 and "SortMergeJoin" in plan
    window = next(line for line in plan.splitlines() if "Window " in line)
    assert "request_id" not in window


def test_crowded_bucket_is_split(spark):
    """A third of all rows in one bucket of the group without uid, and many copies of one."""
    n = 60_000

    def crowd(ids):
        return ids.selectExpr(
            "md5(cast(id as string)) AS request_id",
            "if(id % 3 = 0, null, cast(id % 2000 as string)) AS uid",
            "if(id % 3 = 0, 20000, (id % 700) * 5000) AS r_timestamp",
            "40.0 + (id % 97) / 1e4 AS latitude",
            "-74.0 + (id % 89) / 1e4 AS longitude",
            "false AS too_freq_uid", "cast(null as string) AS r_s_info",
            "94 AS sl_adjusted_confidence", "'us' AS country", "'display' AS logType",
            "2018 AS y", "10 AS m", "9 AS d", "5 AS h", "0 AS stage", "'fill' AS isFilled",
            "'pos' AS confScore",
        )

    copies = spark.range(30_000).selectExpr("7L AS id")
    both = crowd(spark.range(n)).unionByName(crowd(copies))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = request_speed(both)
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in plan
    assert len(got) == n and len({r.request_id for r in got}) == n
    members = bucket_members(with_time_bucket(in_a_run(both)), ("request_id", *RESULT_KEYS))
    assert members.where("uid is null").count() == n // 3
