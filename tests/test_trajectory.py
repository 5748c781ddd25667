"""Trajectory rules: goldens, edges, a sequential walk and properties."""

from __future__ import annotations

import random
from math import pi

import pytest
from pyspark.sql import functions as F

from pingmotion.functions import round_half_up
from pingmotion.operators.trajectory import (
    bucket_motion,
    with_mean_turn_angle,
    with_neighbours,
    with_point_speed,
    with_segments,
    with_turn_angle,
)
from pingmotion.settings import MotionParams

from .walk import walk

KEYS = ("run",)
SCHEMA = "run string, uid string, sec double, lat double, long double"

# FIXTURES.md section 3: uid, sec, lat, long, raw, speed, angle, mean
GOLDENS = [
    ("A", 0, 40.0, -74.0, None, 31.7671, -1.0, -1.0),
    ("A", 60, 40.0, -73.99, 31.7671, 26.2508, 1.5708, 1.5708),
    ("A", 180, 40.01, -73.99, 20.7345, 10.3672, -1.0, 1.5708),
    ("A", 480, 40.01, -73.99, 0.0, 0.0, -1.0, -1.0),
    ("A", 2000, 40.02, -73.98, 2.0619, -1.0, -1.0, -1.0),
    ("A", 2060, 40.1, -73.98, 331.752, 20.7345, 3.1416, 3.1416),
    ("A", 2120, 40.105, -73.98, 20.7345, 20.7345, -1.0, -1.0),
    ("B", 0, 40.0, -74.0, None, 20.7345, -1.0, -1.0),
    ("B", 60, 40.005, -74.0, 20.7345, 82.938, 3.1416, 2.7489),
    ("B", 120, 40.04, -74.0, 145.1415, 26.1131, 2.3562, 2.7489),
    ("B", 180, 40.045, -74.005, 26.1131, 26.1131, -1.0, -1.0),
    ("C", 0, 40.0, -74.0, None, -1.0, -1.0, -1.0),
    ("C", 60, 40.005, -74.0, 20.7345, -1.0, -1.0, -1.0),
    ("C", 120, 40.04, -74.0, 145.1415, -1.0, -1.0, -1.0),
]


def buckets(spark, rows):
    return spark.createDataFrame([("r", u, float(s), a, o) for u, s, a, o in rows], SCHEMA)


def measured(df, params=MotionParams()):
    steps = with_segments(with_neighbours(df, KEYS), params)
    out = with_turn_angle(with_point_speed(steps, params), params)
    rows = with_mean_turn_angle(out, KEYS, params).collect()
    return {(r.uid, r.sec): r for r in rows}


def test_goldens(spark):
    got = measured(buckets(spark, [g[:4] for g in GOLDENS]))
    for uid, sec, _, _, raw, speed, angle, mean in GOLDENS:
        r = got[uid, float(sec)]
        assert (None if r.in_raw is None else round(r.in_raw, 4)) == raw
        assert (round(r.dspd, 4), round(r.angle, 4), round(r.mean_angle, 4)) == (speed, angle, mean)


def random_rows(seed, devices=40):
    rng = random.Random(seed)
    rows = []
    for d in range(devices):
        secs = sorted(rng.sample(range(0, 720), rng.choice([1, 3, 4, 5, 20, 60])))
        lat, lon = 40.0, -74.0
        for s in secs:
            if rng.random() < 0.8:
                lat += rng.uniform(-0.004, 0.004)
                lon += rng.uniform(-0.004, 0.004)
            rows.append((f"d{d}", s * 5, lat, lon))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_sequential_walk(spark, seed):
    rows = random_rows(seed)
    got = measured(buckets(spark, rows))
    assert len(got) == len(rows)
    for uid in {r[0] for r in rows}:
        want = walk([(float(s), a, o) for u, s, a, o in rows if u == uid])
        for sec, (speed, angle, mean) in want.items():
            r = got[uid, sec]
            assert r.dspd == pytest.approx(speed, abs=1e-6)
            assert r.angle == pytest.approx(angle, abs=1e-6)
            assert r.mean_angle == pytest.approx(mean, abs=1e-6)


def test_other_parameters_equal_sequential_walk(spark):
    rows = random_rows(3, devices=15)
    got = measured(buckets(spark, rows), MotionParams(upper_min=2, thres_s=62.5, cap_mph=60, min_points=3))
    for uid in {r[0] for r in rows}:
        want = walk([(float(s), a, o) for u, s, a, o in rows if u == uid], 2, 62.5, 60, 3)
        for sec, (speed, angle, mean) in want.items():
            r = got[uid, sec]
            assert (r.dspd, r.angle, r.mean_angle) == pytest.approx((speed, angle, mean), abs=1e-6)


def test_ranges_and_order_independence(spark):
    rows = random_rows(4)
    a = measured(buckets(spark, rows))
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    b = measured(buckets(spark, shuffled).repartition(7))
    for key, r in a.items():
        assert r.dspd == -1 or 0 <= r.dspd < 100
        assert r.angle == -1 or 0 <= r.angle <= pi
        assert (r.dspd, r.angle, r.mean_angle) == (b[key].dspd, b[key].angle, b[key].mean_angle)


def test_reversed_time_keeps_the_angle(spark):
    rows = random_rows(5, devices=10)
    a = measured(buckets(spark, rows))
    b = measured(buckets(spark, [(u, 3600 - s, la, lo) for u, s, la, lo in rows]))
    for (uid, sec), r in a.items():
        assert b[uid, 3600 - sec].angle == pytest.approx(r.angle, abs=1e-9)


def line(uid, secs, step=0.001):
    return [(uid, s, 40.0 + i * step, -74.0) for i, s in enumerate(secs)]


def test_reach_of_the_angle_is_inclusive(spark):
    got = measured(buckets(spark, line("in", [0, 300, 600, 605]) + line("out", [0, 305, 600, 605])))
    assert got["in", 300.0].angle == pytest.approx(pi)
    assert got["out", 305.0].angle == -1.0


def test_gap_limit_is_exclusive(spark):
    got = measured(buckets(spark, line("at", [0, 1200, 1205, 1210]) + line("below", [0, 1195, 1200, 1205])))
    assert got["at", 0.0].dspd == -1.0
    assert got["below", 0.0].dspd > 0


def test_standing_still(spark):
    got = measured(buckets(spark, line("s", [0, 60, 120, 180], step=0.0)))
    assert {(r.dspd, r.angle) for r in got.values()} == {(0.0, -1.0)}


def test_full_reversal_is_angle_zero(spark):
    rows = [("v", s, 40.0 + d, -74.0) for s, d in ((0, 0.0), (60, 0.005), (120, 0.0), (180, 0.005))]
    got = measured(buckets(spark, rows))
    assert got["v", 60.0].angle == 0.0


def test_missing_and_nan_positions(spark):
    nan = float("nan")
    rows = line("a", [0, 60, 120, 180]) + [("a", 240, None, -74.0), ("a", 300, nan, nan)]
    df = buckets(spark, rows).unionByName(
        spark.createDataFrame([("r", "a", None, 40.0, -74.0)], SCHEMA)
    )
    got = {r.sec: r for r in bucket_motion(df, KEYS).collect()}
    assert sorted(got) == [0.0, 60.0, 120.0, 180.0, 300.0]
    assert got[300.0].dspd == -1.0
    assert got[180.0].angle == -1.0
    assert got[60.0].angle == pytest.approx(pi)


def test_devices_without_uid_are_one_trajectory(spark):
    got = measured(buckets(spark, line(None, [0, 60, 120, 180])))
    assert got[None, 60.0].dspd > 0


def test_runs_do_not_see_each_other(spark):
    rows = [("r1" if s < 120 else "r2", "u", float(s), 40.0 + s / 1e5, -74.0) for s in range(0, 240, 60)]
    got = bucket_motion(spark.createDataFrame(rows, SCHEMA), KEYS).collect()
    assert {r.dspd for r in got} == {-1.0}


def test_fast_rounding_equals_round(spark):
    rng = random.Random(9)
    values = [rng.uniform(-180, 180) for _ in range(3000)]
    values += [round(v, 5) + 5e-6 for v in values[:500]] + [-(round(v, 5) + 5e-6) for v in values[:500]]
    values += [0.0, -1e-7, 5e-6, -5e-6, 40.030035, 1e300, -1e300, float("inf"), 2.5, 1e13 + 0.5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    for places in (0, 5):
        off = df.where(~round_half_up(F.col("x"), places).eqNullSafe(F.round("x", places)))
        assert off.count() == 0


def test_one_exchange_and_one_window_for_speed_and_angle(spark):
    plan = bucket_motion(buckets(spark, line("a", [0, 5, 10, 15])), KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan
