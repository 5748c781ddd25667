"""The whole job against the rules applied one after the other to a small table."""

from __future__ import annotations

import json
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from checks import inputs
from pingmotion import MotionParams, derived_speed, footprint_speed
from pingmotion.settings import RESULT_KEYS, RUN_KEYS

from .walk import r5, walk


def bucket(ms, width):
    return float((Decimal(ms) / Decimal(1000 * width)).quantize(Decimal(1), ROUND_HALF_UP) * width)


def measured(rows, run, member, width=5, **rules):
    """Set of (run, uid, sec, member) with speed and angle."""
    places, members = defaultdict(list), set()
    for r in rows:
        sec = bucket(r.r_timestamp, width)
        device = (*[r[k] for k in run], r.uid)
        places[device, sec].append((r5(r.latitude), r5(r.longitude)))
        members.add((device, sec, member(r)))
    paths = defaultdict(list)
    for (device, sec), at in places.items():
        paths[device].append((sec, sum(a for a, _ in at) / len(at), sum(o for _, o in at) / len(at)))
    answers = {device: walk(points, **rules) for device, points in paths.items()}
    return [(device, m, *answers[device][sec][:2]) for device, sec, m in members]


def same(got, want):
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    assert len(got) == len(want)
    # rows are equal up to their two numbers; compare these with a tolerance
    assert [g[:-2] for g in got] == [w[:-2] for w in want]
    by_key = defaultdict(lambda: ([], []))
    for side, rows in ((0, got), (1, want)):
        for r in rows:
            by_key[r[:-2]][side].append(r[-2:])
    for a, b in by_key.values():
        for x, y in zip(sorted(a), sorted(b)):
            assert x == pytest.approx(y, abs=1e-6)


@pytest.mark.parametrize(
    "params", [MotionParams(), MotionParams(upper_min=5, lower_s=10, thres_s=120, cap_mph=50, min_points=6)]
)
@pytest.mark.parametrize("wide", [False, True])
def test_hourly_job(spark, sf_dir, params, wide):
    pings = inputs.request_pings(spark, sf_dir)
    rows = pings.collect()
    usable = [r for r in rows if r.sl_adjusted_confidence in (94, 95)]
    clean = [r for r in usable if r.too_freq_uid is False and r.r_s_info is None]
    key = lambda r: (r.country, r.request_id, *[r[k] for k in RESULT_KEYS])
    want = [
        (*m, s, a)
        for _, m, s, a in measured(
            clean, RUN_KEYS, key, int(params.lower_s), upper=params.upper_min,
            thres=params.thres_s, cap=params.cap_mph, shortest=params.min_points,
        )
    ]
    flagged = [r for r in rows if r.too_freq_uid is True or r.r_s_info is not None or (wide and r not in usable)]
    want += [(*key(r), -1.0, -1.0) for r in flagged if wide or r in usable]
    got = []
    for r in derived_speed(pings, params, wide).collect():
        answer = json.loads(r.derived_speed)
        parts = [int(r[k]) if k in ("m", "d", "h") else r[k] for k in RESULT_KEYS]
        got.append((r.country, r.request_id, *parts, answer["dspd"], answer["angle"]))
    same(got, want)


def test_footprints(spark, sf_dir):
    pings = inputs.footprint_pings(spark, sf_dir).withColumns({"dt": F.lit("2024-01-01"), "hr": F.col("hour")})
    flat = lambda r: tuple(map(tuple, r.fp_matches))
    want = [
        (*device, m, s, a)
        for device, m, s, a in measured(pings.collect(), ("dt", "hr"), flat)
    ]
    got = [(r.dt, r.hr, r.uid, flat(r), r.dspd, r.angle) for r in footprint_speed(pings).collect()]
    same(got, want)


def test_hour_range(spark):
    from datetime import date

    from pingmotion.plans.catchup import hour_range

    got = hour_range(spark, ["us", "gb"], range(4), date(2018, 10, 10), 7)
    assert got.count() == got.distinct().count() == 2 * 4 * 7 * 24
    last = got.orderBy(F.desc("time")).first()
    assert (last.time, last.y, last.m, last.d, last.h) == ("2018-10-16-23", 2018, 10, 16, 23)
