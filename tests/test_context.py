"""Context hours: the plan without copies against the plan with them, and its size."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from pingmotion.plans import context
from pingmotion.settings import MotionParams

from .test_pipeline import as_set, frame, ping


DAY_MS = 1_539_043_200_000  # 2018-10-09, the day that the pings are filed under


def strewn(seed, stray):
    """Devices over six hours, most buckets near the turn of an hour, some pings without a position or
    uid; with ``stray`` a few are filed under another hour than that of their time."""
    rng, rows = random.Random(seed), []
    for i in range(500):
        hour = rng.randrange(3, 9)
        second = rng.choice([rng.randrange(3600), rng.randrange(20), 3599 - rng.randrange(12), 3598])
        filed = hour + (rng.choice([-1, 1, 2]) if stray and rng.random() < 0.03 else 0)
        device = rng.choice(["a", "b", "c", "d", "e", "f", None])
        row = ping(str(i), hour * 3600 + second, 40.0 + rng.randrange(200) * 1e-4, h=filed)
        row = list(row)
        row[1] = device
        row[2] += DAY_MS
        if rng.random() < 0.05 and (stray or 30 < second < 3500):
            row[3] = None
        rows.append(tuple(row))
    return rows


@pytest.mark.parametrize("offset", [1, 2, 6])
@pytest.mark.parametrize("stray", [False, True])
def test_without_copies_equals_with_copies(spark, monkeypatch, offset, stray):
    df = frame(spark, strewn(offset, stray))
    for target in (None, datetime(2018, 10, 9, 5)):
        got = as_set(context.context_speed(df, offset, target))
        if not stray:
            with monkeypatch.context() as m:
                m.setattr(context, "_copied", None)  # not used
                context.context_speed(df, offset, target)
        with monkeypatch.context() as m:
            m.setattr(context, "_stray", lambda: context.F.lit(True))
            want = as_set(context.context_speed(df, offset, target))
        assert got == want and len(got) > 20
        assert any(row[-2] > 0 for row in got) and any(row[-1] > 0 for row in got)


def test_a_short_reach_keeps_the_copies(spark, monkeypatch):
    df = frame(spark, strewn(9, False))
    params = MotionParams(upper_min=90.0)
    monkeypatch.setattr(context, "_framed", None)
    assert context.context_speed(df, 1, params=params).count() > 100


def test_the_window_does_not_grow_with_the_reach(spark):
    df = frame(spark, strewn(3, False))
    plans = {}
    for offset in (1, 6):
        plan = context.context_speed(df, offset)._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(" not in plan
        plans[offset] = (plan.count("Window ["), plan.count("Generate "))
    assert plans[1] == plans[6]
