"""Known counts of the derived inputs at sf0.01 and how the rows divide."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import inputs
from pingmotion import derived_speed
from pingmotion.operators.buckets import bucket_positions, with_time_bucket
from pingmotion.operators.gates import eligible_pings, gate_census
from pingmotion.operators.trajectory import bucket_motion, short_trajectories

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pings(spark):
    return inputs.request_pings(spark, SF).cache()


def test_gate_counts(pings):
    total = gate_census(pings).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_eligible", "n_sentinel", "n_null_gate", "n_low_confidence")]
    ).collect()[0]
    assert tuple(total) == (10_200, 6_808, 1_314, 78, 2_000)
    assert total.n_rows == sum(total[1:])


def test_bucket_and_result_counts(pings):
    buckets = bucket_positions(with_time_bucket(eligible_pings(pings)))
    assert buckets.count() == 6_619
    assert short_trajectories(buckets).count() == 137
    motion = bucket_motion(buckets)
    assert motion.where("dspd >= 0").count() == 5_611
    assert motion.where("angle >= 0").count() == 1_333
    assert derived_speed(pings).count() == 1_314 + 6_643


def test_status_counts(spark):
    from pingmotion.operators.status import pending_hours

    log = inputs.status_log(spark, SF)
    assert log.count() == 13_162
    assert pending_hours(log).count() == 149
