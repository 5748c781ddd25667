"""The compacted status log answers as the whole log does, and reads only its tail."""

from __future__ import annotations

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pingmotion.operators import status as st
from pingmotion.schema import STATUS
from pingmotion.sources import statuslog


def random_log(spark, n, seed):
    rng = random.Random(seed)
    keys = ["ard/us/0/", "derived_speed/us/0/", "ard/gb/1/", "derived_speed/gb/1/", "ard/fr/0/", "odd", None]
    rows = []
    for i in range(n):
        stamp = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 40))
        parts = [2024, rng.choice([1, 2, 2, 13]), rng.randrange(1, 31), rng.randrange(24)]
        for cut in range(rng.choice([0, 0, 0, 1, 2, 4])):
            parts[3 - cut] = None
        rows.append((i, stamp, rng.choice(keys), *parts, 1, None))
    return spark.createDataFrame(rows, STATUS)


def answers(log):
    latest = sorted(map(str, map(tuple, st.latest_hours(log).collect())))
    return latest, sorted(map(tuple, st.pending_hours(log).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_compacted_log_equals_the_whole(spark, tmp_path, seed):
    path = str(tmp_path / "log")
    log = random_log(spark, 400, seed)
    statuslog.append_rows(log, path)
    want = answers(log)
    assert answers(statuslog.read_all(spark, path)) == want
    assert answers(statuslog.read_compact(spark, path)) == want
    for day in (date(2024, 1, 5), date(2024, 1, 20), date(2024, 3, 1)):
        statuslog.compact(spark, path, day)
        assert answers(statuslog.read_compact(spark, path)) == want
    assert statuslog.snapshots(spark, path) == ["2024-01-05", "2024-01-20", "2024-03-01"]
    later = random_log(spark, 50, seed + 10).withColumn("timestamp", F.lit(datetime(2024, 3, 2)).cast("timestamp_ntz"))
    statuslog.append_rows(later, path)
    assert answers(statuslog.read_compact(spark, path)) == answers(log.unionByName(later))


def test_only_the_snapshot_and_the_tail_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    statuslog.append_rows(random_log(spark, 300, 3), path)
    statuslog.compact(spark, path, date(2024, 2, 1))
    plan = st.pending_hours(statuslog.read_compact(spark, path))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "appended#" in text.split("PartitionFilters:")[1] or "appended" in text
    tail = statuslog.read_compact(spark, path)
    used = {r[0] for r in tail.select(F.input_file_name()).distinct().collect()}
    days = {f.split("appended=")[1][:10] for f in used if "appended=" in f}
    assert days and min(days) >= "2024-02-01" and any("snapshots/upto=2024-02-01" in f for f in used)
    # a month of events has two rows a key at most
    snapshot = spark.read.schema(STATUS).orc(f"{path}/snapshots/upto=2024-02-01")
    assert snapshot.groupBy("key", "year", "month").count().where("count > 2").count() == 0


def test_a_snapshot_without_its_end_is_not_used(spark, tmp_path):
    path = str(tmp_path / "log")
    log = random_log(spark, 100, 4)
    statuslog.append_rows(log, path)
    statuslog.compact(spark, path, date(2024, 1, 10))
    statuslog.compact(spark, path, date(2024, 1, 20))
    os.unlink(f"{path}/snapshots/upto=2024-01-20/_SUCCESS")
    assert statuslog.snapshots(spark, path) == ["2024-01-10"]
    assert answers(statuslog.read_compact(spark, path)) == answers(log)
    statuslog.compact(spark, path, date(2024, 1, 20))
    assert answers(statuslog.read_compact(spark, path)) == answers(log)


def test_days_that_are_not_over_are_not_compacted(spark, tmp_path):
    with pytest.raises(ValueError, match="not over"):
        statuslog.compact(spark, str(tmp_path / "log"), date(9999, 1, 1))
    assert statuslog.read_compact(spark, str(tmp_path / "log")).count() == 0
