"""Status log."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pingmotion.operators import status as st
from pingmotion.plans.catchup import catch_up
from pingmotion.schema import STATUS, result_schema
from pingmotion.sources import scratch
from pingmotion.sources.orc import read_partitioned

T0 = datetime(2018, 1, 1)


def log(spark, rows):
    full = [
        (i, datetime(2018, 1, 1, 0, i), key, *when, status, meta)
        for i, (key, when, status, meta) in enumerate(rows)
    ]
    return spark.createDataFrame(full, STATUS)


def ask(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, time string")


def test_parse_time(spark):
    texts = ["2017/01/22/11", "2017-01-22", "2017 01", "", None, "2017:01:22:11", "2018-10-10 05", "2017-x", "2017/01/"]
    df = st.with_time_parts(spark.createDataFrame([(t,) for t in texts], "time string"))
    got = [tuple(r)[1:] for r in df.collect()]
    n = None
    assert got == [
        (2017, 1, 22, 11), (2017, 1, 22, n), (2017, 1, n, n), (n, n, n, n), (n, n, n, n),
        (2017, 1, 22, 11), (2018, 10, 10, 5), (2017, n, n, n), (2017, 1, n, n),
    ]


def test_lookup_matches_the_parts_given_and_newest_wins(spark):
    df = log(spark, [
        ("k", (2017, 1, 22, 11), 1, "first"),
        ("k", (2017, 1, 22, 11), 2, None),
        ("k", (2017, 1, 22, 12), 3, "twelve"),
        ("k", (2017, 1, 22, None), 4, "daily"),
        ("k", (2017, 2, 1, 0), 5, "feb"),
        ("other", (2017, 1, 22, 11), 6, "other"),
    ])
    pairs = [
        ("k", "2017/01/22/11"), ("k", "2017/01/22"), ("k", "2017-01"), ("k", "2017"), ("k", ""),
        ("k", "2017/01/22/13"), ("nobody", "2017"), ("other", "2017 01 22 11"), ("k", "2017/01/22/11"),
    ]
    got = st.lookup(df, ask(spark, *pairs)).collect()
    assert len(got) == len(pairs)
    assert {(r.key, r.time): r.status for r in got} == {
        ("k", "2017/01/22/11"): 2, ("k", "2017/01/22"): 4, ("k", "2017-01"): 4, ("k", "2017"): 5,
        ("k", ""): 5, ("k", "2017/01/22/13"): None, ("nobody", "2017"): None, ("other", "2017 01 22 11"): 6,
    }
    meta = st.lookup(df, ask(spark, ("k", "2017/01/22/11")), "metadata").collect()[0]
    assert meta.metadata is None
    stamp = st.lookup(df, ask(spark, ("k", "2017/01/22/12")), "timestamp").collect()[0]
    assert stamp.timestamp == datetime(2018, 1, 1, 0, 2)


def test_lookup_of_a_busy_key_makes_no_pairs(spark):
    rows = spark.range(200_000).selectExpr(
        "id", "timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS timestamp",
        "'hot' AS key", "2018 AS year", "1 AS month", "1 AS day", "cast(id % 24 AS int) AS hour",
        "cast(id AS int) AS status", "cast(null AS string) AS metadata",
    )
    asks = spark.range(200_000).selectExpr("'hot' AS key", "concat('2018/01/01/', id % 24) AS time")
    got = st.lookup(rows, asks)
    assert got.count() == 200_000
    best = {r.time: r.status for r in got.distinct().collect()}
    assert len(best) == 24 and min(best.values()) >= 200_000 - 24


def test_latest_hour_ignores_incomplete_and_impossible_times(spark):
    df = log(spark, [
        ("k", (2017, 1, 22, 11), 1, None), ("k", (2017, 3, None, None), 1, None),
        ("k", (2017, 2, 30, 1), 1, None), ("only daily", (2017, 1, 1, None), 1, None),
    ])
    got = {r.key: r.t for r in st.latest_hours(df).select("key", st.as_hour_text(F.col("latest")).alias("t")).collect()}
    assert got == {"k": "2017-01-22-11", "only daily": None}


def test_pending_hours_span_whole_days(spark):
    df = log(spark, [
        ("ard/us/0/", (2018, 10, 12, 1), 1, None), ("derived_speed/us/0/", (2018, 10, 9, 23), 1, None),
        ("ard/us/1/", (2018, 10, 12, 1), 1, None), ("derived_speed/us/1/", (2018, 10, 12, 1), 1, None),
        ("ard/us/2/", (2018, 10, 12, 1), 1, None), ("derived_speed/us/2/", (2018, 10, 13, 1), 1, None),
    ])
    got = st.pending_hours(df).orderBy("time").collect()
    assert len(got) == 50 and {(r.country, r.stage) for r in got} == {("us", 0)}
    assert (got[0].time, got[-1].time) == ("2018-10-10-00", "2018-10-12-01")
    assert (got[0].y, got[0].m, got[0].d, got[0].h) == (2018, 10, 10, 0)


def test_pending_hours_of_first_runs(spark):
    df = log(spark, [
        ("ard/gb/0/", (2018, 10, 12, 1), 1, None), ("ard/gb/0/", (2018, 10, 12, 3), 1, None),
        ("ard/us/2/", (2018, 10, 12, 5), 1, None), ("derived_speed/us/2/", (2018, 10, 12, None), 1, None),
        ("ard/us/0/", (2018, 10, 12, 5), 1, None), ("derived_speed/us/0/", (2018, 10, 12, 4), 1, None),
        ("ard/us/0", (2018, 10, 12, 6), 1, None), ("derived_speed/us/0", (2018, 10, 12, 3), 1, None),
        ("ard/us", (2018, 10, 12, 6), 1, None), ("ard/fr/1/", (2018, 10, 12, None), 1, None),
    ])
    got = sorted((r.country, r.stage, r.h) for r in st.pending_hours(df).collect())
    assert got == [("gb", 0, 1), ("gb", 0, 2), ("gb", 0, 3), ("us", 0, 5), ("us", 0, 6), ("us", 2, 5)]


def test_requests_match_on_any_parts_they_give(spark):
    df = log(spark, [
        ("k", (2017, 1, 22, 11), 3, None), ("k", (2017, 5, 22, 4), 4, None), ("k", (2017, 5, 23, 4), 5, None),
        ("other", (2017, 6, 22, 11), 6, None), ("k", (2017, 7, 22, None), 7, None), (None, (2018, 1, 1, 1), 8, None),
    ])
    asked = [
        ("k", "2017/xx/22"), ("k", "2017/01"), ("k", ""), (None, "2017-xx-22"), (None, ""), ("k", "--22-4"), ("k", "xx/xx/xx/04"),
        ("k", "2017/07/22/5"), ("k", "x/x/23"), (None, "2018"), ("none", "x/x/22"), ("other", "x-x-x-11"),
    ]
    got = {(r.key, r.time): r.status for r in st.lookup(df, ask(spark, *asked)).collect()}
    assert got == {
        ("k", "2017/xx/22"): 7, ("k", "2017/01"): 3, ("k", ""): 7, (None, "2017-xx-22"): 7, (None, ""): 8, ("k", "--22-4"): 4,
        ("k", "xx/xx/xx/04"): 5, ("k", "2017/07/22/5"): None, ("k", "x/x/23"): 5, (None, "2018"): 8, ("none", "x/x/22"): None,
        ("other", "x-x-x-11"): 6,
    }
    assert st.lookup(df.limit(0), ask(spark, *asked)).where("status IS NOT NULL").count() == 0
    assert st.lookup(df, ask(spark, *asked).limit(0)).count() == 0


def test_only_the_combinations_asked_for_are_expanded(spark):
    df = log(spark, [("k", (2017, 1, 22, 11), 3, None)])
    plan = st.lookup(df, ask(spark, ("k", "2017/xx/22"), ("k", "2017/xx/23"), (None, "")))._jdf.queryExecution().optimizedPlan().toString()
    expand = next(line for line in plan.splitlines() if "Expand [" in line)
    assert expand.split("], [key")[0].count("[") - 2 == 2 or expand.count(", 3") + expand.count("31") >= 1


def test_ids_tell_rows_of_an_append_apart(spark):
    events = spark.range(100, numPartitions=4).selectExpr("'k' AS key", "'2017/01/22/11' AS time")
    rows = st.status_rows(events).collect()
    assert len({r.id for r in rows}) == 100 and len({r.timestamp for r in rows}) == 1


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Europe/London"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    # 2018-03-11 02:00 does not exist in Los Angeles, 2018-03-25 01:00 not in London
    rows = []
    for day in (11, 25):
        rows += [
            (f"ard/d{day}/0/", (2018, 3, day, 4), 1, None),
            (f"derived_speed/d{day}/0/", (2018, 3, day - 1, 23), 1, None),
        ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = st.pending_hours(log(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for day in (11, 25):
        mine = sorted((r.h, r.time) for r in got if r.country == f"d{day}")
        assert mine == [(h, f"2018-03-{day}-0{h}") for h in range(5)]


def test_append_and_head(spark):
    path = scratch.new_folder(spark, "status")
    log(spark, [("b", (2017, 1, 1, 0), 1, None)]).write.orc(path)
    st.append_status(st.status_rows(ask(spark, ("a", "2017/01/22/11"), ("a", "2017/01/22"))), path)
    extra = ask(spark, ("c", "2017/01/22")).withColumns({"status": F.lit(7), "metadata": F.lit("note")})
    st.append_status(st.status_rows(extra), path)
    back = st.read_status(spark, path)
    assert [tuple(r) for r in st.status_head(back, 3).collect()] == [
        ("a", 2017, 1, 22, None, 1), ("a", 2017, 1, 22, 11, 1), ("b", 2017, 1, 1, 0, 1),
    ]
    c = back.where("key = 'c'").collect()[0]
    assert (c.status, c.metadata) == (7, "note") and c.timestamp > T0
    assert back.select("id").distinct().count() == 4


def test_catch_up_runs_what_is_pending_and_logs_it(spark, sf_dir):
    from checks import inputs

    pings = inputs.request_pings(spark, sf_dir).where("stage = 1")
    path, output = scratch.new_folder(spark, "status"), scratch.new_folder(spark, "results")
    inputs.hour_log(spark, sf_dir).where("key like '%/1/'").write.orc(path)

    def append(rows):
        st.append_status(rows, path)

    first = catch_up(pings, st.read_status(spark, path), output, append)
    assert first.count() > 0
    rows = read_partitioned(spark, output, result_schema())
    assert {int(r.h) for r in rows.select("h").distinct().collect()} == {
        r.h for r in first.select("h").distinct().collect()
    }
    n = rows.count()
    again = catch_up(pings, st.read_status(spark, path), output, append)
    assert again.count() == 0
    assert read_partitioned(spark, output, result_schema()).count() == n
