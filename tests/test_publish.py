"""Publishing runs: old or new at whatever step a job ends, and many directories without a driver loop."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingmotion.sources import publish
from pingmotion.sources.folders import Folder, opened
from pingmotion.sources.orc import write_partitioned

KEYS = ("country", "kind", "h")
RUN = ("country", "h")
SCHEMA = T.StructType([T.StructField("id", T.LongType()), *(T.StructField(c, T.StringType()) for c in KEYS)])
STEPS = ["staged", "listed", "committed", "moved", "exchanged", "discarded"]


class Killed(Exception):
    pass


def killed_after(step):
    def on_step(done):
        if done == step:
            raise Killed

    return on_step


def rows(spark, *data):
    return spark.createDataFrame([(i, c, k, h) for i, c, k, h in data], SCHEMA)


def seen(df):
    return sorted(map(tuple, df.select("id", "country", "kind", "h").collect()))


OLD = [(1, "us", "a", "05"), (2, "us", "b", "05"), (3, "us", "a", "06"), (4, "gb", "a", "05"), (5, "us", "x/y %", "06")]
# run (us, 05) moves to another kind, (us, 06) becomes empty, (fr, 07) is new, (gb, 05) is not listed
NEW = [(11, "us", "b", "05"), (12, "us", "c:d=1", "05"), (13, "fr", "é a", "07")]
AFTER = sorted([*NEW, OLD[3]])
LISTED = [("us", "05"), ("us", "06"), ("fr", "07")]


@pytest.fixture
def output(spark, tmp_path):
    path = str(tmp_path / "out put")
    write_partitioned(rows(spark, *OLD), path, KEYS)
    return path


def publish_new(spark, path, on_step=lambda step: None):
    runs = spark.createDataFrame(LISTED, "country string, h string")
    publish.publish_runs(rows(spark, *NEW), path, runs, KEYS, RUN, on_step)


def plain(spark, path):
    return seen(spark.read.schema(SCHEMA).orc(path))


def test_runs_are_replaced_as_a_whole(spark, output):
    publish_new(spark, output)
    assert seen(publish.read_published(spark, output, SCHEMA)) == AFTER
    assert plain(spark, output) == AFTER
    assert os.listdir(f"{output}/_publish") == []
    publish_new(spark, output)
    assert plain(spark, output) == AFTER


@pytest.mark.parametrize("step", STEPS)
def test_a_job_that_ends_after_any_step_leaves_runs_old_or_new(spark, output, step):
    with pytest.raises(Killed):
        publish_new(spark, output, killed_after(step))
    committed = STEPS.index(step) >= STEPS.index("committed")
    want = AFTER if committed else sorted(OLD)
    assert seen(publish.read_published(spark, output, SCHEMA)) == want
    assert publish.recover(spark, output, abandoned_after_s=-5) == (1 if committed else 0)
    assert plain(spark, output) == want == seen(publish.read_published(spark, output, SCHEMA))
    assert os.listdir(f"{output}/_publish") == []
    publish_new(spark, output)
    assert plain(spark, output) == AFTER


@pytest.mark.parametrize("moves", range(0, 12))
def test_a_job_that_ends_between_two_moves(spark, output, moves, monkeypatch):
    """The exchange ends after any number of single moves."""

    def some(leaves, uri, side):
        fs, base = opened(uri)
        done = 0
        for leaf, old, new in sorted(map(tuple, leaves.collect())):
            for wanted, start, end in (
                (old, f"{base}/{leaf}", f"{base}/{side}/old/{leaf}"),
                (new, f"{base}/{side}/rows/{leaf}", f"{base}/{leaf}"),
            ):
                if wanted and done == moves:
                    raise Killed
                if wanted:
                    fs.create_dir(end.rsplit("/", 1)[0], recursive=True)
                    fs.move(start, end)
                    done += 1
        raise Killed

    monkeypatch.setattr(publish, "_exchange", some)
    with pytest.raises(Killed):
        publish_new(spark, output)
    assert seen(publish.read_published(spark, output, SCHEMA)) == AFTER
    monkeypatch.undo()
    assert publish.recover(spark, output) == 1
    assert plain(spark, output) == AFTER


def test_a_folder_half_deleted_is_not_taken_for_a_commit(spark, output, monkeypatch):
    delete = Folder.delete

    def half(self, name):
        delete(self, f"{name}/EXCHANGED" if name.count("/") == 1 else name)
        if name.count("/") == 1:
            raise Killed

    monkeypatch.setattr(Folder, "delete", half)
    with pytest.raises(Killed):
        publish_new(spark, output)
    monkeypatch.undo()
    assert publish.recover(spark, output) == 0
    assert plain(spark, output) == AFTER == seen(publish.read_published(spark, output, SCHEMA))


def test_first_publication_and_empty_runs(spark, tmp_path):
    path = str(tmp_path / "new")
    publish_new(spark, path)
    assert plain(spark, path) == sorted(NEW)
    runs = spark.createDataFrame(LISTED, "country string, h string")
    publish.publish_runs(rows(spark).limit(0), path, runs, KEYS, RUN)
    assert plain(spark, path) == []


def test_many_stale_folders_are_exchanged_in_tasks(spark, tmp_path, monkeypatch):
    path, n = str(tmp_path / "many"), 10_000
    for i in range(n):
        os.makedirs(f"{path}/country=us/kind=k{i}/h=05")
    calls = []
    delete = Folder.delete
    monkeypatch.setattr(Folder, "delete", lambda self, name: (calls.append(name), delete(self, name))[1])
    runs = spark.createDataFrame([("us", "05")], "country string, h string")
    publish.publish_runs(rows(spark, (1, "us", "k7", "05")), path, runs, KEYS, RUN)
    assert len(calls) == 2  # the marker and the side folder
    left = [d for d, _, files in os.walk(path) if d.endswith("h=05")]
    assert len(left) == 1 and plain(spark, path) == [(1, "us", "k7", "05")]


def test_directory_names_are_those_that_spark_writes(spark, tmp_path):
    values = ["a b", "x/y", "p=q", "50%", "#", "a:b", "ü", "'", '"', "[x]", "{y}", "a\\b", "^", "?", "*", "\x01", ""]
    spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, k string").write.partitionBy("k").orc(str(tmp_path / "t"))
    names = {n for n in os.listdir(tmp_path / "t") if n.startswith("k=")}
    assert names == {publish.directory_name("k", v) for v in values}


def test_input_bytes_and_batches(spark, tmp_path):
    from pingmotion.plans.catchup import batches, input_bytes

    path = str(tmp_path / "in")
    data = [(i, "us", s, 2024, 1, d, h) for i, (d, h, s) in enumerate([(1, 5, 0), (1, 5, 1), (1, 6, 0), (2, 0, 0), (2, 9, 0)])]
    schema = "id int, country string, stage int, y int, m int, d int, h int"
    df = spark.createDataFrame(data, schema)
    keys = ("country", "stage", "y", "m", "d", "h")
    write_partitioned(df, path, keys)
    runs = df.drop("id").union(spark.createDataFrame([("us", 3, 2024, 1, 1, 6)], "country string, stage int, y int, m int, d int, h int"))
    sizes = input_bytes(spark, path, runs, keys)
    assert sizes.count() == 5 and sizes.where("n_bytes > 0").count() == 5
    fixed = sizes.withColumn("n_bytes", F.lit(10).cast("long"))
    got = {(r.d, r.h, r.stage): r.batch for r in batches(runs, fixed, 25).collect()}
    assert got == {(1, 5, 0): 0, (1, 5, 1): 0, (1, 6, 0): 0, (1, 6, 3): 0, (2, 0, 0): 1, (2, 9, 0): 1}
    assert {r.batch for r in batches(runs, fixed, 1).collect()} == {0, 1, 2, 3}


def test_backfill_continues_where_it_ended(spark, tmp_path):
    from pingmotion.operators import status as st
    from pingmotion.plans.catchup import backfill, backfill_in_batches
    from pingmotion.schema import result_schema
    from pingmotion.sources.orc import read_partitioned

    from .test_pipeline import frame, moving

    pings = frame(spark, [p for i, h in enumerate(range(3, 8)) for p in moving(5, f"d{i}", h=h)])
    hours = pings.select("country", "stage", "y", "m", "d", "h").distinct()
    hours = hours.withColumn("time", F.format_string("%04d-%02d-%02d-%02d", "y", "m", "d", "h"))
    sizes = hours.withColumn("n_bytes", F.lit(100).cast("long"))
    output, log, logged = str(tmp_path / "out"), str(tmp_path / "log"), []
    st.append_status(st.status_rows(spark.createDataFrame([("derived_speed/us/0/", "2018-10-09-03", "other")], "key string, time string, metadata string")), log)

    def append(rows_):
        if len(logged) == 2:
            raise Killed
        st.append_status(rows_, log)
        logged.append(1)

    with pytest.raises(Killed):
        backfill_in_batches(pings, hours, st.read_status(spark, log), output, append, "job", sizes, 100)
    logged.clear()
    logged.append(0)
    plan = backfill_in_batches(
        pings, hours, st.read_status(spark, log), output, lambda r: st.append_status(r, log), "job", sizes, 100
    )
    assert sorted((r.h, r.batch) for r in plan.collect()) == [(5, 0), (6, 1), (7, 2)]
    got = read_partitioned(spark, output, result_schema())
    want = backfill(pings, hours)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    again = backfill_in_batches(pings, hours, st.read_status(spark, log), output, append, "job", sizes, 100)
    assert again.count() == 0
