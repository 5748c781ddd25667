"""Partitioned ORC, positional directories and catalog tables."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs
from pingmotion import derived_speed
from pingmotion.schema import ping_schema, result_schema
from pingmotion.settings import RESULT_KEYS, RUN_KEYS
from pingmotion.sources import scratch
from pingmotion.sources.orc import hour_slice, read_partitioned, write_partitioned
from pingmotion.sources.paths import (
    constant_columns,
    read_slices,
    skipped_files,
    slice_index,
    slices_glob,
)
from pingmotion.sources.tables import (
    create_footprint_table,
    insert_partitions,
    name_result,
    read_day,
)

PINGS = ping_schema(T.LongType(), T.LongType())


def as_set(df, *cols):
    return sorted(map(tuple, df.select(*cols or df.columns).collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = scratch.new_folder(spark, "pings")
    write_partitioned(inputs.request_pings(spark, sf_dir), path, RUN_KEYS)
    return path


def test_hour_slice_prunes_directories_and_pushes_gates(spark, stored):
    from pingmotion.operators.gates import eligible_pings

    picked = hour_slice(read_partitioned(spark, stored, PINGS), 2024, 1, 1, 9, 1, "us")
    assert picked.count() > 0
    plan = eligible_pings(picked)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan orc" in line)
    filters = scan.split("PartitionFilters:")[1]
    for part in ("h#", "stage#", "country#"):
        assert part in filters.split("PushedFilters:")[0]
    pushed = filters.split("PushedFilters:")[1].split("ReadSchema:")[0]
    assert "too_freq_uid" in pushed and "IsNull(r_s_info)" in pushed, pushed
    assert "In(sl_adjusted_confidence" in pushed


def test_position_scan_reads_no_request_ids(spark, stored):
    from pingmotion.operators.buckets import bucket_positions, with_time_bucket

    pos = bucket_positions(with_time_bucket(read_partitioned(spark, stored, PINGS)))
    plan = pos._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan orc" in line)
    assert "request_id" not in scan and "Batched: true" in scan


def test_hours_list_prunes_directories_in_every_scan(spark, stored):
    from pingmotion.plans.catchup import backfill, hour_range

    hours = hour_range(spark, ["us"], [0, 1], date(2024, 1, 1), 1).where("h = 9")
    plan = backfill(read_partitioned(spark, stored, PINGS), hours)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan orc" in line]
    assert len(scans) >= 3
    for scan in scans:
        filters = scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
        assert "stage" in filters and "= 9" in filters and "= us" in filters, filters


def test_results_keep_padded_parts_and_repeat_safely(spark, sf_dir):
    path = scratch.new_folder(spark, "results")
    result = derived_speed(inputs.request_pings(spark, sf_dir).where("h in (7, 12)"))
    keys = ("country", "m", "d", "h")
    write_partitioned(result, path, keys)
    back = read_partitioned(spark, path, result_schema(T.LongType()))
    assert as_set(back, *result.columns) == as_set(result)
    assert {r.h for r in back.select("h").distinct().collect()} == {"07", "12"}
    write_partitioned(result.where("h = '07'"), path, keys, replace=True)
    back = read_partitioned(spark, path, result_schema(T.LongType()))
    assert as_set(back, *result.columns) == as_set(result)
    write_partitioned(result.where("h = '07'"), path, keys, rebalance=False)
    again = read_partitioned(spark, path, result_schema(T.LongType()))
    assert again.count() == result.count() + result.where("h = '07'").count()


def test_rebalance_keeps_files_few(spark, sf_dir):
    path = scratch.new_folder(spark, "few")
    rows = inputs.request_pings(spark, sf_dir).repartition(8)
    write_partitioned(rows, path, ("country", "h"))
    files = spark.read.orc(path).select("_metadata.file_path").distinct().count()
    assert files == rows.select("country", "h").distinct().count()


def test_positional_directories(spark, sf_dir):
    base = scratch.new_folder(spark, "slices")
    body = "request_id bigint, latitude double"
    for place, ids in {
        "us/display/2018/10/10/05/fill/pos": [1, 2],
        "us/display/2018/10/10/06/nf/pos": [3],
        "us/exchange/2018/10/11/05/fill/tll": [4],
        "gb/display/2018/10/10/05/fill/pos": [5],
    }.items():
        spark.createDataFrame([(i, 40.0 + i) for i in ids], body).write.orc(f"{base}/{place}")
    levels = {
        "country": ["us"], "logType": ["display", "exchange", "euwest1"],
        "day": ["2018/10/10", "2018/10/11"], "h": ["05", "06"],
        "isFilled": ["fill", "nf"], "confScore": ["pos", "rest", "tll"],
    }
    assert slices_glob("/b/", {"a": ["x"], "b": None, "c": ["y", "z"]}) == "/b/x/*/{y,z}"
    flat = {"country": None, "logType": None, "y": None, "m": None, "d": None, "h": None,
            "isFilled": None, "confScore": None}
    schema = T._parse_datatype_string(body)
    types = {k: "int" for k in ("y", "m", "d")}
    got = read_slices(spark, base, flat, schema, types)
    assert as_set(got, "request_id", "country", "y", "m", "d", "h", "isFilled", "confScore") == [
        (1, "us", 2018, 10, 10, "05", "fill", "pos"),
        (2, "us", 2018, 10, 10, "05", "fill", "pos"),
        (3, "us", 2018, 10, 10, "06", "nf", "pos"),
        (4, "us", 2018, 10, 11, "05", "fill", "tll"),
        (5, "gb", 2018, 10, 10, "05", "fill", "pos"),
    ]
    # whole dates as one level, combinations without a directory fall out
    some = spark.read.schema(schema).orc(slices_glob(base, levels))
    assert sorted(r.request_id for r in some.collect()) == [1, 2, 3, 4]
    assert constant_columns(got, {"dt": "2018-10-10"}).where("dt = '2018-10-10'").count() == 5


def test_damaged_files_are_skipped_or_reported(spark, tmp_path):
    good, bad = tmp_path / "a", tmp_path / "b"
    spark.range(3).write.orc(str(good))
    bad.mkdir()
    (bad / "part-0.orc").write_bytes(b"no orc at all")
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert read_slices(spark, str(tmp_path), {"x": None}, schema, skip_unreadable=True).count() == 3
    with pytest.raises(Exception):
        read_slices(spark, str(tmp_path), {"x": None}, schema).collect()
    skipped = [r.file_path for r in skipped_files(spark, str(tmp_path), {"x": None}, schema).collect()]
    assert len([p for p in skipped if p.endswith("b/part-0.orc")]) == 1
    assert not [p for p in skipped if p.rsplit("/", 1)[0].endswith("/a") and p not in skipped]


def test_path_values_are_decoded(spark, tmp_path):
    values = ["a b", "x/y", "p=q", "1+1", "50%", None]
    rows = spark.createDataFrame([(i, v, i) for i, v in enumerate(values)] + [(9, "n", None)], "id int, k string, n int")
    rows.write.partitionBy("k", "n").orc(str(tmp_path / "named"))
    body = T._parse_datatype_string("id int")
    got = read_slices(spark, str(tmp_path / "named"), {"k": None, "n": None}, body, {"n": "int"}, named=("k", "n"))
    assert {(r.id, r.k, r.n) for r in got.collect()} == {(i, v, i) for i, v in enumerate(values)} | {(9, "n", None)}
    for i, v in enumerate(["a b", "p=q", "1+1", "50%"]):
        spark.createDataFrame([(i,)], "id int").write.orc(str(tmp_path / "plain" / v))
    got = read_slices(spark, str(tmp_path / "plain"), {"k": None}, body)
    assert [r.k for r in got.orderBy("id").collect()] == ["a b", "p=q", "1+1", "50%"]
    assert read_slices(spark, str(tmp_path / "plain"), {"k": None}, body, {"k": "int"}).where("k IS NULL").count() == 4
    with pytest.raises(Exception, match="is no int"):
        read_slices(spark, str(tmp_path / "plain"), {"k": ["a b"]}, body, {"k": "int"}).collect()


def test_day_table_to_partition_of_result_table(spark, sf_dir):
    from pingmotion import footprint_speed

    name_result(inputs.footprint_pings(spark, sf_dir), "day_pings_181010")
    day = date(2018, 10, 10)
    one = read_day(spark, "day_pings_{yymmdd}", day, "09")
    assert {r.hr for r in one.select("hr").distinct().collect()} == {"09"}
    table = "footprint_result_test"
    create_footprint_table(spark, table, scratch.new_folder(spark, "table"))
    hours = footprint_speed(read_day(spark, "day_pings_{yymmdd}", day))
    insert_partitions(hours, table)
    assert spark.table(table).count() == hours.count()
    # a repeated hour is replaced, the others stay; the partition may be given from outside
    nine = footprint_speed(one).drop("dt", "hr")
    insert_partitions(nine, table, replace=True, partition={"dt": "2018-10-10", "hr": "09"})
    assert spark.table(table).count() == hours.count()
    insert_partitions(nine, table, partition={"dt": "2018-10-10", "hr": "09"})
    assert spark.table(table).count() == hours.count() + nine.count()
    assert spark.table(table).where(F.col("uid").isNull()).count() == 0


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = scratch.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder == named.rstrip("/")
    assert scratch.settled(spark.range(3)).count() == 3


def test_default_result_layout(spark, sf_dir):
    path = scratch.new_folder(spark, "layout")
    one = derived_speed(inputs.request_pings(spark, sf_dir).where("h = 9 and stage = 1 and country = 'us'"))
    write_partitioned(one, path)
    place = spark.read.orc(path).select("_metadata.file_path").first()[0]
    assert [p.split("=")[0] for p in place.split("/") if "=" in p] == ["country", *RESULT_KEYS]
    assert "m=01/d=01/h=09" in place


def test_a_condition_on_path_levels_skips_directories(spark, tmp_path):
    base = str(tmp_path / "slices")
    n = 0
    for place in ("us", "gb", "a b%"):
        for day in ("2018-10-10", "2018-10-11", "x"):
            for h in ("05", "06"):
                spark.createDataFrame([(n,)], "id int").write.orc(f"{base}/{place}/{day}/{h}")
                n += 1
    body = T._parse_datatype_string("id int")
    levels = {"country": None, "day": None, "h": None}
    types = {"day": "date", "h": "int"}

    def ids(df):
        return sorted(r.id for r in df.collect())

    whole = read_slices(spark, base, levels, body, types)
    for where, files in ((F.col("h") == 5, 9), (F.col("day") >= "2018-10-11", 6), (F.col("day").isNull(), 6),
                         ((F.col("country") == "a b%") & (F.col("h") > 5), 3), (F.col("h") > 9, 0)):
        some = read_slices(spark, base, levels, body, types, where=where)
        assert len({f.rsplit("/", 1)[0] for f in some.inputFiles()}) == files
        assert ids(some) == ids(whole.where(where))
    index = slice_index(spark, base, {"country": ["us"], "day": None, "h": ["06"]}, types)
    assert sorted((r.country, str(r.day), r.h) for r in index.collect()) == [
        ("us", "2018-10-10", 6), ("us", "2018-10-11", 6), ("us", "None", 6),
    ]
    assert index.where("n_bytes > 0").count() == 3
    spark.range(3).selectExpr("id", "id AS k", "if(id = 1, null, 'p/q') AS v").write.partitionBy("k", "v").orc(str(tmp_path / "named"))
    named = {"k": None, "v": None}
    got = read_slices(spark, str(tmp_path / "named"), named, T._parse_datatype_string("id long"), {"k": "int"}, named=named, where=F.col("v").isNull())
    assert len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) == 1 and [(r.id, r.k, r.v) for r in got.collect()] == [(1, 1, None)]
