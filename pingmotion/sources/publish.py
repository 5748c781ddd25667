"""Publish runs: new results beside the old ones, one commit, then an exchange of directories.

A run's rows lie in many leaf directories, which no single rename can exchange. So ``publish_runs``
writes the new rows to a side folder, lists which leaves leave and which come, and commits both by
creating one marker file. After that the exchange is only carried out: tasks move each old leaf away
and the new one into its place, and any of these moves may be repeated. ``read_published`` sees the
old rows until the marker is there and the new ones from then on, at whatever move a job was killed;
``recover`` carries on from there. Nothing is deleted before the exchange is complete.

    output/country=us/…            leaves of the runs, read by anyone
    output/_publish/<id>/rows/…    new leaves, the same paths
                        /leaves    table: path of the leaf, whether it was there, whether it comes
                        /COMMITTED, /EXCHANGED    markers
                        /old/…     leaves that have left

Scale. Runs and leaves are tables; listing, moving and deleting run in tasks, so that the driver makes
a fixed number of calls, however many directories change. Only directories of the listed runs are looked
at. One job at a time may publish the same runs, without speculative tasks. Tasks reach the store through
pyarrow: local and mounted folders, HDFS, S3 and GCS.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import RESULT_KEYS, RUN_KEYS
from .folders import Folder, child_directories, is_directory, opened
from .orc import write_partitioned
from .paths import NULL_DIRECTORY

SIDE = "_publish"
#: fixed value: the characters that Spark writes as %XX in a directory name
ESCAPED = "\"#%'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))
#: leaves that one task exchanges
LEAVES_PER_TASK = 2000


def directory_name(key: str, value: object) -> str:
    """``key=value`` as Spark names the directory."""
    if value is None or value == "":
        return f"{key}={NULL_DIRECTORY}"
    return f"{key}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(value))


def run_leaves(uri: str, runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every leaf directory under ``uri`` that belongs to a run of ``runs``, whatever its other keys are:
    the run's keys as text, ``leaf`` and the bytes of its files as ``n_bytes``. ``uri`` is qualified;
    ``runs`` holds values as they are stored."""
    named = [k for k in keys if k in runs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(uri)
        for batch in batches:
            for row in batch.to_pylist():
                level = [""]
                for key in keys:
                    if key in named:
                        # a folder that is not there has no children further down
                        level = [f"{p}/{directory_name(key, row[key])}" for p in level]
                    else:
                        level = [f"{p}/{c}" for p in level for c in child_directories(fs, base + p) if c.startswith(f"{key}=")]
                leaves = [leaf for leaf in level if is_directory(fs, base + leaf)]
                sizes = [sum(f.size for f in fs.get_file_info(pafs.FileSelector(base + leaf)) if f.is_file) for leaf in leaves]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([row[k]] * len(leaves), pa.string()) for k in named),
                        pa.array([leaf[1:] for leaf in leaves], pa.string()),
                        pa.array(sizes, pa.int64()),
                    ],
                    [*named, "leaf", "n_bytes"],
                )

    listed = runs.select(*[F.col(k).cast("string").alias(k) for k in named]).distinct()
    kinds = "".join(f"`{k}` string, " for k in named)
    return listed.mapInArrow(run, f"{kinds}leaf string, n_bytes long")


def _stage(df: DataFrame, side: str, keys: Sequence[str]) -> None:
    # nobody reads the side folder before the commit, so tasks may write straight into it
    write_partitioned(df, f"{side}/rows", keys, options={"mapreduce.fileoutputcommitter.algorithm.version": "2"})


def _list_leaves(spark: SparkSession, folder: Folder, side: str, runs: DataFrame, keys: Sequence[str]) -> None:
    old = run_leaves(folder.uri, runs, keys).select("leaf", F.lit(True).alias("old"))
    new = run_leaves(f"{folder.uri}/{side}/rows", runs, keys).select("leaf", F.lit(True).alias("new"))
    both = old.join(new, "leaf", "full").select(
        "leaf", F.coalesce("old", F.lit(False)).alias("old"), F.coalesce("new", F.lit(False)).alias("new")
    )
    both.write.mode("overwrite").parquet(f"{folder.uri}/{side}/leaves")


def _leaves(spark: SparkSession, side_uri: str) -> DataFrame:
    return spark.read.schema("leaf string, old boolean, new boolean").parquet(f"{side_uri}/leaves")


def _in_tasks(leaves: DataFrame, work) -> None:
    """Call ``work(leaf, old, new)`` for every leaf, in tasks."""
    n = leaves.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                work(row["leaf"], row["old"], row["new"])
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    spread = leaves.repartition(1 + n // LEAVES_PER_TASK)
    done = spread.mapInArrow(run, "n long").agg(F.sum("n").alias("n")).first()["n"]
    if (done or 0) != n:
        raise RuntimeError(f"{done} of {n} directories were handled")


def _exchange(leaves: DataFrame, uri: str, side: str) -> None:
    """Old leaves out, new ones in. What an earlier attempt has done is seen from what is there: an
    old leaf has left once it is under ``old``, a new one has come once it is not under ``rows``."""

    def work(leaf: str, old: bool, new: bool) -> None:
        fs, base = opened(uri)
        here, away, fresh = f"{base}/{leaf}", f"{base}/{side}/old/{leaf}", f"{base}/{side}/rows/{leaf}"
        if old and not is_directory(fs, away):
            fs.create_dir(away.rsplit("/", 1)[0], recursive=True)
            fs.move(here, away)
        if new and is_directory(fs, fresh):
            fs.create_dir(here.rsplit("/", 1)[0], recursive=True)
            fs.move(fresh, here)

    _in_tasks(leaves, work)


def _discard(leaves: DataFrame, uri: str, side: str) -> None:
    """Delete the leaves that have left."""

    def work(leaf: str, old: bool, new: bool) -> None:
        fs, base = opened(uri)
        if old and is_directory(fs, f"{base}/{side}/old/{leaf}"):
            fs.delete_dir(f"{base}/{side}/old/{leaf}")

    _in_tasks(leaves, work)


def _finish(
    spark: SparkSession, folder: Folder, side: str, on_step: Callable[[str], None] = lambda step: None
) -> None:
    """Carry out a committed exchange from wherever it stands."""
    leaves = _leaves(spark, f"{folder.uri}/{side}")
    if not folder.has(f"{side}/EXCHANGED"):
        _exchange(leaves, folder.uri, side)
        on_step("moved")
        folder.mark(f"{side}/EXCHANGED")
        on_step("exchanged")
    _discard(leaves, folder.uri, side)
    on_step("discarded")
    folder.delete(f"{side}/COMMITTED")  # first, so that no half deleted folder looks committed
    folder.delete(side)  # empty directories and the list


def recover(spark: SparkSession, path: str, abandoned_after_s: float = 86_400) -> int:
    """Finish what earlier jobs have committed under ``path`` and return how many; side folders that
    were never committed are deleted when they are older than ``abandoned_after_s``."""
    folder, finished = Folder(spark, path), 0
    for name, changed in folder.names(SIDE):
        side = f"{SIDE}/{name}"
        if folder.has(f"{side}/COMMITTED"):
            _finish(spark, folder, side)
            finished += 1
        elif folder.has(f"{side}/EXCHANGED") or changed < time.time() - abandoned_after_s:
            folder.delete(side)
    return finished


def publish_runs(
    df: DataFrame,
    path: str,
    runs: DataFrame,
    keys: Sequence[str] = ("country", *RESULT_KEYS),
    run_keys: Sequence[str] = RUN_KEYS,
    on_step: Callable[[str], None] = lambda step: None,
) -> None:
    """Make ``path`` hold exactly the rows of ``df`` for the listed runs; other runs stay as they are.

    ``runs`` has the run keys as they are stored, which are among the ``keys`` of the directories; a
    listed run without rows in ``df`` becomes empty. Rows of runs that are not listed must not be
    in ``df``: they are not published. A job killed at any point leaves every run old or new
    for ``read_published``; calling again, or ``recover``, completes it. ``on_step`` is called with the
    name of each step that is done.
    """
    spark = df.sparkSession
    recover(spark, path)
    folder, side = Folder(spark, path), f"{SIDE}/{uuid.uuid4().hex}"
    listed = runs.select(*run_keys).distinct()
    _stage(df, f"{folder.uri}/{side}", keys)
    on_step("staged")
    _list_leaves(spark, folder, side, listed, keys)
    on_step("listed")
    folder.mark(f"{side}/COMMITTED")
    on_step("committed")
    _finish(spark, folder, side, on_step)


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The published rows, also between a commit and the end of its exchange: leaves that have not come
    yet are read from the side folder, and leaves that have not left yet are skipped."""
    folder = Folder(spark, path)
    rows = spark.read.schema(schema).orc(folder.uri)
    for name, _ in folder.names(SIDE):
        side = f"{SIDE}/{name}"
        if not folder.has(f"{side}/COMMITTED") or folder.has(f"{side}/EXCHANGED"):
            continue
        uri = folder.uri
        leaves = _leaves(spark, f"{uri}/{side}")

        def run(batches: Iterator[pa.RecordBatch], uri=uri, side=side) -> Iterator[pa.RecordBatch]:
            fs, base = opened(uri)
            for batch in batches:
                stay = [
                    leaf
                    for leaf, old in zip(batch["leaf"].to_pylist(), batch["old"].to_pylist())
                    if old and not is_directory(fs, f"{base}/{side}/old/{leaf}")
                ]
                yield pa.RecordBatch.from_arrays([pa.array(stay, pa.string())], ["stale"])

        stale = leaves.mapInArrow(run, "stale string")
        one = leaves.first()
        depth = one["leaf"].count("/") + 1 if one else 1
        # the path is a URI; the last levels of its directory are the leaf
        folders = F.regexp_replace(F.regexp_replace("_metadata.file_path", "/[^/]*$", ""), r"\+", "%2B")
        old = rows.select("*", F.url_decode(F.substring_index(folders, "/", -depth)).alias("__leaf"))
        rows = old.join(stale, F.col("__leaf") == F.col("stale"), "left_anti").drop("__leaf")
        if folder.names(f"{side}/rows"):
            fresh = spark.read.schema(schema).orc(f"{uri}/{side}/rows")
            rows = rows.unionByName(fresh)
    return rows
