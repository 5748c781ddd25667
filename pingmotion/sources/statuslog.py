"""A status log that stays small to read: rows by the day they were appended, and snapshots.

    log/rows/appended=2024-01-05/…      the rows, as they were appended
    log/snapshots/upto=2024-01-04/…     what counts of all rows appended before that day

A snapshot holds, per key and month of the event, the rows of the earliest and the latest event hour. That is
all that ``latest_hours`` and ``pending_hours`` look at, so on ``read_compact`` they give the same answers as
on all rows, while the read is one snapshot and the days after it. The rows stay where they are, for
lookups. A snapshot that was not written to its end is not used.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.status import event_hour
from ..schema import STATUS
from .folders import Folder

_STORED = T.StructType([*STATUS.fields, T.StructField("appended", T.StringType())])


def append_rows(rows: DataFrame, path: str) -> None:
    """Append status rows under the day of their timestamp."""
    day = F.substring(F.col("timestamp").cast("string"), 1, 10)
    stored = rows.select(*STATUS.names).withColumn("appended", day)
    stored.hint("rebalance", "appended").write.mode("append").partitionBy("appended").orc(f"{path}/rows")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    folder = Folder(spark, path)
    if not folder.has("rows"):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).orc(f"{path}/rows")


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the log."""
    return _rows(spark, path).select(*STATUS.names)


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """The days of the complete snapshots, in order."""
    folder = Folder(spark, path)
    names = [name for name, _ in folder.names("snapshots") if folder.has(f"snapshots/{name}/_SUCCESS")]
    return sorted(name.removeprefix("upto=") for name in names)


def read_compact(spark: SparkSession, path: str, upto: str | None = None) -> DataFrame:
    """Rows with the same latest and pending hours as the whole log: the newest snapshot, or the newest
    before ``upto``, and the rows of the days from there on."""
    taken = [day for day in snapshots(spark, path) if upto is None or day <= upto]
    rows = _rows(spark, path)
    if upto is not None:
        rows = rows.where(F.col("appended") < upto)
    if not taken:
        return rows.select(*STATUS.names)
    tail = rows.where(F.col("appended") >= taken[-1])
    snapshot = spark.read.schema(STATUS).orc(f"{path}/snapshots/upto={taken[-1]}")
    return snapshot.unionByName(tail.select(*STATUS.names))


def extremes(log: DataFrame) -> DataFrame:
    """Per key and month of the event the rows of the earliest and the latest event hour; where no row
    has a whole event hour, one row, so that the key stays known."""
    whole = F.struct(*STATUS.names)
    found = log.groupBy(F.col("key").alias("_key"), F.col("year").alias("_year"), F.col("month").alias("_month")).agg(
        F.min_by(whole, event_hour()).alias("first"), F.max_by(whole, event_hour()).alias("last"), F.min(whole).alias("any")
    )
    kept = F.array_distinct(F.array(F.coalesce("first", "any"), F.coalesce("last", "any")))
    return found.select(F.explode(kept).alias("row")).select("row.*")


def compact(spark: SparkSession, path: str, upto: date) -> None:
    """Write the snapshot of all rows appended before the day ``upto``, from the snapshot before it and
    the days between. The days must be over, since rows may still come to the current one."""
    if upto > spark.sql("SELECT to_date(localtimestamp())").first()[0]:
        raise ValueError("days that are not over can still get rows")
    day = upto.isoformat()
    if day not in snapshots(spark, path):
        extremes(read_compact(spark, path, day)).coalesce(1).write.mode("overwrite").orc(f"{path}/snapshots/upto={day}")
