"""The status log: which hours of which task are done.

A row says that the event (key, year, month, day, hour) had a status at a time. The right
time parts may be missing: a daily event has no hour. Event hours are handled as
timestamps without zone, so a daylight-saving change adds or loses no hour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STATUS
from ..settings import INPUT_PREFIX, RESULT_PREFIX

TIME_PARTS = ("year", "month", "day", "hour")


def time_parts(text: Column) -> dict[str, Column]:
    """Year, month, day and hour of an event time such as ``2017/01/22/11``; the delimiter
    is one of ``- / :`` or white space. Missing right parts are null."""
    pieces = F.split(text, r"[-/\s:]")
    return {
        part: F.get(pieces, F.lit(i)).try_cast("int") for i, part in enumerate(TIME_PARTS)
    }


def with_time_parts(df: DataFrame, column: str = "time") -> DataFrame:
    return df.withColumns(time_parts(F.col(column)))


def task_key(prefix: str | Column, country: Column, stage: Column) -> Column:
    """``prefix`` + country + '/' + stage + '/'."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    slash = F.lit("/")
    return F.concat(head, country.cast("string"), slash, stage.cast("string"), slash)


def event_hour() -> Column:
    """The event hour of a status row; null when any part is missing or out of range."""
    return F.expr("try_make_timestamp_ntz(year, month, day, hour, 0, 0)")


def status_rows(events: DataFrame) -> DataFrame:
    """Rows to append to the log, stamped with the time of the job.

    ``events`` has key and time, and may have status (default 1) and metadata. ``id`` is
    random: it tells rows apart and says nothing about order; that is the timestamp's.
    """
    status = F.col("status").cast("int") if "status" in events.columns else F.lit(1)
    meta = F.col("metadata").cast("string") if "metadata" in events.columns else F.lit(None)
    return with_time_parts(events).select(
        F.xxhash64(F.expr("uuid()")).alias("id"),
        F.localtimestamp().alias("timestamp"),
        "key",
        *TIME_PARTS,
        status.alias("status"),
        meta.cast("string").alias("metadata"),
    ).to(STATUS)


def _given(parts: Sequence[str]) -> Column:
    """One bit per part that is not null."""
    bits = [F.when(F.col(p).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, p in enumerate(parts)]
    return sum(bits[1:], bits[0])


def lookup(log: DataFrame, requests: DataFrame, *columns: str) -> DataFrame:
    """Values of ``columns`` (default: status) in the newest matching row for each request
    (key and event time); null if there is none.

    A request matches on what it gives: a date without hour also matches the hourly rows of that
    day, ``2017-xx-22`` every 22nd of that year, a request without key any key, and one that gives
    nothing the newest row of all. A part of the log that is null matches only requests that leave it
    out. Of rows with equal timestamps the larger id counts as newer.

    The log is folded to its distinct event times first, then once for each combination of parts
    that the requests give, of which there are 32 at most, and requests meet at most one row by
    equality: a busy key never pairs all its rows with all its requests.
    """
    columns = columns or ("status",)
    parts = ("key", *TIME_PARTS)
    asked = requests.withColumns(time_parts(F.col("time"))).withColumn("_mask", _given(parts))
    masks = sorted(r["_mask"] for r in asked.select("_mask").distinct().collect())
    when = F.struct("timestamp", "id")
    events = log.groupBy(*parts).agg(
        F.max_by(F.struct(when.alias("_when"), F.struct(*columns).alias("_row")), when).alias("_last")
    )
    newest = F.max_by(F.col("_last._row"), F.col("_last._when")).alias("_newest")
    kept = {m: [p for i, p in enumerate(parts) if m >> i & 1] for m in masks}
    levels = events.groupingSets(list(kept.values()) or [[]], *parts).agg(newest, F.grouping_id().alias("_folded"))
    # grouping_id has the first part in its highest bit, set where the part was folded away
    mask = sum(
        (F.lit(1 << i) * (F.lit(1) - F.getbit("_folded", F.lit(len(parts) - 1 - i))) for i in range(len(parts))), F.lit(0)
    )
    levels = levels.select(*[F.col(p).alias(f"_{p}") for p in parts], mask.alias("_of"), "_newest")
    same = F.col("_mask") == F.col("_of")
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
    return asked.join(levels, same, "left").select(
        *requests.columns, *[F.col("_newest")[c].alias(c) for c in columns]
    )


def latest_hours(log: DataFrame) -> DataFrame:
    """Latest event hour per key; rows with a missing part do not count."""
    return log.groupBy("key").agg(F.max(event_hour()).alias("latest"))


def as_hour_text(hour: Column) -> Column:
    """``yyyy-MM-dd-HH``. Cut from the plain text: ``date_format`` would pass through the
    session zone, where an hour may not exist."""
    return F.translate(F.substring(hour.cast("string"), 1, 13), " ", "-")


def pending_hours(
    log: DataFrame, input_prefix: str = INPUT_PREFIX, result_prefix: str = RESULT_PREFIX
) -> DataFrame:
    """Hours with input but without result, per country and stage: those after the latest
    result hour up to and including the latest input hour. A place without any result hour
    (daily results do not count) begins at its earliest input hour. Spellings of a key that
    name the same place count together."""

    def hours_of(prefix: str) -> DataFrame:
        place = F.split(F.col("key").substr(F.lit(len(prefix) + 1), F.length("key")), "/")
        return log.where(F.col("key").startswith(prefix)).select(
            F.get(place, F.lit(0)).alias("country"),
            F.get(place, F.lit(1)).try_cast("int").alias("stage"),
            event_hour().alias("at"),
        ).where("country IS NOT NULL AND stage IS NOT NULL")

    by_place = ["country", "stage"]
    have = hours_of(input_prefix).groupBy(by_place).agg(
        F.min("at").alias("begun"), F.max("at").alias("have")
    )
    done = hours_of(result_prefix).groupBy(by_place).agg(F.max("at").alias("done"))
    both = have.join(done, by_place, "left").withColumn(
        "first", F.expr("coalesce(done + interval 1 hour, begun)")
    )
    hours = both.where(F.col("first") <= F.col("have")).select(
        "country",
        "stage",
        F.explode(F.expr("sequence(first, have, interval 1 hour)")).alias("hour"),
    )
    return hours.select(
        "country",
        "stage",
        F.year("hour").alias("y"),
        F.month("hour").alias("m"),
        F.day("hour").alias("d"),
        F.hour("hour").alias("h"),
        as_hour_text(F.col("hour")).alias("time"),
    )


def status_head(log: DataFrame, n: int = 50, order: Sequence[str] = ("key", *TIME_PARTS)) -> DataFrame:
    """First rows of the log for a look at it, in a fixed order."""
    return log.orderBy(*order, "id").select("key", *TIME_PARTS, "status").limit(n)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATUS).orc(path)


def append_status(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").orc(path)
