"""Catalog tables: per-day request tables in, partitions of a result table out."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date, timedelta
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FOOTPRINT_RESULT


def day_table_name(pattern: str, day: date) -> str:
    """Table of a day; the pattern holds ``{yymmdd}``."""
    return pattern.format(yymmdd=day.strftime("%y%m%d"))


def read_day(spark: SparkSession, pattern: str, day: date, hour: str | None = None) -> DataFrame:
    """One day's table, all hours or one, with ``dt`` and ``hr`` as run keys."""
    table = spark.table(day_table_name(pattern, day))
    if hour is not None:
        table = table.where(F.col("hour") == hour)
    return table.withColumns({"dt": F.lit(day.isoformat()), "hr": F.col("hour")})


def read_days(spark: SparkSession, pattern: str, first: date, days: int) -> list[DataFrame]:
    return [read_day(spark, pattern, first + timedelta(days=i)) for i in range(days)]


def create_footprint_table(spark: SparkSession, table: str, path: str) -> None:
    """An empty ORC table for footprint results, partitioned by (dt, hr), kept at ``path``."""
    hr = FOOTPRINT_RESULT["hr"]
    columns = [f for f in FOOTPRINT_RESULT.fields if f is not hr]
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE {table} ({body}, dt string, hr string)"
        f" USING orc PARTITIONED BY (dt, hr) LOCATION '{path}'"
    )


_overwrite_lock = Lock()  # the setting is the session's, and threads may share one


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """An insert into a table takes the mode from the session and not from the writer."""
    name = "spark.sql.sources.partitionOverwriteMode"
    with _overwrite_lock:
        before = spark.conf.get(name)
        spark.conf.set(name, mode)
        try:
            yield
        finally:
            spark.conf.set(name, before)


def insert_partitions(
    df: DataFrame,
    table: str,
    replace: bool = False,
    partition: dict[str, str] | None = None,
    keys: Sequence[str] = ("dt", "hr"),
) -> None:
    """Insert into the partitions of a table, matching columns by name.

    ``partition`` fixes partition columns that ``df`` lacks. ``replace`` swaps only the
    partitions present in ``df``.
    """
    rows = df.withColumns({k: F.lit(v) for k, v in (partition or {}).items()})
    # also puts the fields of nested rows in the order of the table
    rows = rows.to(rows.sparkSession.table(table).schema)
    with _overwrite_mode(rows.sparkSession, "dynamic"):
        rows.hint("rebalance", *keys).write.insertInto(table, overwrite=replace)


def name_result(df: DataFrame, name: str) -> DataFrame:
    """Make a result usable in SQL text under a name."""
    df.createOrReplaceTempView(name)
    return df
