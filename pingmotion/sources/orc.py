"""Partitioned ORC: requests in, results out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import RESULT_KEYS


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a directory tree of ``name=value`` partitions with a declared schema."""
    return spark.read.schema(schema).orc(path)


def hour_slice(
    pings: DataFrame, y: int, m: int, d: int, h: int, stage: int, country: str | None = None
) -> DataFrame:
    """One hour of one stage. The partition columns are compared as they are, so only the
    directories of that hour are listed and read."""
    picked = pings.where(
        (F.col("y") == y)
        & (F.col("m") == m)
        & (F.col("d") == d)
        & (F.col("h") == h)
        & (F.col("stage") == stage)
    )
    return picked if country is None else picked.where(F.col("country") == country)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("country", *RESULT_KEYS),
    replace: bool = False,
    rebalance: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write zlib ORC under ``name=value`` directories.

    ``replace`` swaps the partitions (leaf directories) present in ``df`` and leaves the
    others; runs whose rows may have moved to other leaves are replaced by
    ``publish.publish_runs``. Otherwise rows are appended. ``rebalance`` gathers the
    rows of a directory so that tasks do not each leave a small file in every directory;
    adaptive execution splits the large directories again.
    """
    rows = df.hint("rebalance", *keys) if rebalance else df
    writer = rows.write.partitionBy(*keys).options(compression="zlib", **options or {})
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").orc(path)
    else:
        writer.mode("append").orc(path)
