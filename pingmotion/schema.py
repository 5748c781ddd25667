"""Declared schemas of the tables that enter and leave the library."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FOOTPRINT = T.StructType(
    [
        T.StructField("proximity_mode", T.IntegerType()),
        T.StructField("fp_brand", T.StringType()),
        T.StructField("fp_sic", T.StringType()),
        T.StructField("weight", T.FloatType()),
        T.StructField("hash_key", T.StringType()),
        T.StructField("is_poly", T.IntegerType()),
        T.StructField("block_id", T.IntegerType()),
        T.StructField("is_employee", T.BooleanType()),
        T.StructField("open_status", T.StringType()),
        T.StructField("ha_match", T.BooleanType()),
    ]
)

FOOTPRINT_RESULT = T.StructType(
    [
        T.StructField("hr", T.StringType()),
        T.StructField("fp_matches", T.ArrayType(FOOTPRINT)),
        T.StructField("dspd", T.DoubleType()),
        T.StructField("angle", T.DoubleType()),
        T.StructField("uid", T.StringType()),
    ]
)

STATUS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("key", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("metadata", T.StringType()),
    ]
)


def ping_schema(id_type: T.DataType | None = None, uid_type: T.DataType | None = None) -> T.StructType:
    """Request pings as stored: measured columns first, then the partition columns.

    Declaring the partition columns keeps ``h=05`` from being guessed as text or number by chance.
    """
    return T.StructType(
        [
            T.StructField("request_id", id_type or T.StringType()),
            T.StructField("uid", uid_type or T.StringType()),
            T.StructField("r_timestamp", T.LongType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("too_freq_uid", T.BooleanType()),
            T.StructField("r_s_info", T.StringType()),
            T.StructField("sl_adjusted_confidence", T.IntegerType()),
            T.StructField("country", T.StringType()),
            T.StructField("logType", T.StringType()),
            T.StructField("y", T.IntegerType()),
            T.StructField("m", T.IntegerType()),
            T.StructField("d", T.IntegerType()),
            T.StructField("h", T.IntegerType()),
            T.StructField("stage", T.IntegerType()),
            T.StructField("isFilled", T.StringType()),
            T.StructField("confScore", T.StringType()),
        ]
    )


def result_schema(id_type: T.DataType | None = None) -> T.StructType:
    """Result rows as stored: the time parts are two-character text."""
    return T.StructType(
        [
            T.StructField("request_id", id_type or T.StringType()),
            T.StructField("derived_speed", T.StringType()),
            T.StructField("country", T.StringType()),
            T.StructField("logType", T.StringType()),
            T.StructField("y", T.IntegerType()),
            T.StructField("m", T.StringType()),
            T.StructField("d", T.StringType()),
            T.StructField("h", T.StringType()),
            T.StructField("stage", T.IntegerType()),
            T.StructField("isFilled", T.StringType()),
            T.StructField("confScore", T.StringType()),
        ]
    )


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail while the plan is built, not in a task, when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
