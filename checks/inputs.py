"""Pings and a status log derived from the ``events`` table by fixed formulas.

The formulas are the ones of FIXTURES.md, so Spark and DuckDB see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# from the parts of the zoneless timestamp, so that the session zone has no say
_MICROS = (
    "(datediff(cast(ts AS date), date'1970-01-01') * 86400000000 + hour(ts) * 3600000000"
    " + minute(ts) * 60000000L + cast(extract(SECOND FROM ts) * 1000000 AS bigint))"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = F.expr("sequence(1, if(event_id % 50 = 0, 2, 1))")
    repeated = events(spark, sf_dir).select("*", F.explode(copies).alias("copy"))
    return repeated.selectExpr(
        "user_id AS uid",
        "event_id AS request_id",
        f"1704092400000 + ({_MICROS} - 1704067200000000) div 120000 AS r_timestamp",
        "4e1 + ((event_id * 7919) % 7) / 1e2 + (cast(floor(value) AS bigint) * 2) / 1e5"
        " + (event_id % 400) / 1e8 AS latitude",
        "-7.4e1 - ((event_id * 104729) % 5) / 1e2 - ((event_id % 499) * 2) / 1e5"
        " - (event_id % 400) / 1e8 AS longitude",
        "CASE WHEN event_id % 97 = 0 THEN null WHEN event_id % 11 = 0 THEN true ELSE false END"
        " AS too_freq_uid",
        "CASE WHEN event_id % 13 = 0 THEN 's' END AS r_s_info",
        "CASE WHEN event_id % 5 < 3 THEN 94 WHEN event_id % 5 = 3 THEN 95 ELSE 90 END"
        " AS sl_adjusted_confidence",
        "CASE WHEN user_id % 10 = 9 THEN 'gb' ELSE 'us' END AS country",
        "CASE event_id % 4 WHEN 0 THEN 'display' WHEN 1 THEN 'display_dr' WHEN 2 THEN 'euwest1'"
        " ELSE 'exchange' END AS logType",
        "2024 AS y",
        "1 AS m",
        "1 AS d",
        f"cast(7 + (({_MICROS} - 1704067200000000) div 120000) div 3600000 AS int) AS h",
        "cast(user_id % 4 AS int) AS stage",
        "CASE WHEN event_id % 2 = 0 THEN 'fill' ELSE 'nf' END AS isFilled",
        "CASE event_id % 3 WHEN 0 THEN 'pos' WHEN 1 THEN 'rest' ELSE 'tll' END AS confScore",
        "cast(event_id % 6 AS int) AS proximity_mode",
        "concat('brand', cast(event_id % 17 AS string)) AS fp_brand",
        "cast(event_id % 2 AS int) AS is_poly",
    )


def request_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings as the request table holds them, without place matches."""
    return pings(spark, sf_dir).drop("proximity_mode", "fp_brand", "is_poly")


def two_day_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request pings of two calendar days, a twentieth of the devices without uid."""
    late = F.expr("(request_id div 7) % 2")
    return request_pings(spark, sf_dir).withColumns(
        {
            "d": (late + 1).cast("int"),
            "r_timestamp": F.col("r_timestamp") + late * 86_400_000,
            "uid": F.when(F.col("uid") % 20 != 0, F.col("uid")),
        }
    )


def matched_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings of a per-day table with none to three place matches, all ten fields of each set, a
    twentieth of the devices without uid."""

    def match(i: int) -> str:
        n = f"(request_id + {i})"
        return (
            f"named_struct('proximity_mode', cast({n} % 6 AS int), 'fp_brand', concat('brand', {n} % 17),"
            f" 'fp_sic', concat('sic', {n} % 5), 'weight', cast(({n} % 8) / 8 AS float), 'hash_key', concat('h', {n} % 101),"
            f" 'is_poly', cast({n} % 2 AS int), 'block_id', cast({n} % 1000 AS int), 'is_employee', {n} % 3 = 0,"
            f" 'open_status', if({n} % 4 = 0, null, 'open'), 'ha_match', {n} % 7 = 0)"
        )

    return pings(spark, sf_dir).selectExpr(
        "if(uid % 20 = 0, null, uid) AS uid",
        "r_timestamp",
        "latitude",
        "longitude",
        f"slice(array({match(1)}, {match(2)}, {match(3)}), 1, cast(request_id % 4 AS int)) AS fp_matches",
        "lpad(cast(h AS string), 2, '0') AS hour",
    )


def footprint_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings as a per-day table holds them: nested place matches and the hour as text."""
    nothing = F.lit(None)
    match = F.struct(
        F.col("proximity_mode"),
        F.col("fp_brand"),
        nothing.cast("string").alias("fp_sic"),
        nothing.cast("float").alias("weight"),
        nothing.cast("string").alias("hash_key"),
        F.col("is_poly"),
        nothing.cast("int").alias("block_id"),
        nothing.cast("boolean").alias("is_employee"),
        nothing.cast("string").alias("open_status"),
        nothing.cast("boolean").alias("ha_match"),
    )
    return pings(spark, sf_dir).select(
        "uid",
        "r_timestamp",
        "latitude",
        "longitude",
        F.array(match).alias("fp_matches"),
        F.lpad(F.col("h").cast("string"), 2, "0").alias("hour"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = events(spark, sf_dir).selectExpr(
        "event_id",
        "ts",
        "concat('us/', cast(user_id % 4 AS string), '/') AS place",
        "cast(user_id % 4 AS int) AS s",
        "year(ts) AS year",
        "month(ts) AS month",
        "day(ts) AS day",
        "hour(ts) AS hour",
    )
    arrived = base.selectExpr(
        "event_id AS id",
        "ts AS timestamp",
        "concat('ard/', place) AS key",
        "year",
        "month",
        "day",
        "CASE WHEN event_id % 50 = 0 THEN null ELSE hour END AS hour",
        "1 AS status",
        "cast(null AS string) AS metadata",
    )
    finished = base.where("event_id % 3 = 0 AND day <= 27 + s % 4").selectExpr(
        "-event_id AS id",
        "ts AS timestamp",
        "concat('derived_speed/', place) AS key",
        "year",
        "month",
        "day",
        "hour",
        "CASE WHEN event_id % 9 = 0 THEN 0 ELSE 1 END AS status",
        "concat('run-', cast(event_id AS string)) AS metadata",
    )
    return arrived.unionByName(finished)


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as people write them: all four delimiters, missing right parts, empty."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "concat(CASE event_id % 2 WHEN 0 THEN 'ard/us/' ELSE 'derived_speed/us/' END,"
        " cast(user_id % 4 AS string), '/') AS key",
        """CASE event_id % 6
             WHEN 0 THEN date_format(ts, 'yyyy/MM/dd/HH')
             WHEN 1 THEN date_format(ts, 'yyyy-MM-dd')
             WHEN 2 THEN date_format(ts, 'yyyy MM')
             WHEN 3 THEN date_format(ts, 'yyyy-MM-dd HH')
             WHEN 4 THEN date_format(ts, 'yyyy:MM:dd:HH')
             ELSE '' END AS time""",
    )


def hour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that fits the pings: every hour has input, the early ones have a result."""
    runs = request_pings(spark, sf_dir).groupBy("country", "stage", "y", "m", "d", "h").agg(
        F.min("request_id").alias("id")
    )

    def rows(prefix: str) -> list[str]:
        return [
            "id",
            "timestamp_ntz'2024-01-02 00:00:00' AS timestamp",
            f"concat('{prefix}', country, '/', cast(stage AS string), '/') AS key",
            "y AS year",
            "m AS month",
            "d AS day",
            "h AS hour",
            "1 AS status",
            "cast(null AS string) AS metadata",
        ]

    arrived = runs.selectExpr(*rows("ard/"))
    finished = runs.where("h <= 8 + stage % 3").selectExpr(*rows("derived_speed/"))
    return arrived.unionByName(finished)


def first_runs_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hour_log`` before anything ran in gb, and with daily results only for us stage 2."""
    log = hour_log(spark, sf_dir)
    done = "key NOT LIKE 'derived_speed/gb/%'"
    daily = "CASE WHEN key = 'derived_speed/us/2/' THEN null ELSE hour END AS hour"
    return log.where(done).selectExpr(*[daily if c == "hour" else c for c in log.columns])


def partial_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that leave out any parts: holes in the time, no key, neither."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "CASE WHEN event_id % 5 = 0 THEN null ELSE concat(CASE event_id % 2 WHEN 0 THEN 'ard/us/'"
        " ELSE 'derived_speed/us/' END, cast(user_id % 4 AS string), '/') END AS key",
        """CASE event_id % 8
             WHEN 0 THEN date_format(ts, 'yyyy-MM-dd-HH')
             WHEN 1 THEN concat(year(ts), '-xx-', day(ts))
             WHEN 2 THEN concat('--', day(ts), '-', hour(ts))
             WHEN 3 THEN concat('?/', month(ts), '/?/', hour(ts))
             WHEN 4 THEN concat(year(ts), '///', hour(ts))
             WHEN 5 THEN cast(year(ts) AS string)
             WHEN 6 THEN concat('x:x:', day(ts))
             ELSE '' END AS time""",
    )
