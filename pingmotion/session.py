"""Session settings the jobs are designed for. All but the shuffle ones are Spark defaults
that a site may have switched off."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a crowded bucket over many tasks when its members meet their answer
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # splits large result directories when they are written
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # with many partitions, map tasks report small blocks as an average; this keeps the
    # blocks of a hot partition exact, so that it is seen as skewed
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.session.timeZone": "UTC",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
