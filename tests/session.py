from __future__ import annotations

from pyspark.sql import SparkSession

from pingmotion.session import with_settings


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    builder = with_settings(SparkSession.builder.master(f"local[{cores}]"))
    spark = (
        builder.appName("pingmotion")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
