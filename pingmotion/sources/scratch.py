"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. Only a local session without one falls
    back to a folder of this machine; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pingmotion-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as they are now, kept in the shared folder, so that later reads see
    neither new input nor a recomputation."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
