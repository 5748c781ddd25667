"""Give every member of a bucket the answer of its bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import NOT_MEASURABLE, RUN_KEYS


def fan_out(members: DataFrame, motion: DataFrame, run_keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Left join of members to the bucket answers; unanswered members get -1 for both.

    Only the two numbers of an answer travel, and the members stay rows, so a bucket of
    any size streams through the join. The members are the left side of an outer join
    directly above its shuffle: adaptive execution can split a crowded bucket over many
    tasks. ``uid`` is compared null-safely because the pings without uid are one group.
    """
    answers = motion.select(
        *[F.col(c).alias(f"_{c}") for c in (*run_keys, "uid", "sec")], "dspd", "angle"
    )
    same = F.col("uid").eqNullSafe(F.col("_uid")) & (F.col("sec") == F.col("_sec"))
    for key in run_keys:
        same = same & (F.col(key) == F.col(f"_{key}"))
    missing = F.lit(NOT_MEASURABLE)
    return members.join(answers, same, "left").select(
        *members.columns,
        F.coalesce("dspd", missing).alias("dspd"),
        F.coalesce("angle", missing).alias("angle"),
    )
