"""Quality gates. SQL three-valued logic is kept: a null ``too_freq_uid`` with no
``r_s_info`` is neither eligible nor sentinel and leaves the data here; ``gate_census``
makes that visible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import RUN_KEYS, USABLE_GRADES


def confident() -> Column:
    return F.col("sl_adjusted_confidence").isin(*USABLE_GRADES)


def unremarkable() -> Column:
    return (F.col("too_freq_uid") == F.lit(False)) & F.col("r_s_info").isNull()


def flagged() -> Column:
    return (F.col("too_freq_uid") != F.lit(False)) | F.col("r_s_info").isNotNull()


def confident_pings(pings: DataFrame) -> DataFrame:
    return pings.where(confident())


def eligible_pings(pings: DataFrame) -> DataFrame:
    """Pings whose motion is measured."""
    return pings.where(unremarkable() & confident())


def sentinel_pings(pings: DataFrame, wide: bool = False) -> DataFrame:
    """Pings that are answered "not measurable" without being measured.

    ``wide`` is the earlier gate, which also takes the pings without usable confidence.
    """
    return pings.where(flagged() | ~confident() if wide else flagged() & confident())


def gate_census(pings: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """How many rows of each run go which way; the groups are pre-aggregated per input task."""
    sent = F.coalesce(flagged(), F.lit(False))
    passed = F.coalesce(unremarkable(), F.lit(False))
    usable = F.coalesce(confident(), F.lit(False))
    return pings.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count_if(passed & usable).alias("n_eligible"),
        F.count_if(sent & usable).alias("n_sentinel"),
        F.count_if(usable & ~sent & ~passed).alias("n_null_gate"),
        F.count_if(~usable).alias("n_low_confidence"),
        F.count_if(F.col("uid").isNull()).alias("n_no_uid"),
    )
