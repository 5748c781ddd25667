"""Tables between the steps of an operator: written to the shared folder and read again.

A written table cuts the lineage, so a lost executor costs the tasks of one step, not all.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder

#: slots of a bitmap: 512 KB, however many keys it holds
BITMAP_SLOTS = 1 << 22


_batch_lock = RLock()  # the setting is the session's, and threads may share one


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Texts go to Python tasks so many rows at a time while steps run in here. A batch is held
    by the executor, by Arrow and by the worker at once, and the default is ten times as long.
    Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with _batch_lock:
        before = spark.conf.get(name)
        spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
        try:
            yield
        finally:
            spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a Parquet table in the shared folder."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_SLOTS))


def bitmap(keys: DataFrame, column: str) -> DataFrame:
    """One row ``bits``: an array of longs of fixed size that marks the hashed keys.

    Used to keep rows that surely have no partner out of a shuffle. False hits are harmless
    (an exact join follows), so the table may be as large as it likes while the bitmap is not.
    """
    spark = keys.sparkSession
    slot = _slot(F.col(column))
    marks = keys.groupBy(F.shiftright(slot, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), {BITMAP_SLOTS}L) & 63L AS int))")).alias("m")
    )
    slots = spark.range(BITMAP_SLOTS >> 6).withColumnRenamed("id", "w")
    whole = slots.join(marks, "w", "left").select("w", F.coalesce("m", F.lit(0)).alias("m"))
    return whole.agg(F.array_sort(F.collect_list(F.struct("w", "m"))).alias("all")).select(
        F.transform("all", lambda x: x["m"]).alias("bits")
    )


def marked(bits: Column, key: Column) -> Column:
    """Whether the bitmap has the key's slot; a false yes is possible, a false no is not."""
    slot = _slot(key)
    word = F.get(bits, F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1
