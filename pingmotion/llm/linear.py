"""Shared by the trained operators: labelled rows, hash folds and averaged shard models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """``doc_id, text, y`` of about ``rows`` labelled documents outside the held-out fold.

    The rows are picked by a hash of doc_id, so the sample is the same in every run and its size
    has a bound, however many labels there are and however often an id is repeated: an id has one
    row, with its least label and least text. Rows without label, id or text are left out; the few
    rows of labels are small enough to broadcast because of that bound.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("doc_id"), folds) != held)
    )
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    there = known.count()
    if there > rows:
        known = known.where(
            F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * rows / there)
        )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(
        F.col("text").isNotNull()
    )
    # the least text is known before the shuffle, so a repeated id sends one row per task
    return texts.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
