"""A training corpus from raw documents: each stage works on all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again for the next. All but the last return the columns of ``documents``. An empty table, null
texts and repeated rows pass through every stage by the rules of its operator; other columns of
``documents`` stay as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pingmotion.llm import bpe, decontaminate, near_dedup, pii, quality
from pingmotion.llm.tables import stored

#: documents scored below it go
QUALITY_CUT = 0.3
#: percent of shingle sets that near duplicates share
SIMILARITY = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.quality_scores(docs, quality.train(docs, labels), docs.columns)
    return scored.where(F.col("quality_score") >= QUALITY_CUT).drop("quality_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id; of its rows the one with the
    least text, a null text last. Rows without doc_id stay."""
    groups = near_dedup.near_duplicates(docs, SIMILARITY)
    kept = groups.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__kept")).distinct()
    there = docs.join(kept, docs["doc_id"] == kept["__kept"], "left_semi")
    one = there.groupBy("doc_id").count().where("count > 1")
    if one.limit(1).count():
        rows = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), F.xxhash64(*docs.columns))
        there = there.withColumn("__row", F.row_number().over(rows)).where("__row = 1").drop("__row")
    return there.unionByName(docs.where("doc_id IS NULL"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; rows without doc_id are judged one by one."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaking = stored(decontaminate.leaks(docs, benchmark).select("doc_id").distinct(), "leaking")
    named = docs.join(leaking, "doc_id", "left_anti").select(*docs.columns)
    if not leaking.where("doc_id IS NULL").limit(1).count():
        return named
    # a null id never joins: such rows get a number of their own, written so that it stays
    nameless = docs.where("doc_id IS NULL").withColumn("__row", F.monotonically_increasing_id())
    nameless = stored(nameless, "nameless")
    found = decontaminate.leaks(nameless.select(F.col("__row").alias("doc_id"), "text"), benchmark)
    found = stored(found.select(F.col("doc_id").alias("__row")).distinct(), "leaking-nameless")
    clean = nameless.join(found, "__row", "left_anti").select(*docs.columns)
    return named.where("doc_id IS NOT NULL").unionByName(clean)


def generalise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced by their kind; ``n_chars`` follows."""
    found = pii.private_spans(docs, docs.columns)
    text = pii.redacted(F.col("text"), F.col("spans"))
    out = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    clean = found.select(*out, (F.size("spans") > 0).alias("__changed"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        length = F.when(F.col("__changed"), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", length)
    return clean.drop("__changed")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids``: token ids that decode to the text again."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "text"])
    whole = F.decode("decoded", "UTF-8") == F.coalesce("text", F.lit(""))
    ids = F.when(whole, F.col("ids")).otherwise(F.raise_error(F.lit("ids do not decode to the text")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("PII", generalise_personal_data),
    ("byte-level BPE", encode),
]

#: trained scores, MinHash candidates, walks and merges are not SQL; tests/llm has brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
