"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder
from . import (
    bpe,
    decontaminate,
    exact_dedup,
    merkle,
    near_dedup,
    oracles,
    phrases,
    pii,
    quality,
    token_counts,
    topk,
    toxicity,
    urls,
    warc,
)
from .linear import fold

#: at this score or more a label of 1 is predicted
CUT = 0.3
TOKEN_LIMIT = 512
URL_RULES: list[urls.Rule] = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), 85)


def op2_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = quality.quality_scores(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return _predicted(scored, "quality_score", quality.FOLDS, quality.HELD)


def _predicted(scored: DataFrame, score: str, folds: int, held: int) -> DataFrame:
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= CUT).cast("int").alias("predicted"),
    )


def op3_private_spans(spark, sf_dir):
    found = pii.private_spans(_table(spark, sf_dir, "documents"))
    counts = [F.aggregate("base", F.lit(0).cast("long"), _counter(kind)).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *counts,
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def _counter(kind: str):
    return lambda n, s: n + F.when(s["kind"] == kind, 1).otherwise(0)


def op4_top_k(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    coded = bpe.encode_decode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.toxic_spans(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return _predicted(scored, "toxicity", toxicity.FOLDS, toxicity.HELD)


def op7_token_counts(spark, sf_dir):
    counted = token_counts.token_counts(
        _table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), new_folder(spark, "token-cache")
    )
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_warc(spark, sf_dir):
    read = warc.read_bundles(warc.write_bundles(_table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_leaks(spark, sf_dir):
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_url_filter(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    seen = urls.judged(pages, URL_RULES, urls.train(pages, URL_RULES))
    return seen.select("page_id", "host", "path", "rule", "verdict")


def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op12_phrases(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_exact_duplicates(spark, sf_dir):
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_quality,
        op3_private_spans,
        op4_top_k,
        op5_bpe,
        op6_toxicity,
        op7_token_counts,
        op8_warc,
        op9_leaks,
        op10_url_filter,
        op11_merkle_manifest,
        op12_phrases,
        op13_exact_duplicates,
    )
}

ORACLES: dict[str, str] = {
    "op4_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        ) WHERE rank <= 5""",
    # similar pairs that the signatures miss, fewer than one in 100,000, would differ here
    "op1_near_duplicates": oracles.NEAR,
    "op8_warc": oracles.WARC,
    "op11_merkle_manifest": oracles.MERKLE,
    "op12_phrases": oracles.PHRASES,
    "op13_exact_duplicates": oracles.EXACT,
}
