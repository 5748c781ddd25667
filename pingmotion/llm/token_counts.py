"""Token counts from a digest cache.

The cache is a Parquet table ``(tokenizer, digest, n_tokens)``. Texts are normalised (null is the
empty text; nothing else, since this vocabulary has no normaliser and any other change could
change the count) and digested; digests without an entry for this tokenizer version are encoded
once each, appended, and every row takes its count from the cache.

Only digests and ids are grouped. A hot digest (a third of all rows may be copies) pre-aggregates
in the grouping and meets one cache row in the final join, which adaptive execution can split.

Texts share most of their words. Where the vocabulary lets no token reach over the start of a word,
each task has the library count a word once and remembers it; other vocabularies get whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, stored

CACHE = "tokenizer string, digest string, n_tokens long"
#: texts encoded in one call, in characters; longer texts go alone
CALL_CHARS = 1 << 16
#: words whose counts a task remembers, when full, it starts over; longer words are not remembered
REMEMBERED = 1 << 19
REMEMBERED_CHARS = 64
#: characters that no version of Unicode has as white space
_SOLID = r"[^\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u206f\u3000\ufeff]"
#: where the byte-level pattern always begins a token: at a single space between two such characters,
#: at a mark after a letter, at the end of a line
_MARKS = ".,;:!?"
_STARTS = re.compile(f"(?<={_SOLID})(?= {_SOLID})|(?<=[A-Za-z])(?=[{_MARKS}])|(?<={_SOLID})(?=\n)")


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: another file never reuses counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark, cache: str | None) -> DataFrame:
    """The cache, empty if it is not there yet; entries written twice count once."""
    if cache is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(cache)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            rows = spark.read.schema(CACHE).parquet(cache)
            return rows.groupBy("tokenizer", "digest").agg(F.min("n_tokens").alias("n_tokens"))
    return spark.createDataFrame([], CACHE)


def counted_by_word(path: str) -> bool:
    """Whether the counts of a text's parts, cut at ``_STARTS``, add up to that of the text.

    So it is if the byte-level pattern splits texts as they are, nothing is random, and no added token
    stands across a cut or depends on what is around it.
    """
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)
    splitter, model = vocabulary.get("pre_tokenizer") or {}, vocabulary.get("model") or {}
    return (
        vocabulary.get("normalizer") is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex") is True
        and splitter.get("add_prefix_space") is False
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and all(
            not re.search(rf"[\s{_MARKS}]", t["content"]) and not (t["single_word"] or t["lstrip"] or t["rstrip"])
            for t in vocabulary.get("added_tokens") or []
        )
    )


class Counter:
    """Token counts of texts by a tokenizers file, whole or word by word."""

    def __init__(self, path: str, by_word: bool):
        # Spark spreads the work; threads of the library would only add memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = by_word
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return self._library(texts)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        split = [_STARTS.split(text) for text in texts]
        new = [word for word in set().union(*split) if word not in known]
        known.update(zip(new, self._library(new)))
        out = [sum(map(known.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > REMEMBERED_CHARS:
                del known[word]
        return out

    def _library(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encode(vocabulary: str, version: str, by_word: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(SparkFiles.get(vocabulary), by_word).counts
        for batch in batches:
            got, waiting, size = [], [], 0
            for text in batch["text"]:
                text = text.as_py()
                if waiting and size + len(text) > CALL_CHARS:
                    got += counts(waiting)
                    waiting, size = [], 0
                waiting.append(text)
                size += len(text)
            if waiting:
                got += counts(waiting)
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(got)), batch["digest"], pa.array(got, pa.int64())],
                ["tokenizer", "digest", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, vocabulary: str, cache: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row of ``docs(doc_id, text, ...)``.

    ``vocabulary`` is a tokenizers file on the driver, sent to the executors; ``cache`` a folder
    that all of them share. Null text counts as empty (0 bytes, 0 tokens). Repeated rows and
    rows without doc_id each return one row. Other columns are not looked at.
    """
    spark = docs.sparkSession
    version = tokenizer_version(vocabulary)
    spark.sparkContext.addFile(vocabulary)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", F.sha2("text", 256))
    keyed = stored(texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    known = read_cache(spark, cache).where(F.col("tokenizer") == version)
    misses = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(known, "digest", "left_anti")
    misses = misses.select("digest", F.col("doc_id").alias("holder"))
    wanted = texts.join(
        misses, (texts["digest"] == misses["digest"]) & texts["doc_id"].eqNullSafe(misses["holder"]), "left_semi"
    )
    fresh = wanted.select("digest", "text").mapInArrow(
        _encode(vocabulary.rsplit("/", 1)[-1], version, counted_by_word(vocabulary)), CACHE
    )
    # a repeated row is its digest's holder as often as it stands
    once = fresh.groupBy("tokenizer", "digest").agg(F.min("n_tokens").alias("n_tokens"))
    with small_batches(spark, 500):
        once.write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
