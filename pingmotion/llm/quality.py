"""Quality scores by logistic regression on hashed word n-grams, trained with FTRL.

Features are hashed 1- and 2-grams of three word sequences: the words in lower case, the words
with their case, digits and marks reduced to a shape, and what each word repeats (the word
before it, one of the eight before it, or none). A feature's value is its count over the root of
the sum of squared counts of its text, so long texts score on the scale of short ones. Weights
are learnt one text at a time by follow-the-regularised-leader; several workers each train on a
share of the sample, and the weights are averaged. A score is a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .linear import labelled_sample

FOLDS, HELD = 5, 0
#: about so many labelled texts are used to fit, however many there are
TRAIN_ROWS = 16_000
SHARES = 2
PASSES = 8
HASH_BITS = 18
#: of follow-the-regularised-leader: step, smoothing, L1 and L2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.02

_U = np.uint64
_CLASS = np.full(256, 4, np.uint8)  # 1 upper, 2 lower, 3 digit, 4 mark, 5 beyond ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 5


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First class, last class, set of classes, repeat of the last byte and size class of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    kinds = _CLASS[data]
    seen = np.bitwise_or.reduceat((1 << kinds).astype(np.uint8), starts)
    # reduceat runs to the next start and so includes the white space between, which is a mark
    last_mark = kinds[ends - 1] == 4
    inner_mark = np.add.reduceat((kinds == 4).astype(np.int64), starts) - np.add.reduceat(
        W.IS_SPACE[data].astype(np.int64), starts
    )
    size = np.minimum(np.log2(ends - starts + 1).astype(np.int64), 7)
    doubled = (ends - starts > 1) & (data[ends - 1] == data[np.maximum(ends - 2, 0)])
    tail = np.where(last_mark, data[ends - 1], 0).astype(np.uint64)
    return (
        kinds[starts].astype(np.uint64)
        | (seen & 0b101110).astype(np.uint64) << _U(4)
        | np.minimum(inner_mark, 3).astype(np.uint64) << _U(12)
        | size.astype(np.uint64) << _U(16)
        | doubled.astype(np.uint64) << _U(20)
        | tail << _U(24)
    )


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, slot, value)`` of all features of a piece, by text and slot."""
    starts, ends, ptr = W.word_spans(data, offsets)
    hashes = W.word_hashes(data, starts, ends)
    text = W.text_of_word(ptr)
    n = len(hashes)
    place = np.arange(n) - ptr[:-1][text] if n else np.zeros(0, np.int64)
    repeat = np.zeros(n, np.uint64)
    for back in range(8, 0, -1):
        same = np.zeros(n, bool)
        same[back:] = hashes[back:] == hashes[: max(n - back, 0)]
        repeat[same & (place >= back)] = 1 if back == 1 else 2
    streams = [hashes, W.mix(_shapes(data, starts, ends) + _U(1 << 40)), W.mix(repeat + _U(1 << 41))]
    texts, slots = [], []
    for s, stream in enumerate(streams):
        texts.append(text)
        slots.append(W.mix(stream + _U(s)))
        if n > 1:
            pair = place[1:] > 0
            texts.append(text[1:][pair])
            slots.append(W.mix(stream[:-1] * _U(3) + stream[1:] * _U(5) + _U(100 + s))[pair])
    text = np.concatenate(texts).astype(np.uint64)
    slot = np.concatenate(slots) & _U((1 << HASH_BITS) - 1)
    both, count = np.unique(text << _U(HASH_BITS) | slot, return_counts=True)
    text = (both >> _U(HASH_BITS)).astype(np.int64)
    slot = (both & _U((1 << HASH_BITS) - 1)).astype(np.int64)
    norm = np.sqrt(np.bincount(text, count.astype(float) ** 2, minlength=len(offsets) - 1))
    return text, slot, count / norm[text]


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int) -> tuple[np.ndarray, float]:
    z = np.zeros(1 << HASH_BITS)
    n = np.zeros(1 << HASH_BITS)
    bias = bias_n = 0.0
    rng = np.random.default_rng(seed)
    weight = lambda i: np.where(
        np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
    )
    for _ in range(PASSES):
        for at in rng.permutation(len(rows)):
            slot, value, y = rows[at]
            w = weight(slot)
            p = 1 / (1 + np.exp(-np.clip(w @ value + bias, -35, 35)))
            g = (p - y) * value
            z[slot] += g - (np.sqrt(n[slot] + g * g) - np.sqrt(n[slot])) / ALPHA * w
            n[slot] += g * g
            bias_n += (p - y) ** 2
            bias -= 0.1 * (p - y) / np.sqrt(1 + bias_n)
    return weight(np.arange(len(z))), bias


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights (2**18 of them, the size is fixed) and bias."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        seen, column = [], pa.array(pdf["text"], pa.large_string())
        for first, _, data, offsets in W.pieces(column):
            text, slot, value = features(data, offsets)
            cut = np.searchsorted(text, np.arange(len(offsets)))
            for i in range(len(offsets) - 1):
                seen.append((slot[cut[i] : cut[i + 1]], value[cut[i] : cut[i + 1]], int(pdf["y"].iat[first + i])))
        weights, bias = _ftrl(seen, 1)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"slot": np.append(used, -1), "weight": np.append(weights[used], bias)})

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD, rows)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
    parts = sample.groupBy(share.alias("share")).applyInPandas(fit, "slot long, weight double")
    mean = parts.groupBy("slot").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    weights, bias = np.zeros(1 << HASH_BITS, np.float32), 0.0
    for row in mean.collect():  # at most 2**18 + 1 rows
        if row["slot"] < 0:
            bias = row["weight"] / row["n"]
        else:
            weights[row["slot"]] = row["weight"] / SHARES
    return weights, bias


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str] | None = None) -> DataFrame:
    """``docs`` columns named in ``keep`` (default doc_id) with ``quality_score`` from 0 to 1.

    Null and empty texts have no features and score by the bias alone.
    """
    keep = keep or ["doc_id"]
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = weights.value
        for batch in batches:
            for first, end, data, offsets in W.pieces(batch["__text"]):
                text, slot, value = features(data, offsets)
                raw = np.bincount(text, w[slot] * value, minlength=end - first) + bias
                score = pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35))))
                yield pa.RecordBatch.from_arrays(
                    [*(batch[i].slice(first, end - first) for i in range(len(keep))), score], [*keep, "quality_score"]
                )

    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("quality_score", "double")
    return rows.mapInArrow(run, schema)
