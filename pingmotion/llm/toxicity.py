"""Toxic spans by a linear-chain conditional random field over the words of whole texts.

Two states, clean and toxic. A word's score is a sum of hashed features: the word itself, its first
and last characters, its neighbours. Labels are given per document, so the training words are
labelled first: a word is toxic in a toxic document if documents that hold it, or words with its
first bytes, are toxic nearly always (lower confidence bound of that rate at least ``PURE``). The field is fitted by gradient
steps on the log-likelihood; expectations come from forward-backward. Scoring runs
forward-backward over every word and takes marginals; a document's score is the chance that at
least one of its words with a marginal of ``WORD_CHANCE`` is toxic, calibrated on the labels, and words with a marginal of a half or more give the offending offsets.

Forward-backward of two states is a chain of fractional-linear maps of the ratio of the two
messages. A piece's words are laid out in columns; the maps of a column are composed for all
columns at once, the ratio is carried over the columns, and then run through each. The cost is
a few array operations per word, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .linear import labelled_sample

FOLDS, HELD = 4, 2
#: about so many labelled texts are used to fit, however many there are
TRAIN_ROWS = 10_000
PURE = 0.6
HEAD_BYTES = 4
CLEAN_SHARE = 2
HASH_BITS = 18
STEPS, RATE, DECAY = 25, 1.0, 1e-6
COLUMN = 256
#: words below this marginal do not count towards a document's score
WORD_CHANCE = 0.1

_U = np.uint64


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Slots of the features of each word: five columns. Text edges have neighbours of their own."""
    mask = _U((1 << HASH_BITS) - 1)
    word = W.word_hashes(data, starts, ends)
    head = W.word_hashes(data, starts, np.minimum(ends, starts + 4))
    tail = W.word_hashes(data, np.maximum(starts, ends - 4), ends)
    left, right = np.full(len(word), _U(1)), np.full(len(word), _U(2))
    left[1:], right[:-1] = word[:-1], word[1:]
    filled = np.diff(ptr) > 0
    left[ptr[:-1][filled]] = _U(1)
    right[ptr[1:][filled] - 1] = _U(2)
    columns = [W.mix(x * _U(2 * i + 3) + _U(i)) & mask for i, x in enumerate((word, head, tail, left, right))]
    return np.stack(columns, axis=1).astype(np.int64)


def _compose(a, b, c, d):
    """Per column, the map that all its steps make together, scaled against overflow."""
    A, B, C, D = np.ones(a.shape[1]), np.zeros(a.shape[1]), np.zeros(a.shape[1]), np.ones(a.shape[1])
    for i in range(a.shape[0]):
        A, B, C, D = a[i] * A + b[i] * C, a[i] * B + b[i] * D, c[i] * A + d[i] * C, c[i] * B + d[i] * D
        top = np.maximum(np.maximum(A, B), np.maximum(C, D))
        A, B, C, D = A / top, B / top, C / top, D / top
    return A, B, C, D


def _scan(a, b, c, d, start: float) -> np.ndarray:
    """``x[t] = (a[t] x[t-1] + b[t]) / (c[t] x[t-1] + d[t])`` for all t, from ``start``."""
    n = len(a)
    if not n:
        return np.zeros(0)
    columns = -(-n // COLUMN)
    pad = columns * COLUMN - n

    def laid(x, fill):
        return np.append(x, np.full(pad, fill)).reshape(columns, COLUMN).T

    a, b, c, d = laid(a, 1.0), laid(b, 0.0), laid(c, 0.0), laid(d, 1.0)
    A, B, C, D = (x.tolist() for x in _compose(a, b, c, d))
    x, enter = start, np.empty(columns)
    for k in range(columns):
        enter[k] = x
        x = (A[k] * x + B[k]) / (C[k] * x + D[k])
    out = np.empty((COLUMN, columns))
    for i in range(COLUMN):
        enter = (a[i] * enter + b[i]) / (c[i] * enter + d[i])
        out[i] = enter
    return out.T.ravel()[:n]


def forward_backward(score: np.ndarray, ptr: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios toxic to clean of the forward messages (own word included) and the backward messages.

    ``score`` is the log-odds of each word alone, ``move[i][j]`` the weight from state i to j.
    """
    n = len(score)
    e = np.exp(np.clip(score, -30, 30))
    m = np.exp(move)
    filled = np.diff(ptr) > 0
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ptr[:-1][filled]] = True
    last[ptr[1:][filled] - 1] = True
    # forward: x[t] = e[t] (m01 + m11 x) / (m00 + m10 x); a text begins at e[t]
    a = np.where(first, 0.0, e * m[1, 1])
    b = np.where(first, e, e * m[0, 1])
    c = np.where(first, 0.0, m[1, 0])
    d = np.where(first, 1.0, m[0, 0])
    forward = _scan(a, b, c, d, 1.0)
    # backward: y[t] = (m10 + m11 e[t+1] y) / (m00 + m01 e[t+1] y); a text ends at 1
    nxt = np.append(e[1:], 1.0)
    a = np.where(last, 0.0, m[1, 1] * nxt)
    b = np.where(last, 1.0, m[1, 0])
    c = np.where(last, 0.0, m[0, 1] * nxt)
    d = np.where(last, 1.0, m[0, 0])
    backward = _scan(a[::-1], b[::-1], c[::-1], d[::-1], 1.0)[::-1]
    return forward, backward


def marginals(score: np.ndarray, ptr: np.ndarray, move: np.ndarray) -> np.ndarray:
    forward, backward = forward_backward(score, ptr, move)
    odds = forward * backward
    return odds / (1 + odds)


def _move_chances(score, forward, backward, at, move):
    """Summed chances of the four moves into the words ``at``."""
    e, m, f, y = np.exp(np.clip(score[at], -30, 30)), np.exp(move), forward[at - 1], backward[at]
    w = [np.full(len(at), m[0, 0]), m[0, 1] * e * y, f * m[1, 0], f * m[1, 1] * e * y]
    total = w[0] + w[1] + w[2] + w[3]
    return np.array([(x / total).sum() for x in w]).reshape(2, 2)


def _pure(name: np.ndarray, text: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per word whether texts that hold its name are toxic nearly always."""
    names, inverse = np.unique(name, return_inverse=True)
    both = np.unique(inverse.astype(np.int64) * len(y) + text)
    holder, held = np.divmod(both, len(y))
    n = np.bincount(holder, minlength=len(names))
    p, z = np.bincount(holder, y[held], minlength=len(names)) / n, 1.96
    low = (p + z * z / (2 * n) - z * np.sqrt((p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)
    return (low >= PURE)[inverse]


def _fit(slots: np.ndarray, tags: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    size = 1 << HASH_BITS
    weights, bias, move = np.zeros(size), -4.0, np.zeros((2, 2))
    # adaptive steps: each weight by the root of its summed squared gradients
    seen, seen_bias, seen_move = np.full(size, 1e-3), 1e-3, np.full((2, 2), 1e-3)
    inner = np.ones(len(tags), bool)
    inner[ptr[:-1][np.diff(ptr) > 0]] = False
    at = np.flatnonzero(inner)
    moves = np.zeros((2, 2))
    np.add.at(moves, (tags[at - 1].astype(int), tags[at].astype(int)), 1)
    scale = np.sqrt(max(tags.sum(), 1))
    for _ in range(STEPS):
        score = bias + np.zeros(len(tags))
        for column in slots:
            score += weights[column]
        forward, backward = forward_backward(score, ptr, move)
        odds = forward * backward
        gap = tags - odds / (1 + odds)
        g = -DECAY * weights
        for column in slots:
            g += np.bincount(column, gap, minlength=size) / scale
        gm = (moves - _move_chances(score, forward, backward, at, move)) / scale
        seen += g * g
        seen_bias += (gap.sum() / scale) ** 2
        seen_move += gm * gm
        weights += RATE * g / np.sqrt(seen)
        bias += RATE * gap.sum() / scale / np.sqrt(seen_bias)
        move += 0.1 * RATE * gm / np.sqrt(seen_move)
    return weights, bias, move


def _chances(p: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Log-odds that a text has a toxic word, from its words' marginals; -14 where none is strong."""
    # long clean texts have many words of a very small chance, which would add up
    strong = np.where(p >= WORD_CHANCE, p, 0.0)
    clean = np.bincount(text, np.log1p(-np.minimum(strong, 1 - 1e-6)), minlength=texts)
    toxic = np.clip(-np.expm1(clean), 1e-6, 1 - 1e-6)
    return np.log(toxic / (1 - toxic))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that fit the labels of the texts best, by Newton steps."""
    design, theta = np.stack([x, np.ones(len(x))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (y - p) - 1e-2 * theta
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta + np.clip(step, -1, 1)
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple:
    """Word weights (2**18, the size is fixed), bias, the four move weights, calibration.

    The word labels use all texts of the sample; the field is fitted on the toxic texts with a
    labelled word and ``CLEAN_SHARE`` times as many clean ones. The sample is bounded, so one task
    may hold it.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"]).reset_index(drop=True)
        y = pdf["y"].to_numpy()
        column = pa.array(pdf["text"], pa.large_string())
        words, heads, texts = [], [], []
        for first, _, data, offsets in W.pieces(column):
            starts, ends, ptr = W.word_spans(data, offsets, W.IS_SPACE_OR_MARK)
            words.append(W.word_hashes(data, starts, ends))
            heads.append(W.word_hashes(data, starts, np.minimum(ends, starts + HEAD_BYTES)))
            texts.append(W.text_of_word(ptr) + first)
        text = np.concatenate(texts)
        toxic = (y[text] == 1) & (_pure(np.concatenate(words), text, y) | _pure(np.concatenate(heads), text, y))
        del words, heads
        told = np.unique(text[toxic])
        clean = np.random.default_rng(3).permutation(np.flatnonzero(y == 0))[: CLEAN_SHARE * len(told)]
        chosen = np.sort(np.concatenate([told, clean]))
        if not len(told):
            return pd.DataFrame({"slot": [-1], "weight": [-4.0]})
        tags = toxic[np.isin(text, chosen)].astype(float)
        slots, ptrs, base = [], [np.zeros(1, np.int64)], 0
        for _, _, data, offsets in W.pieces(column.take(pa.array(chosen))):
            starts, ends, ptr = W.word_spans(data, offsets, W.IS_SPACE_OR_MARK)
            slots.append(word_features(data, starts, ends, ptr).astype(np.int32))
            ptrs.append(ptr[1:] + base)
            base += len(starts)
        columns = np.ascontiguousarray(np.concatenate(slots).T)
        weights, bias, move = _fit(columns, tags, np.concatenate(ptrs))
        odds = np.empty(len(y))
        for first, end, data, offsets in W.pieces(column):
            starts, ends, ptr = W.word_spans(data, offsets, W.IS_SPACE_OR_MARK)
            p = marginals(weights[word_features(data, starts, ends, ptr)].sum(axis=1) + bias, ptr, move)
            odds[first:end] = _chances(p, W.text_of_word(ptr), end - first)
        extra = [bias, *move.ravel(), *_calibrate(odds, y)]
        used = np.flatnonzero(np.abs(weights) > 1e-4)
        return pd.DataFrame({"slot": [*used, *(-1 - np.arange(7))], "weight": [*weights[used], *extra]})

    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD, rows)
    parts = sample.groupBy(F.lit(1).alias("all")).applyInPandas(fit, "slot long, weight double")
    weights, extra = np.zeros(1 << HASH_BITS, np.float32), np.array([-4.0, 0, 0, 0, 0, 1, 0])
    for slot, weight in parts.collect():  # at most 2**18 + 7 rows
        if slot >= 0:
            weights[slot] = weight
        else:
            extra[-1 - slot] = weight
    return weights, extra[0], extra[1:5].reshape(2, 2), (extra[5], extra[6])


def toxic_spans(docs: DataFrame, model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` columns named in ``keep`` (default doc_id) with ``toxicity`` from 0 to 1 and
    ``spans``, the toxic words as ``(start, end)`` in UTF-8 bytes, neighbours joined.

    Null and empty texts score as texts without toxic words. Rows are independent, so repeats repeat.
    """
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, move, (slope, shift) = shared.value
        for batch in batches:
            for first, end, data, offsets in W.pieces(batch["__text"]):
                starts, ends, ptr = W.word_spans(data, offsets, W.IS_SPACE_OR_MARK)
                score = weights[word_features(data, starts, ends, ptr)].sum(axis=1, dtype=float) + bias
                p = marginals(score, ptr, move)
                text = W.text_of_word(ptr)
                odds = slope * _chances(p, text, end - first) + shift
                spans: list[list[dict]] = [[] for _ in range(end - first)]
                before = -2
                for i in np.flatnonzero(p >= 0.5).tolist():
                    t = text[i]
                    if i == before + 1 and spans[t]:
                        spans[t][-1]["end"] = int(ends[i] - offsets[t])
                    else:
                        spans[t].append({"start": int(starts[i] - offsets[t]), "end": int(ends[i] - offsets[t])})
                    before = i
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[i].slice(first, end - first) for i in range(len(keep))),
                        pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30)))),
                        pa.array(spans, span),
                    ],
                    [*keep, "toxicity", "spans"],
                )

    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("__text"))
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*rows.drop("__text").schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("spans", kind)])
    return rows.mapInArrow(run, schema)
