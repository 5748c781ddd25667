"""Lanes of the exact top-k against plain scoring, and what a pair of vectors costs."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pingmotion.llm import topk


def plain(ids, vectors, own, queries, k):
    out = {}
    for q, w in zip(own.tolist(), queries.tolist()):
        scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in zip(ids.tolist(), vectors.tolist()) if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return {q: found for q, found in out.items() if found}


def found_by(lane, own, queries, k):
    out = {}
    for q, i, s in zip(*(x.tolist() for x in lane.search(own, queries, k))):
        out.setdefault(q, []).append((i, s))
    return out


@pytest.mark.parametrize("largest", [3, 300, 1 << 20, 1 << 25])  # sums in each of the three types, and many ties
@pytest.mark.parametrize("worth", [0.002, 1.0])
def test_lane_equals_plain_scoring(monkeypatch, largest, worth):
    for name, value in {"FIRST_TILE": 20, "TILE": 30, "WORTH": worth, "AGAIN": 2, "ESSENTIAL": 0.5}.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(largest)
    for n, width, decay in ((1, 1, 0), (4, 3, 0), (300, 8, 0), (300, 9, 0.7)):
        vectors = (rng.integers(-largest, largest + 1, (n, width)) * np.exp(-decay * np.arange(width))).astype(np.int64)
        vectors[rng.integers(0, n, n // 4)] = vectors[0]
        ids = rng.permutation(2 * n)[:n]
        ids[: n // 10] = ids[0]
        own = np.unique(ids)[:15]
        queries = np.array([vectors[np.flatnonzero(ids == q)[0]] for q in own])
        parts = [(ids[a:b], topk._narrow(vectors[a:b])) for a, b in ((0, n // 3), (n // 3, n)) if a < b]
        assert found_by(topk.Lane(parts), own, topk._narrow(queries), 5) == plain(ids, vectors, own, queries, 5)


def test_small_lanes_equal_one(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4 + i % 3).tolist()) for i in range(700)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    one = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 9 == 0, 4).collect()))
    for name, value in {"VECTOR_ROWS": 10, "QUERY_ROWS": 7, "LANE_BYTES": 900}.items():
        monkeypatch.setattr(topk, name, value)
    assert sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 9 == 0, 4).collect())) == one
    assert len(one) == 4 * 78


def test_a_pair_costs_little_more_than_its_product():
    rng = np.random.default_rng(5)
    vectors = np.floor(40 * rng.normal(size=(40_000, 64)))
    began = time.process_time()
    np.matmul(vectors[:512], vectors.T)
    product = time.process_time() - began
    began = time.process_time()
    whole = vectors.astype(np.int16)
    topk.Lane([(np.arange(len(whole)), whole)]).search(np.arange(512), whole[:512], 5)
    assert time.process_time() - began < 5 * product + 0.5  # term by term it was 25 times as long
