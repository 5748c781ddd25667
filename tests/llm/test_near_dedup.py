"""Near duplicates: work in proportion, texts with common passages, repeated ids."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pingmotion.llm import near_dedup
from pingmotion.llm.tables import stored

from .test_operators import brute_components, prose, table


def found(spark, texts, percent=85):
    got = near_dedup.near_duplicates(table(spark, texts).repartition(3), percent).collect()
    assert len(got) == len(texts)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def near_group(n, words, seed, edits=1):
    rng, base = random.Random(seed), prose(words, seed)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def state_of(spark, texts, percent=85):
    docs = table(spark, list(enumerate(texts)))
    chunks = near_dedup.chunks_needed(percent / 100)
    rows = near_dedup.signatures(docs, chunks)
    nodes = rows.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    return near_dedup.linked(docs, nodes, percent, chunks)


def test_compared_pairs_grow_with_the_group_and_not_its_square(spark):
    compared = {n: sum(state_of(spark, near_group(n, 200, 7)).compared) for n in (60, 600, 6000)}
    assert compared[60] <= 4 * 60
    assert compared[600] <= 4 * 600
    assert compared[6000] <= 4 * 6000


@pytest.mark.parametrize("rounds", [0, 3])
def test_texts_with_a_common_passage(spark, monkeypatch, rounds):
    """Many texts share most of their words without being similar enough; some of them are."""
    monkeypatch.setattr(near_dedup, "KEY_ROUNDS", rounds)
    common = prose(100, 1)
    texts = []
    for i in range(60):
        own = prose(30, 100 + i)
        texts.append(common + own)
        if i % 6 == 0:
            texts.append(common + own[:-1] + ["other"])
    texts = [(i, " ".join(t)) for i, t in enumerate(texts)]
    for percent in (70, 85):
        assert found(spark, texts, percent) == brute_components(dict(texts), percent)


def test_links_under_rare_shingles_alone(spark, monkeypatch):
    """With no round under signature keys and every key mixed, rare shingles find all links."""
    monkeypatch.setattr(near_dedup, "KEY_ROUNDS", 0)
    texts = []
    for g in range(12):
        texts += near_group(5, 40, g, edits=3)
    texts = list(enumerate(texts))
    assert found(spark, texts) == brute_components(dict(texts), 85)


def test_texts_of_one_id_are_one_document(spark):
    a, b = prose(40, 1), prose(40, 2)
    rows = [(1, a), (1, b), (5, [*b, "more"]), (7, [*a, "more"]), (9, prose(40, 3)), (1, a)]
    got = near_dedup.near_duplicates(table(spark, [(i, " ".join(t)) for i, t in rows]), 80).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (1, 1, True), (1, 1, True), (1, 1, True), (5, 1, False), (7, 1, False), (9, 9, True),
    ]
