"""What candidates cost: passes over the texts, buckets that tasks hold, times that travel with phrases."""

from __future__ import annotations

import random

import numpy as np

from pingmotion.llm import phrases
from tests.llm.test_phrases import check, table, texts


def test_texts_are_read_once_for_each_length_however_many_candidates(spark, monkeypatch):
    names, stored = [], phrases.stored

    def noted(df, name):
        names.append(name)
        return stored(df, name)

    monkeypatch.setattr(phrases, "stored", noted)
    check(spark, texts(120, 8), min_count=2, trie_bytes=100, pass_bytes=1000)  # was a pass for every few tries
    assert names == ["words", "phrases-2", "phrases-3", "phrases-4", "phrase-counts"]


def test_buckets_grow_with_the_corpus(monkeypatch):
    assert phrases._bucket_count(0) == phrases._bucket_count(4 << 26) == 1 << 26
    assert phrases._bucket_count((4 << 26) + 4) == 1 << 27
    assert phrases._bucket_count(10**12) == phrases.MOST_BUCKETS
    monkeypatch.setattr(phrases, "BUCKETS", 1 << 10)
    assert phrases._Buckets(3, 1 << 30).held == 0  # none is made before it is used
    assert [phrases._stretch(1 << n) for n in (6, 10, 26, 30)] == [1 << 6, 1 << 10, 1 << 14, 1 << 16]


def test_more_counts_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(phrases, "COUNTS_HELD", 40)
    monkeypatch.setattr(phrases, "BUCKETS", 1 << 10)
    rng = np.random.default_rng(2)
    for size in (1 << 8, 1 << 12):
        buckets, total = phrases._Buckets(300, size), np.zeros(size, int)
        for _ in range(20):
            hashes = rng.integers(0, size, rng.integers(1, 90)).astype(np.uint64)
            buckets.add(hashes, 7)
            total += 7 * np.bincount(hashes.astype(int), minlength=size)
        assert buckets.counts.tolist() == np.minimum(total, 300).tolist()
        rows = [tuple(r.values()) for batch in buckets.rows() for r in batch.to_pylist()]
        bits = phrases._bits(spark.createDataFrame(rows, "block long, slots binary, counts binary"), 300, size)
        assert phrases._has(bits, np.arange(size, dtype=np.uint64)).tolist() == (total >= 300).tolist()
    check(spark, texts(120, 9), min_count=3)


def test_times_of_any_size_add_up():
    rng = random.Random(4)
    names = [b" ".join(rng.choice([b"a", b"bc", b"w" * 60, b"\x01"]) for _ in range(rng.randrange(2, 5))) for _ in range(60)]
    sent, total = [], dict.fromkeys(names, 0)
    for _ in range(9):
        some = rng.sample(sorted(total), 20)
        times = [rng.choice([1, 254, 255, 256, 2**31, 2**53 + 1]) for _ in some]
        sums = bytes(min(n, 255) for n in times) + b"".join(n.to_bytes(8, "little") for n in times if n >= 255)
        assert phrases._times(sums, 20).tolist() == times
        sent.append((b"\n".join(some), sums))
        for name, n in zip(some, times):
            total[name] += n
    for trie_bytes, pass_bytes in ((30, 50), (1 << 20, 1 << 20)):
        found, sums = phrases._summed("en", sent, trie_bytes, pass_bytes)
        assert dict(zip(found, sums.tolist())) == {name: n for name, n in total.items() if n}


def test_a_phrase_of_many_flushes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PACKED_BYTES", 60)
    monkeypatch.setattr(phrases, "WORDS_A_PARCEL", 100)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 500)
    check(spark, [("en", "again and again the same. " * 700)] * 2 + texts(50, 10), min_count=300)
    assert phrases.collocations(table(spark, [("en", "b a")] * 3), min_count=4).collect() == []
