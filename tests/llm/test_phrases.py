"""Collocations against plain counting, tries against substring counts, and edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from pingmotion.llm import phrases

SCHEMA = "doc_id long, lang string, text string, phrase string, slot long, f long, rank int, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, lang, t, "p", 1, 2, 3, 4) for i, (lang, t) in enumerate(rows)], SCHEMA)


def brute(rows, min_count=10, max_words=3, top=2000, percent=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    found = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= min_count}
    covered = set()
    for (lang, words), a in found.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * a >= percent * f[lang, words[i : i + m]]:
                    covered.add((lang, words[i : i + m]))
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) not in covered:
            cuts = [(10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            phrase = " ".join(words)
            out.setdefault(lang, []).append((-score, -a, phrase.encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return [
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top])
    ]


def check(spark, rows, expected=True, **more):
    own = {k: v for k, v in more.items() if k in ("min_count", "max_words", "top", "covered_percent")}
    got = phrases.collocations(table(spark, rows), **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if "covered_percent" in own:
        own["percent"] = own.pop("covered_percent")
    want = brute(rows, **own)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert bool(want) == expected


def texts(n, seed, words=30):
    rng = random.Random(seed)
    lexicon = [rng.choice("äbcdé😀") * rng.randrange(1, 4) + str(i) for i in range(25)] + ["New", "York", "City", "new", "of", "w" * 90]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(words)):
            parts.append(rng.choice(["New York City", "new york", "of the", *lexicon]))
            parts.append(rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " ! ", "\x0b"]))
        out.append((rng.choice(["en", "de", None, "und", ""]), "".join(parts)))
    return out


@pytest.mark.parametrize("more", [{}, {"min_count": 4, "max_words": 5}, {"min_count": 3, "max_words": 2, "top": 5}, {"covered_percent": 90}])
def test_equals_plain_counting(spark, more):
    check(spark, texts(150, 1), **more)


def test_many_small_tries_and_passes(spark):
    check(spark, texts(150, 2), min_count=3, trie_bytes=200, pass_bytes=120_000)


def test_full_buckets_only_let_more_through(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BUCKETS", 64)
    monkeypatch.setattr(phrases, "HELD", 50)
    check(spark, texts(100, 3))


def test_small_stretches_parcels_and_shards(spark, monkeypatch):
    for name, value in {"BUCKETS": 1 << 12, "STRETCH": 64, "SENT": 2, "PARCELS": 4, "PACKED_BYTES": 100, "HASHES_HELD": 50}.items():
        monkeypatch.setattr(phrases, name, value)
    check(spark, texts(120, 6), min_count=3, max_words=4, trie_bytes=300, pass_bytes=150_000)
    check(spark, texts(40, 7) + [("en", "of the city " * 300)] * 2, min_count=300)  # counts of more than a byte


def test_few_counts_travel_as_slots(monkeypatch):
    monkeypatch.setattr(phrases, "BUCKETS", 1 << 18)
    buckets = phrases._Buckets(10)
    buckets.add(np.array([3, 3, 70_000], np.uint64))
    rows = [r for batch in buckets.rows() for r in batch.to_pylist()]
    assert sum(len(r["slots"]) + len(r["counts"]) for r in rows) == 6  # was two stretches of 65,536 bytes
    buckets.add(np.arange(1 << 14, dtype=np.uint64))
    first = next(buckets.rows()).to_pylist()[0]
    assert first["slots"] is None and list(first["counts"][:4]) == [1, 1, 1, 3]


def test_one_task_sums_the_stretches_of_many(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BUCKETS", 256)
    monkeypatch.setattr(phrases, "STRETCH", 64)
    rng = np.random.default_rng(3)
    rows, total = [], np.zeros(256, int)
    for _ in range(30):
        buckets = phrases._Buckets(10)
        buckets.add(rng.integers(0, 256, rng.integers(1, 60)).astype(np.uint64))
        total += buckets.counts
        rows += [tuple(r.values()) for batch in buckets.rows() for r in batch.to_pylist()]
    bits = phrases._bits(spark.createDataFrame(rows, "block long, slots binary, counts binary"), 10)
    assert phrases._has(bits, np.arange(256, dtype=np.uint64)).tolist() == (total >= 10).tolist()


def test_phrases_that_may_begin_at_a_word_share_a_shard(spark):
    rows = [(lang, f"{a} {b}{more}") for lang in ("de", "en") for a in "abcde" for b in "fghij" for more in ("", " k", " l m")]
    shards = phrases._sharded(spark.createDataFrame(rows, "lang string, phrase string").repartition(7), 10).collect()
    assert len(shards) == len(rows)
    place = {}
    for r in shards:
        place.setdefault((r["lang"], *r["phrase"].split()[:2]), set()).add((r["route"], r["shard"]))
    assert all(len(p) == 1 for p in place.values()) and len({s for p in place.values() for _, s in p}) > 20


def test_a_common_text_and_a_common_word(spark):
    rows = [("en", "the same line of words stands everywhere")] * 200 + [("en", "the " * 5000)] * 3 + texts(60, 4)
    check(spark, rows)


def test_edges(spark):
    long = "L" * 100_000
    rows = [
        ("en", None), ("en", ""), (None, " \t\n"), ("en", ".,;"), ("en", "one"), ("x y", "a b " * 40), ("en", f"{long} b " * 12),
        ("en", "﻿a b c " * 15), ("de", "a\rb " * 30), ("de", "A\x0cB C d. " * 30), ("de", "\x01 \x1f q " * 20),
    ]
    check(spark, rows)
    check(spark, [("en", "a b c")] * 9, expected=False)
    check(spark, [(None, None)], expected=False)


def test_empty_table(spark):
    assert phrases.collocations(table(spark, [])).collect() == []


def test_counts_beyond_64_bits_score_exactly(spark):
    a, left, right = 3_037_000_499, 9_000_000_000_000, 3_100_000_001
    frequent = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, f long")
    parts = spark.createDataFrame([("en", "x", left), ("en", "y", right)], "lang string, phrase string, f long")
    assert phrases._scored(frequent, parts).first()["score"] == 10**6 * a * a // (left * right)


def test_double_array_holds_exactly_its_keys():
    rng = random.Random(5)
    keys = sorted({bytes(rng.choice(b"abc\xff ") for _ in range(rng.randrange(1, 9))) for _ in range(400)})
    langs = [rng.choice(["de", "en"]) for _ in keys]
    trie = phrases.DoubleArray(langs, keys)

    def number(lang, key):
        state = trie.roots[lang]
        for byte in key:
            place = trie.base[state] + byte
            if trie.check[place] != state:
                return -1
            state = place
        found = np.flatnonzero(trie.ends == state)
        return trie.numbers[found[0]] if len(found) else -1

    for i, (lang, key) in enumerate(zip(langs, keys)):
        assert number(lang, key) == i
        assert number("de" if lang == "en" else "en", key) == -1
        assert number(lang, key + b"c") == (keys.index(key + b"c") if key + b"c" in keys and langs[keys.index(key + b"c")] == lang else -1)
