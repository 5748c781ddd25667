"""Exact duplicates against a plain grouping, with tables that overflow, and edge cases."""

from __future__ import annotations

import random
import re
from hashlib import sha256

import pytest

from pingmotion.llm import exact_dedup

SCHEMA = "doc_id long, text string, window long, content string, hash long, sha string, first int, best int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "c", 2, "s", 3, 4) for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((i, text or ""))
    out = []
    for content, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for n, (i, _) in enumerate(members):
            out.append((i, members[0][0], len(members), n == 0, sha256(content.encode()).hexdigest()))
    return out


def order(row):
    return tuple((v is None, v) for v in row)


def check(spark, rows, **more):
    got = exact_dedup.exact_duplicates(table(spark, rows), **more)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(brute(rows), key=order)


def rows_of(n, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["ä", "b", "cc", "😀"]) for _ in range(rng.randrange(5))) for _ in range(n)]
    blanks = [t.replace(" ", rng.choice(["  ", "\t", "", "\n\r"])) for t in texts]
    return list(enumerate(rng.choices(texts + blanks, k=n)))


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a b"), (None, "a  b"), (7, "A b"),
        (8, "x" * 300_000), (9, "x " * 300_000), (10, "x " * 300_000), (10, "x " * 300_000), (11, "퟿ é"),
        (None, "only"), (None, "on ly"), (12, "\x1f"), (13, " "), (-5, "a b "),
    ]
    check(spark, rows)


def test_many_rows_and_a_hot_group(spark):
    rows = rows_of(600, 1) + [(1000 + i, "the same text everywhere") for i in range(300)]
    check(spark, rows)


def test_overfull_tables_go_on_to_further_levels(spark):
    rows = rows_of(300, 2) + [(i + 5000, f"text number {i % 90}" * 20) for i in range(200)]
    check(spark, rows, table_bytes=300)


def test_contents_of_one_hash(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.xxhash, "xxh3_64_intdigest", lambda content: 7)
    table_ = exact_dedup.OpenTable(40)
    contents = [b"a" * 10, b"b" * 10, b"a" * 10, b"c" * 10, b"d" * 10, b"b" * 10]
    assert [table_.place(7, c) for c in contents] == [0, 1, 0, 2, -1, 1]


def test_windows_close_when_they_are_full(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "WINDOW_BYTES", 60)
    monkeypatch.setattr(exact_dedup, "WINDOW_ROWS", 7)
    check(spark, rows_of(200, 3))


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(table(spark, [])).collect() == []


@pytest.mark.parametrize("n", [1, 2000])
def test_open_addressing_finds_every_content(n):
    held = exact_dedup.OpenTable(1 << 30)
    keys = [(hash((i, 1)) & (2**64 - 1), str(i).encode()) for i in range(n)]
    assert [held.place(*k) for k in keys] == list(range(n))
    assert [held.place(*k) for k in keys] == list(range(n))
