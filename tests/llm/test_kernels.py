"""The array kernels against plain statements of the same rules; no Spark."""

from __future__ import annotations

import random
import re
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from pingmotion.llm import bpe, decontaminate, near_dedup, toxicity, urls, warc
from pingmotion.llm import words as W

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

TEXTS = ["", " \t\n", "one", "a b c d", "A b c d e", "a b c d e f a b c d e", "é x y z É", "w " * 5000, "x" * 300_000]


def plain_words(text: str) -> list[bytes]:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lower)]


def test_words_are_runs_outside_white_space():
    column = pa.array([None, *TEXTS, None])
    seen = {}
    for first, end, data, offsets in W.pieces(column, 1000):
        starts, ends, ptr = W.word_spans(data, offsets)
        hashes = W.word_hashes(data, starts, ends)
        for row in range(end - first):
            words = [data[a:b].tobytes() for a, b in zip(starts[ptr[row] : ptr[row + 1]], ends[ptr[row] : ptr[row + 1]])]
            lower = [re.sub(b"[A-Z]", lambda m: m.group().lower(), w) for w in words]
            assert lower == plain_words(column[first + row].as_py() or "")
            for word, h in zip(lower, hashes[ptr[row] : ptr[row + 1]]):
                assert seen.setdefault(word, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)


def test_shingle_sets():
    column = pa.array(TEXTS)
    sizes = [len(s) for s in near_dedup._sets_of(column)]
    want = []
    for text in TEXTS:
        words = plain_words(text)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        want.append(len(runs))
    assert sizes == want
    # a short sequence is not the prefix of a longer one
    a, b, c = near_dedup._sets_of(pa.array(["a b c", "a b c d", "A  b\nc"]))
    assert a != b and list(a) == list(c)


def test_differing_counts_lanes():
    rng = random.Random(4)
    for _ in range(300):
        x = [rng.choice([0, 1, 2048, 4095, rng.randrange(4096)]) for _ in range(5)]
        packed = sum(v << (12 * i) for i, v in enumerate(x))
        bits = int(near_dedup._differing(np.array([packed], np.uint64))[0])
        assert bits == sum(1 << (12 * i) for i, v in enumerate(x) if v)


def test_pigeonhole_has_no_hole():
    """Every pair of signatures within the distance shares a key."""
    chunks, rng = 4, np.random.default_rng(8)
    for _ in range(200):
        a = rng.integers(0, 4096, 5 * chunks)
        b = a.copy()
        for i in rng.choice(5 * chunks, rng.integers(0, 2 * chunks), replace=False):
            b[i] = (b[i] + 1 + rng.integers(4094)) % 4096
        shared = any(
            sum(a[5 * c + i] != b[5 * c + i] for i in range(5) if i != h) == 0 for c, h in product(range(chunks), range(5))
        )
        assert shared


@pytest.fixture(scope="module")
def vocabulary():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranks, library


def test_bpe_equals_the_library(vocabulary):
    ranks, library = vocabulary
    rng = random.Random(2)
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    texts = ["", " ", "a" * 20_000, "ab" * 9_999, "é" * 3_000, "\U0001f600x" * 50, "<|endoftext|>", "it's  we'll\n\n 12345"]
    texts += ["".join(rng.choice("abaanntthhe ") for _ in range(rng.choice([3, 30, 300]))) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FF), 0x4E00])) for _ in range(60)) for _ in range(100)]
    got = encoder.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    tokens = encoder.vocabulary.tokens
    assert [b"".join(tokens[i] for i in ids).decode() for ids in got] == texts


def test_one_by_one_equals_together(vocabulary):
    ranks, _ = vocabulary
    v, rng = bpe.Vocabulary(ranks), random.Random(6)
    tokens = [bytes(rng.choice(b"aabnthe") for _ in range(rng.choice([1, 8, 60]))) for _ in range(60)]
    assert bpe.merge_tokens(tokens, v) == [bpe.merge_tokens([t], v, True)[0] for t in tokens]


def test_forward_backward_sums_over_all_paths():
    rng = np.random.default_rng(1)
    move = rng.normal(size=(2, 2))
    for n in (1, 2, 5):
        score = rng.normal(size=n)
        weight = {
            path: np.exp(sum(s for s, t in zip(score, path) if t) + sum(move[a, b] for a, b in zip(path, path[1:])))
            for path in product((0, 1), repeat=n)
        }
        total = sum(weight.values())
        want = [sum(w for path, w in weight.items() if path[i]) / total for i in range(n)]
        assert np.allclose(toxicity.marginals(score, np.array([0, n]), move), want)


def test_marginals_of_texts_are_independent():
    rng = np.random.default_rng(2)
    move, sizes = rng.normal(size=(2, 2)), [0, 3, 700, 0, 1, 520]
    ptr = np.cumsum([0, *sizes])
    score = rng.normal(size=ptr[-1])
    together = toxicity.marginals(score, ptr, move)
    for a, b in zip(ptr, ptr[1:]):
        assert np.allclose(together[a:b], toxicity.marginals(score[a:b], np.array([0, b - a]), move))


def plain_edits(item, text) -> int:
    cost = [0] * (len(text) + 1)
    for i, word in enumerate(item):
        new = [i + 1]
        for j, other in enumerate(text):
            new.append(min(cost[j] + (word != other), cost[j + 1] + 1, new[j] + 1))
        cost = new
    return min(cost)


def test_edits_within_equals_the_table():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item = rng.integers(0, 5, rng.integers(1, 9)).astype(np.uint64)
        text = rng.integers(0, 5, rng.integers(0, 15)).astype(np.uint64)
        edits, a, b = decontaminate.edits_within(item, text)
        assert edits == plain_edits(item.tolist(), text.tolist())
        assert 0 <= a <= b <= len(text)
        # the stretch itself needs that many edits, used in whole
        whole = [list(range(b - a + 1))]
        for i, word in enumerate(item):
            row = [i + 1]
            for j in range(b - a):
                row.append(min(whole[-1][j] + (word != text[a + j]), whole[-1][j + 1] + 1, row[j] + 1))
            whole.append(row)
        assert whole[-1][-1] == edits


def test_leak_recall_under_random_edits():
    """At the allowed number of random word edits at least 95 of 100 passages are found."""
    rng = random.Random(9)
    lexicon = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(lexicon) for _ in range(rng.randint(15, 60)))) for i in range(200)]
    index = decontaminate.Index(items)
    found = 0
    for number, (_, text) in enumerate(items):
        words = text.split()
        for _ in range(int(decontaminate.EDIT_RATE * len(words))):
            at = rng.randrange(len(words))
            kind = rng.randrange(3)
            words[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice(lexicon)]
        around = [rng.choice(lexicon) for _ in range(80)]
        column = pa.array([" ".join(around[:40] + words + around[40:])])
        for _, _, data, offsets in W.pieces(column):
            seq, ptr, _, _ = decontaminate.word_sequence(data, offsets)
            found += any(hit[1] == number for hit in index.hits(seq, ptr))
    assert found >= 190


def test_bundle_round_trip():
    bundle, want, places = warc.Bundle(), [], []
    for i in range(500):
        payload = bytes([i % 256]) * (i * 7 % 3000)
        record = warc.record_bytes(i, i, "http://a/\r\nX: y" if i % 9 == 0 else f"http://a/{i}", payload, None)
        want.append(record)
        places.append(bundle.add(record))
    whole = bundle.close()
    assert len(warc.seek_table(whole)) > 1
    for record, place in zip(want, places):
        assert warc.read_record(whole, *place) == record
    fields, body = warc.parse_record(want[27])
    assert "\n" not in fields["WARC-Target-URI"] and body == bytes([27]) * 189
    # any Zstandard reader sees the records one after the other and skips the table
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read() == b"".join(want)


def test_trees_learn_a_rule():
    rng = random.Random(7)
    hosts = [rng.choice(["a.net", "b.org", "c.com"]) for _ in range(600)]
    names = [f"http://{h}/{'x' * rng.randrange(40)}" for h in hosts]
    y = np.array([float(h == "a.net" or len(n) > 35) for h, n in zip(hosts, names)])
    rates = np.array([[y[[h == k for k in hosts]].mean()] * 2 for h in hosts])
    base, trees = urls.boost(pa.array(names), hosts, rates, y)
    raw = np.full(len(y), base)
    x = urls._features(pa.array(names), hosts, rates)
    for tree in trees:
        raw += urls._answer(tree, x)
    assert ((raw > 0) == (y == 1)).mean() > 0.97
    assert urls.boost(pa.array([], pa.string()), [], np.zeros((0, 2)), np.zeros(0))[1] == []
