"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are word sequences (A-Z folded, ASCII marks and white space between words). The CGK random
walk turns a sequence into one of twice the length or so: at step ``j`` it puts out the word under
its pointer and moves on if the random bit that ``j`` gives this word is 1. Sequences within a small
edit distance walk in step again soon after an edit, so edits become few differing places, and LSH
for Hamming distance applies: each repetition draws a fresh walk and samples places of it.

Windows. Place 0 of a walk is always among the samples. A window can thus only match where it
starts with a word with which an indexed window starts, and others need no walk. Each item is
indexed from several of its words, spread over its first two thirds, the ones that are rarest in
the benchmark and longest; so an edit at one start leaves the other starts. Every hit is verified: the item
must fit somewhere in the text around the hit with at most ``EDIT_RATE`` edits per item word.

A document window runs on where an item's window ends, so walks of few words seldom agree. Items of
fewer than ``SHORT`` words, which at ``EDIT_RATE`` may have no edits, are found by a hash of their
whole word sequence instead, each without fail. The target for longer items is 99.9 percent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: edits allowed per word of an item
EDIT_RATE = 0.1
#: starts indexed per item, LSH repetitions
STARTS, REPEATS = 8, 12
#: each repetition samples a place of each of these ranges of a walk, beside place 0
RANGES = ((2, 6), (6, 9), (9, 13))
#: items of fewer words are looked up by their whole sequence
SHORT = 10
#: items scanned for at once; larger benchmarks take several passes
BLOCK_ITEMS = 20_000
TABLE_BITS = 22

_U = np.uint64


def word_sequence(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, text bounds in words, byte starts and ends."""
    starts, ends, ptr = W.word_spans(data, offsets, W.IS_SPACE_OR_MARK)
    return W.word_hashes(data, starts, ends), ptr, starts, ends


def _samples() -> np.ndarray:
    rng = np.random.default_rng(77)
    return np.array([[rng.integers(lo, hi) for lo, hi in RANGES] for _ in range(REPEATS)])


def walk_keys(seq: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """LSH keys of the windows that start at ``at`` and end before ``stop``: one row per repetition."""
    samples = _samples()
    keys = np.zeros((REPEATS, len(at)), np.uint64)
    padded = np.append(seq, _U(0))
    for r in range(REPEATS):
        coins = W.mix(padded ^ W.mix(np.array([r + 1], np.uint64)))
        pointer, key = at.copy(), padded[at] * _U(31) + _U(r + 1)
        for j in range(samples[r, -1] + 1):
            inside = pointer < stop
            here = np.where(inside, pointer, len(seq))
            if j and j in samples[r]:
                key = W.mix(key * _U(1000003) + padded[here])
            pointer = pointer + (((coins[here] >> _U(j)) & _U(1)).astype(np.int64) & inside)
        keys[r] = W.mix(key)
    return keys


def _sequence_keys(
    seq: np.ndarray, at: np.ndarray, stop: np.ndarray, longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length up to ``longest`` the keys of the runs of so many words that start at ``at``
    and end by ``stop``, and their places in ``at``."""
    there, keys = np.arange(len(at)), np.zeros(len(at), np.uint64)
    for n in range(1, longest + 1):
        fits = at[there] + n <= stop[there]
        there = there[fits]
        keys = W.mix(keys[fits] * _U(1000003) + seq[at[there] + n - 1])
        yield n, keys, there


def edits_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest word edits that turn ``item`` into some stretch of ``text``, and the stretch."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    begin = np.arange(n + 1)
    steps = np.arange(n + 1)
    for i, word in enumerate(item):
        through = cost[:-1] + (text != word)
        skip = cost[1:] + 1
        best = np.minimum(through, skip)
        source = np.where(through <= skip, begin[:-1], begin[1:])
        new = np.append(cost[0] + 1, best)
        origin = np.append(begin[0], source)
        # insertions run to the right: the running minimum of cost less position
        level = new - steps
        low = np.minimum.accumulate(level)
        take = np.maximum.accumulate(np.where(level == low, steps, 0))
        cost, begin = low + steps, origin[take]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


class Index:
    """The windows of a block of items, and the whole sequences of the short ones."""

    def __init__(self, items: list[tuple[int, str]], rate: float = EDIT_RATE) -> None:
        texts = pa.array([text for _, text in items], pa.large_string())
        sequences: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for _, _, data, offsets in W.pieces(texts):
            hashes, ptr, starts, ends = word_sequence(data, offsets)
            sequences += [hashes[a:b] for a, b in zip(ptr, ptr[1:])]
            sizes += [(ends - starts)[a:b] for a, b in zip(ptr, ptr[1:])]
        self.ids = [item for item, _ in items]
        self.sequences = sequences
        self._index_short()
        often = Counter(int(h) for s in sequences for h in set(s.tolist()))
        keys, owners, offsets_ = [], [], []
        for number, seq in enumerate(sequences):
            if len(seq) < SHORT and int(rate * len(seq)) == 0:
                continue
            # windows keep at least a third of the item; of each stretch of the rest the rarest
            # word, and of equally rare ones the longest, which texts are the least likely to hold
            usable = max(len(seq) - len(seq) // 3, min(len(seq), 1))
            picks = set()
            for part in np.array_split(np.arange(usable), min(STARTS, usable) or 1):
                if len(part):
                    picks.add(int(min(part, key=lambda i: (often[int(seq[i])], -sizes[number][i], i))))
            at = np.array(sorted(picks), np.int64)
            if len(at):
                found = walk_keys(seq, at, np.full(len(at), len(seq)))
                keys.append(found.ravel())
                owners.append(np.tile(np.full(len(at), number), REPEATS))
                offsets_.append(np.tile(at, REPEATS))
        flat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        key, owner, offset = flat(keys, np.uint64), flat(owners, np.int64), flat(offsets_, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.owner, self.offset = key[order], owner[order], offset[order]
        first = [int(sequences[o][a]) for o, a in {(int(o), int(a)) for o, a in zip(owner, offset)}]
        self.first = np.unique(np.array(first, np.uint64))
        # one gather tells most words and keys apart from those of the index
        self.may_start = np.zeros(1 << TABLE_BITS, bool)
        self.may_start[self.first >> _U(64 - TABLE_BITS)] = True
        self.may_hit = np.zeros(1 << TABLE_BITS, bool)
        self.may_hit[self.key >> _U(64 - TABLE_BITS)] = True

    def _index_short(self) -> None:
        by_length: dict[int, dict[int, list[int]]] = {}
        for number, seq in enumerate(self.sequences):
            if 0 < len(seq) < SHORT:
                *_, (_, keys, _) = _sequence_keys(seq, np.zeros(1, np.int64), np.full(1, len(seq)), len(seq))
                by_length.setdefault(len(seq), {}).setdefault(int(keys[0]), []).append(number)
        #: per length the sorted keys and the items of each
        self.short = {}
        for n, items in by_length.items():
            keys = np.array(sorted(items), np.uint64)
            self.short[n] = keys, [items[int(k)] for k in keys]
        first = [s[0] for s in self.sequences if 0 < len(s) < SHORT]
        self.short_first = np.unique(np.array(first, np.uint64))
        self.may_start_short = np.zeros(1 << TABLE_BITS, bool)
        self.may_start_short[self.short_first >> _U(64 - TABLE_BITS)] = True

    def verbatim(self, seq: np.ndarray, ptr: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(text, item number, place in seq)`` of the first unchanged copy of each short item in each text."""
        if not self.short or not len(seq):
            return
        at = np.flatnonzero(self.may_start_short[seq >> _U(64 - TABLE_BITS)])
        at = at[np.isin(seq[at], self.short_first)]
        text = W.text_of_word(ptr)[at]
        for n, keys, there in _sequence_keys(seq, at, ptr[1:][text], max(self.short)):
            if n not in self.short:
                continue
            known, items = self.short[n]
            slot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            found = np.flatnonzero(known[slot] == keys)
            pairs = text[there[found]] * len(known) + slot[found]
            for k in np.unique(pairs, return_index=True)[1]:
                i = there[found[k]]
                for number in items[slot[found[k]]]:
                    yield int(text[i]), number, int(at[i])

    def hits(self, seq: np.ndarray, ptr: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(text, item number, place in seq where the item would start)``, each once."""
        if not len(self.first) or not len(seq):
            return
        at = np.flatnonzero(self.may_start[seq >> _U(64 - TABLE_BITS)])
        at = at[np.isin(seq[at], self.first)]
        if not len(at):
            return
        text = W.text_of_word(ptr)[at]
        stop = ptr[1:][text]
        seen = set()
        for keys in walk_keys(seq, at, stop):
            likely = np.flatnonzero(self.may_hit[keys >> _U(64 - TABLE_BITS)])
            keys = keys[likely]
            lo, hi = np.searchsorted(self.key, keys, "left"), np.searchsorted(self.key, keys, "right")
            for k in np.flatnonzero(hi > lo):
                i = likely[k]
                for e in range(lo[k], hi[k]):
                    hit = int(text[i]), int(self.owner[e]), int(at[i] - self.offset[e])
                    if hit not in seen:
                        seen.add(hit)
                        yield hit


LEAKS = "doc_id long, item_id long, edits int, item_words int, start int, end int"


def _scan(docs: DataFrame, items: list[tuple[int, str]], rate: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, rate)
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, _, data, offsets in W.pieces(batch["text"]):
                seq, ptr, starts, ends = word_sequence(data, offsets)
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for text, number, place in index.verbatim(seq, ptr):
                    best[text, number] = 0, place, place + len(index.sequences[number])
                for text, number, place in index.hits(seq, ptr):
                    item = index.sequences[number]
                    allowed = int(rate * len(item))
                    lo = max(int(ptr[text]), place - allowed)
                    hi = min(int(ptr[text + 1]), place + len(item) + allowed)
                    # an edit takes at most one word of the item away
                    if np.isin(item, seq[lo:hi]).sum() < len(item) - allowed:
                        continue
                    edits, a, b = edits_within(item, seq[lo:hi])
                    if edits <= allowed and b > a and (edits, lo + a) < best.get((text, number), (1 << 30, 0))[:2]:
                        best[text, number] = edits, lo + a, lo + b
                rows = []
                for (text, number), (edits, a, b) in best.items():
                    begin, end = int(starts[a] - offsets[text]), int(ends[b - 1] - offsets[text])
                    rows.append(
                        (ids[first + text], index.ids[number], edits, len(index.sequences[number]), begin, end)
                    )
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 2 + [pa.int32()] * 4)],
                        ["doc_id", "item_id", "edits", "item_words", "start", "end"],
                    )

    return docs.mapInArrow(run, LEAKS)


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, edits, item_words, start, end``: each benchmark item found in each document
    with the fewest edits; ``start`` and ``end`` are UTF-8 byte offsets.

    Null or empty texts hold nothing; items without words, text or id are left out; equal items are
    found each. Repeated documents report each. Documents without id report a null doc_id. The
    benchmark is broadcast in blocks of about ``BLOCK_ITEMS`` items, one pass over the documents each.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna().distinct()
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    found = None
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        part = _scan(docs, sorted((r["item_id"], r["text"]) for r in some), rate)
        found = part if found is None else found.union(part)
    return found
