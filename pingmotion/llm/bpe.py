"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens start as linked lists of their bytes. Every neighbouring pair that the vocabulary merges
stands in the bucket of its rank; a bitmap of two levels says which buckets have entries, and
find-first-set over it picks the lowest rank in a fixed number of steps. All positions of a bucket
merge in one numpy step, leftmost first where they overlap; entries that an earlier merge has
overtaken are skipped. The cost is proportional to the length, also of a pre-token as long as the
text. The lists of many pre-tokens stand side by side in one run; pairs never cross their ends.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import pieces

#: encoded pre-tokens a task remembers; when full, it starts over
REMEMBERED = 1 << 18
#: longer pre-tokens are not remembered
REMEMBERED_CHARS = 64
#: bytes of text split at once, characters of pre-tokens merged in one run
PIECE_BYTES, RUN_BYTES = 6 << 20, 4 << 20
_LEVEL = 8  # bits of a rank that one bitmap word covers


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines ``base64(token) rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class RankQueue:
    """Positions by merge rank; ``pop`` gives the lowest rank and its positions in order."""

    def __init__(self) -> None:
        self.top = 0
        self.words: dict[int, int] = {}
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        starts = [0, *cuts.tolist()]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            bucket = self.buckets.get(rank)
            if bucket is None:
                self.buckets[rank] = [positions[a:b]]
                high = rank >> _LEVEL
                self.words[high] = self.words.get(high, 0) | 1 << (rank & ((1 << _LEVEL) - 1))
                self.top |= 1 << high
            else:
                bucket.append(positions[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        high = (self.top & -self.top).bit_length() - 1
        word = self.words[high]
        rank = high << _LEVEL | (word & -word).bit_length() - 1
        word &= word - 1
        self.words[high] = word
        if not word:
            self.top &= self.top - 1
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))


class Vocabulary:
    """Ranks of bytes and of all pairs of tokens whose joined bytes are a token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        pairs = {}
        for token, rank in ranks.items():
            self.tokens[rank] = token
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                right = ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])
        self.bits = max(len(pairs) * 4, 2).bit_length() + 1
        keys = np.fromiter(pairs, np.int64, len(pairs))
        # an open table: each key in the first free slot from its own
        self.keys = np.full(1 << self.bits, -1)
        self.values = np.full(1 << self.bits, -1)
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several, one stays
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slots = (slots[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is none; ids of -1 have none."""
        keys = left << 32 | right
        keys[(left < 0) | (right < 0)] = -2
        slots, found = self._slot(keys), np.full(len(keys), -1)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.keys[slots]
            hit = there == keys[todo]
            found[todo[hit]] = self.values[slots[hit]]
            on = ~hit & (there != -1)
            todo, slots = todo[on], (slots[on] + 1) & ((1 << self.bits) - 1)
        return found


def merge_tokens(tokens: list[bytes], vocabulary: Vocabulary, one_by_one: bool = False) -> list[list[int]]:
    """Ids of each pre-token.

    A merge may in principle make a pair of lower rank than its own, which must then go before the
    other positions of the bucket. Pre-tokens where that shows are done again ``one_by_one``, where
    a pop merges the leftmost position only.
    """
    sizes = np.array([len(t) for t in tokens])
    owner = np.repeat(np.arange(len(tokens)), sizes)
    n = len(owner)
    ids = np.append(vocabulary.bytes[np.frombuffer(b"".join(tokens), np.uint8)], -1)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    ends = np.cumsum(sizes)
    after[ends[sizes > 0] - 1] = n  # slot n is no part
    before[(ends - sizes)[sizes > 0]] = n
    alive = np.ones(n, bool)
    waiting = np.append(vocabulary.pair_ranks(ids[:-1], ids[after[:n]]), -1)
    queue, redo = RankQueue(), set()
    some = np.flatnonzero(waiting >= 0)
    if len(some):
        queue.push(waiting[some], some)
    while queue.top:
        rank, at = queue.pop()
        at = at[waiting[at] == rank]
        if not len(at):
            continue
        if one_by_one:
            if len(at) > 1:
                queue.push(np.full(len(at) - 1, rank), at[1:])
                at = at[:1]
        elif len(at) > 1:
            # of overlapping positions every second stays, from the left
            chained = np.append(False, after[at[:-1]] == at[1:])
            if chained.any():
                index = np.arange(len(at))
                head = np.maximum.accumulate(np.where(chained, 0, index))
                at = at[(index - head) % 2 == 0]
        right = after[at]
        alive[right] = False
        waiting[right] = -1
        ids[at] = rank
        after[at] = after[right]
        before[after[at]] = at
        left = before[at]
        touched = np.concatenate([at, left])
        found = vocabulary.pair_ranks(ids[touched], ids[np.concatenate([after[at], at])])
        waiting[touched] = found
        waiting[n] = -1
        if not one_by_one and len(at) > 1:
            redo.update(owner[touched[(found >= 0) & (found < rank)]].tolist())
        new = found >= 0
        if new.any():
            queue.push(found[new], touched[new])
    kept = np.flatnonzero(alive)
    flat = ids[kept].tolist()
    cuts = np.searchsorted(owner[kept], np.arange(len(tokens) + 1)).tolist()
    out = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
    for number in redo:
        out[number] = merge_tokens([tokens[number]], vocabulary, True)[0]
    return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        import regex

        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; its pre-tokens that are new are merged together."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        split = [self.split(text) for text in texts]
        new = [t for t in set().union(*split) if t not in known]
        ranks, rest = self.vocabulary.ranks, []
        for token in new:
            whole = ranks.get(token.encode())
            if whole is None:
                rest.append(token)
            else:
                known[token] = [whole]
        at = 0
        while at < len(rest):  # runs of bounded length, but for single long tokens
            end, size = at, 0
            while end < len(rest) and (size < RUN_BYTES):
                size += len(rest[end])
                end += 1
            part = rest[at:end]
            known.update(zip(part, merge_tokens([t.encode() for t in part], self.vocabulary)))
            at = end
        out = [list(chain.from_iterable(map(known.__getitem__, tokens))) for tokens in split]
        for token in rest:
            if len(token) > REMEMBERED_CHARS:
                del known[token]
        return out


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` columns named in ``keep`` (default doc_id) with ``ids`` (array<int>) and ``decoded``,
    the bytes that the ids stand for.

    Null text is empty: no ids, no bytes. The vocabulary (one entry per id) is broadcast; its size
    does not depend on the data. Rows are independent, so repeated rows repeat.
    """
    keep = keep or ["doc_id"]
    vocabulary = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(vocabulary.value), pattern)
        tokens = encoder.vocabulary.tokens
        for batch in batches:
            for first, end, data, offsets in pieces(batch["__text"], PIECE_BYTES):
                raw = data.tobytes()
                ids = encoder.encode([raw[a:b].decode() for a, b in zip(offsets, offsets[1:])])
                decoded = [b"".join([tokens[i] for i in one]) for one in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[i].slice(first, end - first) for i in range(len(keep))),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array(decoded, pa.binary()),
                    ],
                    [*keep, "ids", "decoded"],
                )

    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "binary")
    return rows.mapInArrow(run, schema)
