"""Collocations: phrases whose words stand together far more often than their parts would.

Level by level, by the Apriori rule that a phrase is at most as frequent as its parts. Words are
counted first. For each length of phrase, positions whose shorter phrases may be frequent add to
hashed buckets, whose sums are upper bounds; phrases of frequent buckets, and only those, are candidates.
Tasks send each of their candidates with the times it occurs there. The exact counts come from double-array
tries, one or a few per parcel of candidates: numpy holds the trie state of every phrase that was sent and
advances all of them by one byte at a time, and what was sent with accepted phrases is summed by ``bincount``.

Scale. Texts are read where they are, once for the words and once for each length, however many candidates
there are, and never shuffled; what leaves a task is counted or distinct: words and their counts, small
bucket sums, candidate phrases and their counts. Bucket sums travel in stretches and phrases in parcels, so
rows are few, and a task that sums them holds one at a time, however many AQE deals it. Broadcast are bitmaps of
the buckets, whose number grows with the words of the corpus (``BUCKETS`` to ``MOST_BUCKETS``); tasks hold only
the buckets they use. Nothing is dropped: full buckets only let more candidates through. A language, word or
copied text may hold any share of the rows, since all sums are pre-aggregated in the tasks. Candidates
are told apart inside a task by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .tables import small_batches, stored

#: fixed values: the bytes that end a piece, and those that part words
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

#: buckets of words, and of phrases at least and at most: a bucket is of use while the words of the corpus are
#: not many times as many as buckets
BUCKETS, MOST_BUCKETS = 1 << 26, 1 << 30
WORDS_A_BUCKET = 4
#: bucket counts that a task holds before it sends them on
COUNTS_HELD = 4_000_000
#: buckets whose counts travel together, at least, and how many stretches a task sends at once
STRETCH = 1 << 14
SENT = 64
#: bytes of text cut into words at once
BLOCK_BYTES = 2 << 20
#: parcels at least, by hash, in which candidate phrases travel, words of the corpus for each of them, and bytes of
#: phrases that a task packs at once
PARCELS = 256
WORDS_A_PARCEL = 500_000
PACKED_BYTES = 16 << 20
#: words that a task counts before it sends them on, and phrases, by their hashes, that it knows it has sent
HELD = 300_000
HASHES_HELD = 4_000_000
#: bytes of phrases in a trie, and of phrases that are walked at once
TRIE_BYTES = 3 << 20
PASS_BYTES = 48 << 20
#: longer words stand in tries by their digest, so that a trie has few levels
LONG_WORD = 40

_U = np.uint64
_STOPS = W.byte_set(PIECE_ENDS + BLANKS)
_ENDS = W.byte_set(PIECE_ENDS)
_SPACE, _END = 32, 10
_TO_BLANK = bytes(32 if _STOPS[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))
_FACTOR = _U(0x9E3779B97F4A7C15)
_HALF = _U(0xFFFFFFFF)


def _salt(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


class Block:
    """The words of some texts: where they are, which follow one another in a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.data = W._LOWER[data]
        self.langs = langs
        self.starts, self.ends, ptr = W.word_spans(data, offsets, _STOPS)
        self.text = W.text_of_word(ptr)
        stops_before = np.concatenate([[0], np.cumsum(_ENDS[data])])
        #: whether the next word follows in the same piece
        self.joined = np.zeros(len(self.starts), bool)
        if len(self.starts):
            gap = stops_before[self.starts[1:]] == stops_before[self.ends[:-1]]
            self.joined[:-1] = gap & (self.text[1:] == self.text[:-1])

    def per_word(self, values: dict[str, int], kind: type) -> np.ndarray:
        """A value of each word's language."""
        return np.array([values[lang] for lang in self.langs], kind)[self.text]

    def hashes(self) -> np.ndarray:
        salts = {lang: _salt(lang) for lang in set(self.langs)}
        return W.mix(W.word_hashes(self.data, self.starts, self.ends, lower=False) ^ self.per_word(salts, np.uint64))

    def routes(self) -> np.ndarray:
        """A number for every word that depends on this word, the next one and their language only,
        equal in the upper half for equal words."""
        words = self.hashes()
        pairs = W.mix(words * _FACTOR + np.append(words[1:], _U(0))) if len(words) else words
        return (words & ~_HALF | pairs >> _U(32)).view(np.int64)

    def phrases(self, words: np.ndarray, length: int) -> pa.Array:
        """The phrases of so many words that begin at these words of the block."""
        text, first = self._spaced(self.data, self.starts, self.ends - self.starts)
        begin, stop = first[words], np.append(first, len(text))[words + length] - 1
        ends = np.cumsum(stop - begin)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - stop, stop - begin)
        offsets = np.append(0, ends).astype(np.int64)
        strings = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(text[place]))
        return strings.cast(pa.string())

    def _spaced(self, source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = sizes + 1
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first - starts, sizes)
        last = first + sizes - 1
        place[last] = 0
        out = source[place] if len(source) else np.zeros(0, np.uint8)
        out[last] = np.where(self.joined, _SPACE, _END)
        return out, first


def _stand_in(word: bytes) -> bytes:
    # no text in UTF-8 has the byte 0xFF
    return word if len(word) <= LONG_WORD else b"\xff" + md5(word, usedforsecurity=False).hexdigest().encode()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        langs = batch["lang"].to_pylist()
        for first, end, data, offsets in W.pieces(batch["text"], BLOCK_BYTES):
            yield Block(data, offsets, langs[first:end])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, counts in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(counts), pa.string()),
                        pa.array([w.decode("utf-8", "replace") for w in counts], pa.string()),
                        pa.array(list(counts.values()), pa.int64()),
                    ],
                    ["lang", "phrase", "f"],
                )
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                seen.setdefault(lang, Counter()).update((text or "").encode().translate(_TO_BLANK).split())
            if sum(map(len, seen.values())) > HELD:
                yield from counted()
        yield from counted()

    rows = texts.mapInArrow(run, "lang string, phrase string, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


_BUCKET_COLUMNS = ["block", "slots", "counts"]
_PARCEL_COLUMNS = ["parcel", "lang", "phrases", "times"]


def _stretch(size: int) -> int:
    """Of so many buckets, those that travel together; their slots have 16 bits."""
    return min(size, max(STRETCH, min(size >> 12, 1 << 16)))


def _kind(cap: int) -> type:
    return np.uint8 if cap < 256 else np.uint32


class _Buckets:
    """Counts of hashed buckets, kept up to ``cap``: whether a sum reaches the cap needs no more. Held are
    those that are used, as a slot in the upper half of a number and a count in the lower one."""

    def __init__(self, cap: int, size: int | None = None):
        self.cap, self.size = cap, size or BUCKETS
        self.kind = _kind(cap)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, hashes: np.ndarray, times: int = 1) -> None:
        self.parts.append((hashes & _U(self.size - 1)) << _U(32) | _U(min(times, self.cap)))
        self.held += len(hashes)
        if self.held > COUNTS_HELD:
            self.folded()

    def folded(self) -> tuple[np.ndarray, np.ndarray]:
        """The slots in order and their counts."""
        whole = np.sort(np.concatenate([np.zeros(0, np.uint64), *self.parts]))
        slots = whole >> _U(32)
        begin = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])[: len(slots)])
        slots = slots[begin]
        counts = np.minimum(np.add.reduceat(whole & _HALF, begin), _U(self.cap)) if len(slots) else slots
        self.parts, self.held = [slots << _U(32) | counts], len(slots)
        return slots.astype(np.int64), counts.astype(self.kind)

    @property
    def counts(self) -> np.ndarray:
        slots, counts = self.folded()
        out = np.zeros(self.size, self.kind)
        out[slots] = counts
        return out

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``block, slots, counts``: the counts in stretches, those without any left out. Where few buckets
        of a stretch have counts, only those stand, with their slots; otherwise slots is null."""
        size = _stretch(self.size)
        used, part = self.folded()
        cuts = np.searchsorted(used, np.arange(0, self.size + 1, size)).tolist()
        blocks, slots, counts = [], [], []

        def packed() -> pa.RecordBatch:
            columns = [pa.array(blocks, pa.int64()), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, _BUCKET_COLUMNS)

        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a == b:
                continue
            blocks.append(i)
            if (b - a) * (2 + part.itemsize) < size * part.itemsize:
                slots.append((used[a:b] - i * size).astype(np.uint16).tobytes())
                counts.append(part[a:b].tobytes())
            else:
                whole = np.zeros(size, self.kind)
                whole[used[a:b] - i * size] = part[a:b]
                slots.append(None)
                counts.append(whole.tobytes())
            if len(blocks) == SENT:
                yield packed()
                blocks, slots, counts = [], [], []
        if blocks:
            yield packed()


def _bits(rows: DataFrame, cap: int, buckets: int | None = None) -> np.ndarray:
    """The bitmap of the buckets whose counts, summed over all rows, reach the cap. The rows of a
    stretch come one after the other, so a task holds the sums of one stretch, however many it gets."""
    buckets = buckets or BUCKETS
    size, kind = _stretch(buckets), _kind(cap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(size, np.int64)

        def packed(done: list[tuple[int, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in done], pa.int64()), pa.array([bits for _, bits in done], pa.binary())], ["block", "bits"]
            )

        for batch in batches:
            done = []
            for block, slots, counts in zip(*(batch[c] for c in _BUCKET_COLUMNS)):
                block = block.as_py()
                if block != now:
                    if now is not None:
                        done.append((now, np.packbits(sums >= cap, bitorder="little").tobytes()))
                    now, sums = block, np.zeros(size, np.int64)
                more = np.frombuffer(counts.as_buffer(), kind)
                if slots.is_valid:
                    sums[np.frombuffer(slots.as_buffer(), np.uint16)] += more
                else:
                    sums += more
            yield packed(done)
        if now is not None:
            yield packed([(now, np.packbits(sums >= cap, bitorder="little").tobytes())])

    dealt = rows.select(*_BUCKET_COLUMNS).repartition("block").sortWithinPartitions("block")
    whole = bytearray(buckets // 8)
    for row in dealt.mapInArrow(run, "block long, bits binary").collect():  # a bit a bucket, however many rows were summed
        whole[row["block"] * size // 8 : (row["block"] + 1) * size // 8] = row["bits"]
    return np.frombuffer(whole, np.uint64)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & _U(64 * len(bits) - 1)
    return (bits[slot >> _U(6)] >> (slot & _U(63))) & _U(1) == 1


def _word_buckets(words: DataFrame, cap: int) -> DataFrame:
    """``block, slots, counts`` in which the buckets of all these words are full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets(cap)
        for batch in batches:
            salts = np.array([_salt(lang) for lang in batch["lang"].to_pylist()], np.uint64)
            for first, end, data, offsets in W.pieces(batch["phrase"]):
                hashes = W.word_hashes(data, offsets[:-1], offsets[1:], lower=False)
                buckets.add(W.mix(hashes ^ salts[first:end]), cap)
        yield from buckets.rows()

    return words.select("lang", "phrase").mapInArrow(run, "block long, slots binary, counts binary")


def _feasible(block: Block, bits: list[np.ndarray], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, ... ``length`` words: hashes of the phrases that begin at each word, and whether they
    may be frequent by the bitmaps of that length, if there is one, and of all shorter phrases."""
    words = block.hashes()
    values, ok = words, _has(bits[0], words)
    yield values, ok
    for m in range(2, length + 1):
        n = len(words)
        longer = np.zeros(n, bool)
        longer[: n - 1] = ok[:-1] & ok[1:] & block.joined[:-1]
        values = values * _FACTOR
        values[: max(n - m + 1, 0)] += words[m - 1 :]
        values = W.mix(values)
        ok = longer
        if len(bits) >= m:
            ok[ok] = _has(bits[m - 1], values[ok])
        yield values, ok


class _Parcels:
    """Candidate phrases of a task with the times each occurs, packed by language and hash."""

    def __init__(self, parcels: int) -> None:
        self.parcels = parcels
        self.langs: dict[str, int] = {}
        self.seen, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and which came when
        self.phrases: list[pa.Array] = []
        self.keys: list[np.ndarray] = []
        self.times = np.zeros(0, np.int64)
        self.held = 0

    def add(self, block: Block, values: np.ndarray, at: np.ndarray, length: int) -> None:
        """The phrases of so many words, with these hashes, that begin at these words of the block."""
        hashes, first, times = np.unique(values, return_index=True, return_counts=True)
        spot = np.searchsorted(self.seen, hashes)
        known = np.zeros(len(hashes), bool)
        if len(self.seen):
            known = self.seen[np.minimum(spot, len(self.seen) - 1)] == hashes
        self.times[self.place[spot[known]]] += times[known]
        fresh = ~known
        if fresh.any():
            hashes, spot, begin = hashes[fresh], spot[fresh], at[first[fresh]]
            self.place = np.insert(self.place, spot, np.arange(len(self.times), len(self.times) + len(hashes)))
            self.seen = np.insert(self.seen, spot, hashes)
            self.times = np.concatenate([self.times, times[fresh]])
            numbers = np.array([self.langs.setdefault(lang, len(self.langs)) for lang in block.langs], np.int64)
            self.keys.append(numbers[block.text[begin]] * self.parcels + (hashes % _U(self.parcels)).astype(np.int64))
            self.phrases.append(block.phrases(begin, length))
            self.held += self.phrases[-1].nbytes

    def full(self) -> bool:
        return self.held > PACKED_BYTES or len(self.seen) > HASHES_HELD

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``parcel, lang, phrases, times``: each parcel's phrases with a line end between them; a byte for
        the times of each, and eight more at the end if that byte is 255."""
        if not self.keys:
            return
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], self.times[order]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        cuts = np.append(begin, len(keys))
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.concat_arrays(self.phrases).take(pa.array(order)))
        names = list(self.langs)
        packed = pc.binary_join(lists, "\n").cast(pa.binary())
        parcel = pa.array(keys[begin] % self.parcels)
        lang = pa.array([names[i] for i in keys[begin] // self.parcels], pa.string())
        few = np.minimum(times, 255).astype(np.uint8)
        spots = np.flatnonzero(few == 255)
        more = np.searchsorted(spots, cuts).tolist()
        sums = [
            few[a:b].tobytes() + times[spots[c:d]].tobytes() for a, b, c, d in zip(cuts.tolist(), cuts[1:].tolist(), more, more[1:])
        ]
        columns = [parcel, lang, packed, pa.array(sums, pa.binary())]
        self.__init__(self.parcels)
        for first in range(0, len(packed), PARCELS):
            yield pa.RecordBatch.from_arrays([c.slice(first, PARCELS) for c in columns], _PARCEL_COLUMNS)


def _times(sums: bytes, n: int) -> np.ndarray:
    """The times of so many phrases of a parcel's row."""
    times = np.frombuffer(sums, np.uint8, n).astype(np.int64)
    times[times == 255] = np.frombuffer(sums, np.int64, offset=n)
    return times


def _level(texts: DataFrame, known: Broadcast, length: int, max_words: int, cap: int, size: int, dealt: int) -> DataFrame:
    """One pass: ``block, slots, counts`` of the buckets of phrases of ``length`` words, and ``parcel,
    lang, phrases, times`` of the candidates one word shorter, dealt over so many parcels."""
    kinds = dict.fromkeys([*_BUCKET_COLUMNS, *_PARCEL_COLUMNS], "binary") | {"block": "long", "parcel": "long", "lang": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        buckets = _Buckets(cap, size) if length <= max_words else None
        parcels = _Parcels(dealt)
        arrow = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}

        def filled(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in rows:
                columns = [row[c] if c in row.schema.names else pa.nulls(len(row), arrow[kind]) for c, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays(columns, list(kinds))

        for block in _blocks(batches):
            if not len(block.starts):
                continue
            levels = list(_feasible(block, bits, min(length, max_words)))
            if buckets is not None:
                values, ok = levels[length - 1]
                buckets.add(values[ok])
                if buckets.held > COUNTS_HELD:
                    yield from filled(buckets.rows())
                    buckets = _Buckets(cap, size)
            if length > 2:
                values, ok = levels[length - 2]
                at = np.flatnonzero(ok)
                parcels.add(block, values[at], at, length - 1)
                if parcels.full():
                    yield from filled(parcels.rows())
        yield from filled(parcels.rows())
        if buckets is not None:
            yield from filled(buckets.rows())

    return texts.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in kinds.items()))


def _bucket_count(words: int) -> int:
    """How many buckets the phrases of a corpus of so many words get: a power of two."""
    return max(BUCKETS, min(MOST_BUCKETS, 1 << max(words // WORDS_A_BUCKET - 1, 0).bit_length()))


def candidates(texts: DataFrame, words: DataFrame, min_count: int, max_words: int) -> DataFrame:
    """``parcel, lang, phrases, times``: the phrases of two to ``max_words`` words that may occur ``min_count``
    times, each with the times that a task met it; every such phrase with all its times."""
    spark = texts.sparkSession
    total = words.agg(F.sum("f")).first()[0] or 0
    size, dealt = _bucket_count(total), max(PARCELS, total // WORDS_A_PARCEL)
    bits = [_bits(_word_buckets(words.where(F.col("f") >= min_count), min_count), min_count)]
    found: DataFrame | None = None
    for length in range(2, max_words + 2):
        known = spark.sparkContext.broadcast(bits)
        level = stored(_level(texts, known, length, max_words, min_count, size, dealt), f"phrases-{length}")
        known.destroy()
        if length > 2:
            # phrases of different lengths differ
            here = level.where("parcel IS NOT NULL").select(*_PARCEL_COLUMNS)
            found = here if found is None else found.union(here)
        if length <= max_words:
            bits.append(_bits(level.where("block IS NOT NULL"), min_count, size))
    return found


class DoubleArray:
    """A trie as arrays: the child of state ``s`` by byte ``b`` is ``base[s] + b`` if ``check`` there
    is ``s``. ``ends`` has the states in which a key ends, in order, and ``numbers`` those keys; ``roots``
    the state with which each language begins.

    Built level by level from sorted keys. Children of a state with several lie in a stretch of their own;
    states with one child fill the gaps.
    """

    def __init__(self, langs: list[str], keys: list[bytes]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        if len(set(langs)) > 1:
            order.sort(key=langs.__getitem__)
        lengths = np.array([len(keys[i]) for i in order])
        width = int(lengths.max(initial=0))
        letters = np.zeros((len(order), width + 1), np.uint8)
        letters[np.arange(width + 1) < lengths[:, None]] = np.frombuffer(b"".join(keys[i] for i in order), np.uint8)
        number = np.array(order, np.int32)
        names = sorted(set(langs))
        self.roots = {name: 256 + i for i, name in enumerate(names)}
        state = np.array([self.roots[langs[i]] for i in order], np.int64)
        top = 256 + len(names)
        room = top + 2 * int(lengths.sum()) + 1024
        base = np.zeros(room, np.int32)
        check = np.full(room, -1, np.int32)
        ends = np.zeros(len(order), np.int64)
        gaps = np.zeros(0, np.int64)
        # bytes that a key shares with the key before; none across languages
        differ = np.ones(len(order), np.int64)
        if len(order) > 1:
            other = letters[1:] != letters[:-1]
            differ[1:] = np.where(other.any(axis=1), other.argmax(axis=1), width + 1)
            differ[1:][state[1:] != state[:-1]] = 0
        differ[:1] = 0
        for depth in range(width):
            rows = np.flatnonzero(lengths > depth)
            # keys between two rows are shorter; the row is a new state if any neighbours part by here
            shared = np.minimum.reduceat(differ[: rows[-1] + 1], np.concatenate([[0], rows[:-1] + 1]))
            new = shared <= depth
            child = rows[new]
            parent, byte = state[child], letters[child, depth].astype(np.int64)
            opens = np.ones(len(child), bool)
            opens[1:] = parent[1:] != parent[:-1]
            begin = np.flatnonzero(opens)
            n = np.diff(np.append(begin, len(child)))
            span = byte[begin + n - 1] - byte[begin] + 1
            slot = np.zeros(len(begin), np.int64)
            several = n > 1
            stretch = np.where(several, span, 0)
            slot[several] = (top + np.cumsum(stretch) - stretch)[several]
            top += int(stretch.sum())
            single = np.flatnonzero(~several)
            taken = min(len(single), len(gaps))
            slot[single[:taken]] = gaps[:taken]
            slot[single[taken:]] = top + np.arange(len(single) - taken)
            top += len(single) - taken
            if top + 512 > len(base):
                grown = 2 * (top + 512)
                base, check = (
                    np.concatenate([a, np.full(grown - len(a), fill, np.int32)]) for a, fill in ((base, 0), (check, -1))
                )
            base[parent[begin]] = slot - byte[begin]
            place = base[parent] + byte
            check[place] = parent
            state[rows] = place[np.cumsum(new) - 1]
            over = rows[lengths[rows] == depth + 1]
            ends[over] = state[over]
            free = np.flatnonzero(check[256 + len(names) : top] < 0)
            gaps = free + 256 + len(names)
        self.base, self.check = base[: top + 256], check[: top + 256]
        by_state = np.argsort(ends)
        self.ends, self.numbers = ends[by_state].astype(np.int32), number[by_state]


def accepted(trie: DoubleArray, lang: str, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of the key that stands at each of these places up to the end of its line, or -1: every step
    advances all places whose state is still alive by one byte."""
    found = np.full(len(at), -1, np.int64)
    place, state = np.arange(len(at)), np.full(len(at), trie.roots[lang])
    while len(at):
        byte = text[at]
        over = byte == _END
        if over.any():
            reached = state[over]
            key = np.minimum(np.searchsorted(trie.ends, reached), len(trie.ends) - 1)
            found[place[over]] = np.where(trie.ends[key] == reached, trie.numbers[key], -1)
        step = trie.base[state] + byte
        alive = (trie.check[step] == state) & ~over
        place, state, at = place[alive], step[alive], at[alive] + 1
    return found


def _sharded(phrases: DataFrame, trie_bytes: int) -> DataFrame:
    """``lang, phrase, route, shard, id``: candidates in order of the route of their first word, cut into
    shards of so many bytes or little more. Phrases of equal routes stay together, so all that
    may begin at a position stand in one shard, which the position's route tells."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in W.pieces(batch["phrase"], BLOCK_BYTES):
                rows = batch.slice(first, end - first)
                block = Block(data, offsets, rows["lang"].to_pylist())
                begin = np.searchsorted(block.text, np.arange(len(rows)))
                yield pa.RecordBatch.from_arrays(
                    [rows["lang"], rows["phrase"], pa.array(block.routes()[begin])], ["lang", "phrase", "route"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, id_, held, last = TaskContext.get().partitionId() << 32, 0, 0, None
        for batch in batches:
            shards, ids = [], []
            for phrase, route in zip(batch["phrase"].to_pylist(), batch["route"].to_pylist()):
                size = len(phrase.encode())
                if id_ and held + size > trie_bytes and route != last:
                    shard, id_, held = shard + 1, 0, 0
                shards.append(shard)
                ids.append(id_)
                id_, held, last = id_ + 1, held + size, route
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("lang", "phrase", "route")), pa.array(shards, pa.int64()), pa.array(ids, pa.int64())],
                ["lang", "phrase", "route", "shard", "id"],
            )

    # neighbours share their first word, and a shard fills its trie
    routes = stored(phrases.mapInArrow(routed, "lang string, phrase string, route long"), "routes")
    ordered = routes.repartitionByRange("route").sortWithinPartitions("route", "lang", "phrase")
    return ordered.mapInArrow(run, "lang string, phrase string, route long, shard long, id long")


def _coded(phrase: bytes) -> bytes:
    """The phrase as tries have it."""
    return phrase if len(phrase) <= LONG_WORD else b" ".join(map(_stand_in, phrase.split(b" ")))


def _summed(lang: str, sent: list[tuple[bytes, bytes]], trie_bytes: int, pass_bytes: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct phrases of a parcel's rows and the sums of their times."""
    names: dict[bytes, bytes] = {}
    passes: list[tuple[np.ndarray, np.ndarray]] = []
    texts, times, held = [], [], 0

    def walkable() -> tuple[np.ndarray, np.ndarray]:
        text = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        return text, np.concatenate(times)

    for phrases, sums in sent:
        phrases = phrases.split(b"\n")
        coded = list(map(_coded, phrases))
        names.update(zip(coded, phrases))
        text = b"\n".join(coded)
        if texts and held + len(text) > pass_bytes:
            passes.append(walkable())
            texts, times, held = [], [], 0
        texts.append(text)
        times.append(_times(sums, len(phrases)))
        held += len(text)
    passes.append(walkable())
    keys = list(names)
    sizes = np.cumsum([len(key) for key in keys])
    cuts = [0, *(np.flatnonzero(np.diff(sizes // trie_bytes)) + 1).tolist(), len(keys)]
    total = np.zeros(len(keys), np.int64)
    left = [np.append(0, np.flatnonzero(text == _END)[:-1] + 1) for text, _ in passes]
    for a, b in zip(cuts, cuts[1:]):
        trie = DoubleArray([lang] * (b - a), keys[a:b])
        for i, (text, times) in enumerate(passes):
            found = accepted(trie, lang, text, left[i])
            here = found >= 0
            total[a:b] += _weighted(found[here], times[here], b - a)
            left[i], passes[i] = left[i][~here], (text, times[~here])
    return list(names.values()), total


def _weighted(numbers: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """The sums of the times of each number; in two halves, as ``bincount`` adds floats."""
    low, high = (np.bincount(numbers, part, size).astype(np.int64) for part in (times & 0xFFFF, times >> 16))
    return low + (high << 16)


def counted(sent: DataFrame, trie_bytes: int = TRIE_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``lang, phrase, f``: how often each of the phrases occurs that stand in ``parcel, lang, phrases, times``. Rows
    of a parcel and language come one after the other, so a task holds the phrases of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def summed() -> pa.RecordBatch:
            phrases, f = _summed(now[1], rows, trie_bytes, pass_bytes)
            names = pa.array([now[1]] * len(phrases), pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(f)], ["lang", "phrase", "f"])

        for batch in batches:
            for parcel, lang, phrases, times in zip(*(batch[c].to_pylist() for c in _PARCEL_COLUMNS)):
                if (parcel, lang) != now:
                    if rows:
                        yield summed()
                    now, rows = (parcel, lang), []
                rows.append((phrases, times))
        if rows:
            yield summed()

    dealt = sent.select(*_PARCEL_COLUMNS).repartition("parcel", "lang").sortWithinPartitions("parcel", "lang")
    return dealt.mapInArrow(run, "lang string, phrase string, f long")


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ", -1)


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _scored(frequent: DataFrame, parts: DataFrame) -> DataFrame:
    """Candidates with the cut of the lowest score. Numbers are decimals of 38 digits, so products of
    counts beyond 64 bits are exact."""
    words = _words(F.col("phrase"))
    cuts = frequent.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    sides = cuts.select(
        "*",
        _joined(words, F.lit(1), F.col("k")).alias("head"),
        _joined(words, F.col("k") + 1, F.size(words) - F.col("k")).alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr(
        "(1000000BD * cast(a AS decimal(16, 0)) * cast(a AS decimal(15, 0)))"
        " div (cast(l AS decimal(19, 0)) * cast(r AS decimal(18, 0)))"
    )
    met = sides.join(left, ["lang", "head"]).join(right, ["lang", "rest"]).withColumn("score", score)
    lowest = met.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(frequent: DataFrame, percent: int) -> DataFrame:
    """Candidates that stand in a longer candidate often enough to be told by it."""
    words = _words(F.col("phrase"))
    size = F.size(words)
    spots = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), s -> array_join(slice(w, s, n), ' '))))"
    )
    inner = frequent.where(size > 2).withColumn("w", words).select("lang", F.explode(spots).alias("phrase"), F.col("f").alias("longer"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return frequent.join(most, ["lang", "phrase"]).where(100 * F.col("longer") >= percent * F.col("f")).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    max_words: int = 3,
    top: int = 2000,
    covered_percent: int = 50,
    trie_bytes: int = TRIE_BYTES,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` collocations of
    ``docs(lang, text, ...)``.

    ``a``, ``l`` and ``r`` are how often the phrase and its two parts at the cut occur, ``n`` the words
    of the language, ``score`` a million times ``a * a / (l * r)``, rounded down. Of the cuts the one with the
    lowest score counts, of equal ones the first. Phrases that occur ``covered_percent`` or more of
    the time inside one longer candidate are left out. Ties in rank go by ``a``, then by the phrase's bytes.
    Rows without lang are of ``und``; null and empty texts have no words; every row counts, repeated
    ones too. Other columns are not looked at. An empty table gives an empty result.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words or more")
    with small_batches(docs.sparkSession):
        texts = _texts(docs)
        words = stored(word_counts(texts), "words")
        sent = candidates(texts, words, min_count, max_words)
        frequent = stored(counted(sent, trie_bytes, pass_bytes).where(F.col("f") >= min_count), "phrase-counts")
    parts = words.where(F.col("f") >= min_count).unionByName(frequent)
    kept = _scored(frequent, parts).join(_covered(frequent, covered_percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return first.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
