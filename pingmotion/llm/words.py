"""Words of whole texts as numpy arrays, read straight from Arrow buffers.

Python tasks of this package share these helpers: no Python object is made per word, and a
batch is cut into pieces of a few hundred kilobytes, so that memory does not follow the batch
(one text is never cut, so a piece is at least as long as its longest text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: the byte class ``[\x20\x09-\x0D]``
SPACES = b" \t\n\x0b\x0c\r"
PIECE_BYTES = 1 << 19

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWER = _U(0x9E3779B97F4A7C15)  # odd, so no power of it vanishes


def byte_set(members: bytes) -> np.ndarray:
    """A table of 256 truth values."""
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


IS_SPACE = byte_set(SPACES)
#: white space and the ASCII characters that are neither letters nor digits
IS_SPACE_OR_MARK = byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a string column with their UTF-8 bytes and offsets; null reads as empty.

    Yields ``(first row, end row, bytes, offsets)``; the offsets start at 0 and have one entry
    more than there are rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, stops: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per text (plus one) the number of its first word.

    A word is a longest run of bytes outside ``stops``; it never spans two texts.
    """
    n = len(data)
    solid = ~stops[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True
) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``lower`` folds A-Z first."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    letters = data[place + np.repeat(starts, sizes)]
    powers = np.full(int(sizes.max()), _POWER)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    values = _BYTE_VALUE[_LOWER[letters] if lower else letters] * powers[place]
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64))


def text_of_word(ptr: np.ndarray) -> np.ndarray:
    """For every word the number of its text."""
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def shingles(hashes: np.ndarray, ptr: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the text of each.

    A text of fewer words has one shingle, its whole sequence; a text without words none.
    """
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | _U(1)
    counts = np.diff(ptr)
    n = len(hashes)
    text = text_of_word(ptr)
    left = ptr[1:][text] - np.arange(n)  # words from here to the end of the text
    run = np.zeros(n, np.uint64)
    for j in range(width):
        if j < n:
            run[: n - j] += np.where(left[: n - j] > j, hashes[j:] * factors[j], _U(0))
    short = counts < width
    keep = (left >= width) | (short[text] & (left == counts[text]))
    run = run + np.minimum(left, width).astype(np.uint64)
    return mix(run[keep]), text[keep]


def distinct_per_text(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, in order, and their texts."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], text[new]
