"""Exact duplicates by Grace hash deduplication over whole contents.

A text's content is its bytes without white space (``[\\x20\\x09-\\x0D]``); texts are equal when
their contents are, byte for byte. Records are partitioned by content hash into buckets, each bucket
streams once through an open-addressing table that compares complete contents, and what does not
fit the table's memory is written to spill files and partitioned again by other bits of the hash,
until every bucket fits.

Scale. One map pass folds the rows of a task's window by the same kind of table, so a group of copies
that holds a third of all rows sends one record per window into its bucket, not one per row. Only
those records carry contents through the shuffle; rows go on as a few numbers. Each level of the recursion is
one Spark job: buckets are shuffle partitions, spill files are Parquet in the shared folder, so an
overfull bucket is dealt over the whole cluster again and a lost executor costs one task. A level
resolves the first contents of every bucket at least, so the recursion ends, also for contents of
one hash. Memory of a task is ``TABLE_BYTES`` of contents, one batch and 24 bytes a record.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, stored

#: contents that a table may hold; a bucket with more goes on to the next level
TABLE_BYTES = 64 << 20
#: contents and rows of a window that is folded before the shuffle
WINDOW_BYTES = 16 << 20
WINDOW_ROWS = 50_000
#: fixed value: the bytes that do not count when texts are compared
IGNORED = b" \t\n\x0b\x0c\r"


class OpenTable:
    """Contents by open addressing with linear probing, at most half full.

    ``place`` gives the entry of a content, a new one if it was not there, and -1 if it is
    new and ``limit`` bytes of contents are held already. The first content is always taken.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.held = 0
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self._slots = [-1] * 1024

    def __len__(self) -> int:
        return len(self.hashes)

    def _grow(self) -> None:
        mask = 2 * len(self._slots) - 1
        self._slots = [-1] * (mask + 1)
        for entry, h in enumerate(self.hashes):
            i = h & mask
            while self._slots[i] >= 0:
                i = (i + 1) & mask
            self._slots[i] = entry

    def place(self, h: int, content: bytes) -> int:
        slots, mask = self._slots, len(self._slots) - 1
        i = h & mask
        while (entry := slots[i]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            i = (i + 1) & mask
        if self.held and self.held + len(content) > self.limit:
            return -1
        slots[i] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.held += len(content) + 1  # an empty content counts as well
        if 2 * len(self.hashes) > len(slots):
            self._grow()
        return len(self.hashes) - 1


def _better(chars: int, name: int | None, than: tuple[int, int | None] | None) -> bool:
    """Whether a row goes before the best so far: more code points, then the smaller doc_id, a
    missing one last. A tie leaves the earlier row."""
    if than is None or chars != than[0]:
        return than is None or chars > than[0]
    return name is not None and (than[1] is None or name < than[1])


_WINDOWS = pa.schema(
    [
        ("doc_id", pa.int64()), ("window", pa.int64()), ("first", pa.bool_()), ("best", pa.bool_()),
        ("sha", pa.string()), ("hash", pa.int64()), ("content", pa.binary()), ("bytes", pa.int64()),
        ("rows", pa.int64()), ("chars", pa.int64()), ("best_id", pa.int64()),
    ]
)
_ROWS = (
    "doc_id long, window long, first boolean, best boolean, sha string, hash long, content binary,"
    " bytes long, rows long, chars long, best_id long"
)


def windows(docs: DataFrame) -> DataFrame:
    """Every row with the number ``window`` of its content in the rows around it.

    The first row of a number also carries the content and what is known of the number's rows: how
    many, and the best one's code points and doc_id. ``best`` marks that row. ``sha`` is the SHA-256
    of the content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        names: list[int | None] = []
        chars: list[int] = []
        entries: list[int] = []
        table = OpenTable(WINDOW_BYTES)

        def folded() -> Iterator[pa.RecordBatch]:
            nonlocal number, table, names, chars, entries
            n = len(table)
            rows, opened = [0] * n, [-1] * n
            best: list[tuple[int, int | None] | None] = [None] * n
            best_row = [-1] * n
            for row, entry in enumerate(entries):
                rows[entry] += 1
                if opened[entry] < 0:
                    opened[entry] = row
                if _better(chars[row], names[row], best[entry]):
                    best[entry], best_row[entry] = (chars[row], names[row]), row
            shas = [sha256(c).hexdigest() for c in table.contents]
            signed = np.array(table.hashes, np.uint64).view(np.int64)
            first = np.zeros(len(entries), bool)
            first[opened] = True
            wins = np.zeros(len(entries), bool)
            wins[best_row] = True
            # rows in pieces, so that the contents of one piece at a time are copied
            for at in range(0, len(entries), 2000):
                part = entries[at : at + 2000]
                head = first[at : at + 2000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[at : at + 2000], pa.int64()),
                        pa.array(number + np.array(part, np.int64)),
                        pa.array(head),
                        pa.array(wins[at : at + 2000]),
                        pa.array([shas[e] for e in part]),
                        pa.array(signed[part]),
                        pa.array([table.contents[e] if f else None for e, f in zip(part, head)], pa.binary()),
                        pa.array([len(table.contents[e]) for e in part], pa.int64()),
                        pa.array([rows[e] for e in part], pa.int64()),
                        pa.array([best[e][0] for e in part], pa.int64()),
                        pa.array([best[e][1] for e in part], pa.int64()),
                    ],
                    schema=_WINDOWS,
                )
            number += n
            names, chars, entries, table = [], [], [], OpenTable(WINDOW_BYTES)

        for batch in batches:
            for name, length, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "chars", "text"))):
                content = text.translate(None, IGNORED)
                h = xxhash.xxh3_64_intdigest(content)
                if len(entries) == WINDOW_ROWS:
                    yield from folded()
                entry = table.place(h, content)
                if entry < 0:
                    yield from folded()
                    entry = table.place(h, content)
                names.append(name)
                chars.append(length)
                entries.append(entry)
        if entries:
            yield from folded()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("chars"),
        text.cast("binary").alias("text"),
    )
    return plain.mapInArrow(run, _ROWS)


_FOUND = "window long, keep_id long, group_size long, wins boolean, hash long, content binary, bytes long, rows long, chars long, best_id long"
_FIELDS = ("window", "hash", "content", "bytes", "rows", "chars", "best_id")


def _resolve(records: DataFrame, table_bytes: int) -> DataFrame:
    """Records of each bucket (partition) with their group, or as they came where the table was full.

    All records of a content are in one bucket and see the same table: the content is either in it
    from its first record on, or never.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable(table_bytes)
        window, entries, size = [], [], []
        best: list[tuple[int, int | None]] = []
        winner: list[int] = []
        for batch in batches:
            columns = {c: batch[c].to_pylist() for c in _FIELDS}
            left = []
            for row, content in enumerate(columns["content"]):
                entry = table.place(columns["hash"][row] & (2**64 - 1), content)
                if entry < 0:
                    left.append(row)
                    continue
                mine = (columns["chars"][row], columns["best_id"][row])
                if entry == len(size):
                    size.append(0)
                    best.append(mine)
                    winner.append(len(window))
                elif _better(*mine, best[entry]):
                    best[entry], winner[entry] = mine, len(window)
                size[entry] += columns["rows"][row]
                window.append(columns["window"][row])
                entries.append(entry)
            if left:
                spilled = batch.take(pa.array(left)).select(_FIELDS)
                nothing = [pa.nulls(len(left), t) for t in (pa.int64(), pa.int64(), pa.bool_())]
                yield pa.RecordBatch.from_arrays(
                    [spilled["window"], *nothing, *(spilled[c] for c in _FIELDS[1:])],
                    ["window", "keep_id", "group_size", "wins", *_FIELDS[1:]],
                )
        wins = np.zeros(len(window), bool)
        wins[winner] = True
        for at in range(0, len(window), 50_000):
            part = entries[at : at + 50_000]
            n = len(part)
            numbers = [
                pa.array(window[at : at + 50_000], pa.int64()),
                pa.array([best[e][1] for e in part], pa.int64()),
                pa.array([size[e] for e in part], pa.int64()),
                pa.array(wins[at : at + 50_000]),
            ]
            rest = [pa.nulls(n, t) for t in (pa.int64(), pa.binary(), *[pa.int64()] * 4)]
            yield pa.RecordBatch.from_arrays(
                [*numbers, *rest], ["window", "keep_id", "group_size", "wins", *_FIELDS[1:]]
            )

    return records.mapInArrow(run, _FOUND)


def grouped(records: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``window, keep_id, group_size, wins`` for every record of a window.

    Level by level: as many buckets as the contents need at half a table each, then the records that
    found their table full, by other bits of the hash.
    """
    done: DataFrame | None = None
    level = 0
    while True:
        volume = records.agg(F.sum(F.col("bytes") + 1)).first()[0]
        if volume is None and done is not None:
            return done
        buckets = 1 + 2 * (volume or 0) // table_bytes
        dealt = records.repartition(buckets, F.xxhash64(F.col("hash"), F.lit(level)))
        found = stored(_resolve(dealt, table_bytes), f"bucket-level-{level}")
        here = found.where("group_size IS NOT NULL").select("window", "keep_id", "group_size", "wins")
        done = here if done is None else done.union(here)
        records = found.where("group_size IS NULL").select(*_FIELDS)
        level += 1


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs(doc_id, text, ...)``.

    Of rows with equal contents the one with the most code points stays, then the one with the
    smallest doc_id, a missing doc_id last; of rows that tie in both (repeated rows) exactly one has
    ``kept``. Null, empty and white texts have the same, empty content and are one group. ``keep_id``
    is null only where no best row of the group has a doc_id. Other columns are not looked at. An
    empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        rows = stored(windows(docs), "windows")
        found = grouped(rows.where("first").select(*_FIELDS), table_bytes)
    return rows.select("doc_id", "window", "best", "sha").join(found, "window").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("best") & F.col("wins")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
