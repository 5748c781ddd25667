"""Exact top-k by inner product with MaxScore over blocks of terms.

Vectors have integer components. A lane holds many vectors, in order of their ids, as columns of one
matrix; its terms (components) are ordered by what they can add. The first of them are essential: their
part of the scores of a block of queries and a tile of vectors is one matrix product. What the others
can add at most is the product of two norms, which the same matrix product adds in one more row.
Vectors whose bound does not pass a query's k-th score so far are out; the rest is scored exactly.
Where such bounds leave too many, which is so for vectors that differ alike in all terms, the tile is
multiplied with all terms. Scores are whole numbers, and products are taken in the shortest float type
that holds every sum exactly, or else in 64-bit integers.

Queries and vectors meet in blocks: each lane reads its vectors once and every block of queries once.
The number of products grows with queries times vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .tables import small_batches, stored

#: vectors and queries that travel together, and bytes of them at most
VECTOR_ROWS, QUERY_ROWS, BLOCK_BYTES = 1024, 512, 1 << 20
#: bytes of the vectors of a lane, as floats, and lanes per core of a small table
LANE_BYTES, LANES_PER_CORE = 64 << 20, 4
#: vectors scored first to get a k-th score, and then at once
FIRST_TILE, TILE = 512, 2048
#: the essential terms have this share of the squares; bounds that leave more than that share of the
#: pairs cost more than they save, and are tried again so many tiles later
ESSENTIAL, WORTH, AGAIN = 0.75, 0.002, 16

#: the score of no vector; its negative is a long
_NONE = np.iinfo(np.int64).min + 1

BLOCK = "block long, ids binary, weights binary, width int"


def weights(vector: Column) -> Column:
    """``floor(256 * x)`` of each component as double; null if any is null or not finite."""
    usable = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")))


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in the shortest type."""
    for kind in (np.int16, np.int32):
        limits = np.iinfo(kind)
        if matrix.min(initial=0) >= limits.min and matrix.max(initial=0) <= limits.max:
            return matrix.astype(kind)
    return matrix


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows(vec_id, w)`` packed into blocks of at most ``size``; shorter vectors end in zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            if not len(batch):
                continue
            longest = int(batch["w"].value_lengths().to_numpy().max())
            step = max(1, min(size, BLOCK_BYTES // (8 * longest)))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                lists = part["w"]
                sizes = lists.value_lengths().to_numpy()
                flat = lists.flatten().to_numpy()
                width = int(sizes.max())
                matrix = np.zeros((len(part), width), np.int64)
                matrix[np.arange(width) < sizes[:, None]] = flat
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "block": TaskContext.get().partitionId() << 32 | number,
                            "ids": part["vec_id"].to_numpy().tobytes(),
                            "weights": _narrow(matrix).tobytes(),
                            "width": width,
                        }
                    ],
                    schema=pa.schema(
                        [("block", pa.int64()), ("ids", pa.binary()), ("weights", pa.binary()), ("width", pa.int32())]
                    ),
                )
                number += 1

    return stored(rows.mapInArrow(run, BLOCK), name)


def _unpacked(ids: bytes, flat: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(flat, f"i{len(flat) // (len(ids) * width)}").reshape(-1, width)


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(matrix, dtype=np.float64).sum(axis=1))


def _kind(most: float) -> type:
    """A type in which whole numbers up to ``most`` are exact."""
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _arranged(matrix: np.ndarray, essential: int, bounds: np.ndarray, kind: type) -> np.ndarray:
    """The essential terms, then the bounds of the others, then the others."""
    out = np.empty((len(matrix), matrix.shape[1] + 1), kind)
    out[:, :essential], out[:, essential], out[:, essential + 1 :] = matrix[:, :essential], bounds, matrix[:, essential:]
    return out


class Lane:
    """Vectors in order of their ids: of equal scores the first is the better one."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        ids = np.concatenate([ids for ids, _ in parts])
        self.width = max(matrix.shape[1] for _, matrix in parts)
        whole = np.zeros((len(ids), self.width), np.result_type(*(matrix.dtype for _, matrix in parts)))
        at = 0
        for _, matrix in parts:
            whole[at : at + len(matrix), : matrix.shape[1]] = matrix
            at += len(matrix)
        order = np.argsort(ids, kind="stable")
        cuts = [0, *range(FIRST_TILE, len(ids), TILE), len(ids)]
        squares = sum(np.square(whole[a:b], dtype=np.float64).sum(axis=0) for a, b in zip(cuts, cuts[1:]))
        self.terms = np.argsort(-squares, kind="stable")
        shares = np.cumsum(squares[self.terms])
        self.essential = min(int(np.searchsorted(shares, ESSENTIAL * shares[-1])) + 1, self.width)
        #: per tile ids, columns as arranged, and the largest norm
        self.tiles = []
        for a, b in zip(cuts, cuts[1:]):
            part = whole[order[a:b]][:, self.terms]
            most = float(_norms(part).max()) + 2
            rest = np.ceil(_norms(part[:, self.essential :]))
            columns = np.ascontiguousarray(_arranged(part, self.essential, rest, _kind(most)).T)
            self.tiles.append((ids[order[a:b]], columns, most))

    def search(self, own: np.ndarray, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query ids, vector ids, scores`` of the k best of this lane for each query."""
        queries = np.zeros((len(own), self.width), asked.dtype)
        queries[:, : asked.shape[1]] = asked[:, : self.width]
        queries = queries[:, self.terms]
        most = float(_norms(queries).max()) + 2
        rest = np.ceil(_norms(queries[:, self.essential :]))
        best = Best(len(own), k)
        forms: dict[type, tuple[np.ndarray, np.ndarray]] = {}
        room = np.empty(0)
        wait = 1
        for ids, columns, norm in self.tiles:
            kind = _kind(most * norm)
            if kind not in forms:
                bounded = _arranged(queries, self.essential, rest, kind)
                whole = bounded.copy()
                whole[:, self.essential] = 0
                forms[kind] = np.ascontiguousarray(bounded[:, : self.essential + 1]), whole
            bounded, whole = forms[kind]
            columns = columns.astype(kind, copy=False)
            if room.dtype != kind or room.shape[1:] != columns.shape[1:]:
                room = np.empty((len(own), columns.shape[1]), kind)
            wait -= 1
            if wait < 0 and self.essential + 1 < self.width and kind is not np.int64 and best.floor.min() > _NONE:
                row, at = best.passing(np.matmul(bounded, columns[: self.essential + 1], out=room))
                if len(row) <= WORTH * room.size:
                    others = slice(self.essential + 1, None)
                    score = np.einsum("ij,ji->i", whole[row, others], columns[others, at])
                    score += np.einsum("ij,ji->i", whole[row, : self.essential], columns[: self.essential, at])
                    keep = (score > best.floor[row]) & (ids[at] != own[row])
                    best.add(row[keep], ids[at[keep]], score[keep].astype(np.int64))
                    continue
                wait = AGAIN
            scores = np.matmul(whole, columns, out=room)
            if best.floor.min() == _NONE:
                scores[ids == own[:, None]] = _NONE
                best.expect(scores)
            row, at = best.passing(scores)
            keep = ids[at] != own[row]
            row, at = row[keep], at[keep]
            best.add(row, ids[at], scores[row, at].astype(np.int64))
        row, at = np.nonzero(best.scores > _NONE)
        return own[row], best.ids[row, at], best.scores[row, at]


class Best:
    """The k best of each query so far, and the score that another one must pass."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), _NONE)
        self.ids = np.zeros((queries, k), np.int64)
        self.floor = np.full(queries, _NONE)

    def expect(self, scores: np.ndarray) -> None:
        """Raises floors to just below the k-th of these scores, which are to be added next."""
        if scores.shape[1] > self.k:
            least = np.partition(scores, -self.k, axis=1)[:, -self.k].astype(np.int64)
            self.floor = np.maximum(self.floor, np.where(least > _NONE, least - 1, _NONE))

    def passing(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a floor that the type does not hold is beyond all scores of the type, and rounds to such
        floor = self.floor.astype(scores.dtype)
        rows = np.flatnonzero(scores.max(axis=1) > floor)
        row, at = np.nonzero(scores[rows] > floor[rows, None])
        return rows[row], at

    def add(self, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(row):
            return
        known = np.unique(row)
        row = np.concatenate([row, np.repeat(known, self.k)])
        ids = np.concatenate([ids, self.ids[known].ravel()])
        scores = np.concatenate([scores, self.scores[known].ravel()])
        order = np.lexsort((ids, -scores, row))
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        self.ids[known] = ids[order].reshape(-1, self.k)
        self.scores[known] = scores[order].reshape(-1, self.k)
        self.floor[known] = np.maximum(self.floor[known], self.scores[known, -1])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best of all other vectors for each query.

    ``vectors(vec_id, embedding, ...)``. Rows without id, or whose vector is null or has a null or
    non-finite component, take no part. Rows of the query's id are its own and no candidates;
    otherwise repeated rows are candidates each, and repeated queries are one. Ties go to the
    smaller id. Vectors of different length are compared on the components both have.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), weights(F.col("embedding")).alias("w"), is_query.alias("asked")
    ).where("vec_id IS NOT NULL AND w IS NOT NULL AND size(w) > 0")
    blocks = _blocks(rows.select("vec_id", "w"), VECTOR_ROWS, "vectors")
    asked = rows.where("asked").dropDuplicates(["vec_id"]).select("vec_id", "w")
    queries = _blocks(asked, QUERY_ROWS, "queries")

    # blocks of vectors, one after the other, fill lanes; every block of queries goes to each lane
    sizes = blocks.select("block", (F.length("ids") / 8 * (F.col("width") + 1) * 4).cast("long").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 1
    room = min(LANE_BYTES, -(-total // (LANES_PER_CORE * spark.sparkContext.defaultParallelism)))
    count = -(-total // room)
    before = F.sum("size").over(Window.orderBy("block")) - F.col("size")  # one row per block of vectors
    lanes = blocks.join(sizes.select("block", F.floor(before / room).cast("long").alias("lane")), "block")
    lane_of = F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>"))
    columns = ["lane", "asked", "ids", "weights", "width"]
    met = lanes.withColumn("asked", F.lit(False)).select(columns).unionAll(
        queries.withColumn("asked", F.lit(True)).withColumn("lane", lane_of).select(columns)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, lane = None, [], None
        for batch in batches:
            for number, is_asked, ids, flat, width in zip(*(column.to_pylist() for column in batch.columns)):
                if number != now:
                    now, parts, lane = number, [], None
                if not is_asked:
                    parts.append(_unpacked(ids, flat, width))
                elif parts or lane is not None:
                    if lane is None:
                        lane, parts = Lane(parts), []
                    found = lane.search(*_unpacked(ids, flat, width), k)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    with small_batches(spark, 16):
        dealt = met.repartition(count, "lane").sortWithinPartitions("lane", "asked")
        best = stored(dealt.mapInArrow(run, "query_id long, vec_id long, score long"), "best")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
