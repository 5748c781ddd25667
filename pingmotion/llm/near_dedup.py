"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A text becomes its set of word shingles, the set a signature of ``5 * chunks`` MinHash values of
12 bits, five of them in each 60-bit chunk. Two signatures within ``2 * chunks - 1`` differing
values have, by pigeonhole, a chunk with at most one difference. So every chunk is entered five
times, each time without one of its values (the allowed errors, enumerated): all pairs within
that distance meet under an equal key. ``chunks`` is chosen so that a pair at the similarity
threshold exceeds the distance with a probability below ``miss``. Whatever meets is confirmed on
the full sets.

Scale. Equal sets fold to one node first, by pre-aggregation. Keys of one member drop out by a
pre-aggregated count. Members of a key are never paired with one another but with a centre,
picked by hash so that the same node is the centre of many keys: first each node with one centre
only, then, in keys that still hold several components, all members with their centre, which then
leaves the key. So a round makes at most as many pairs as there are members, and a group of near copies, which
its centre holds together, is done after the first. What is still apart after a few rounds shares
keys without being linked, as texts with a common passage do. Such nodes meet again under their rarest
shingles: of ``n`` shingles the ``(1 - t) n + 1`` rarest, of which any pair at similarity ``t`` has one in
common, early enough in the order that what follows can make up the similarity. Common passages are
not among them. There the number of centres grows from round to round until every pair under
a common rare shingle is linked or was compared, so no link is lost.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .tables import bitmap, marked, small_batches, stored

SHINGLE_WORDS = 5
PER_CHUNK = 5
VALUE_BITS = 12
#: rounds under signature keys before what is still apart meets under rare shingles
KEY_ROUNDS = 1
#: how the number of centres grows from round to round there
GROWTH = 4
#: buckets in which shingles are counted to tell rare ones
RARITY_BUCKETS = 1 << 22

_U = np.uint64
_LANE = (1 << VALUE_BITS) - 1
_LANES = sum(1 << (VALUE_BITS * i) for i in range(PER_CHUNK))


def chunks_needed(similarity: float, miss: float = 1e-5) -> int:
    """The fewest chunks with which a pair of this similarity is missed at most so often."""
    for chunks in range(2, 200):
        k, p = PER_CHUNK * chunks, 1 - similarity
        if sum(comb(k, d) * p**d * (1 - p) ** (k - d) for d in range(2 * chunks, k + 1)) <= miss:
            return chunks
    raise ValueError("similarity too low for this index")


def _multipliers(chunks: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    draw = rng.integers(0, 2**63, (2, 200 * PER_CHUNK), dtype=np.uint64)[:, : PER_CHUNK * chunks]
    return draw[0], draw[1] | _U(1)


def signatures(docs: DataFrame, chunks: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, sig`` per document: set size, set digest, chunks as bytes.

    Texts without words have size 0 and no signature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adds, factors = _multipliers(chunks)
        for batch in batches:
            for first, end, data, offsets in W.pieces(batch["text"]):
                starts, ends, ptr = W.word_spans(data, offsets)
                hashes = W.word_hashes(data, starts, ends)
                values, text = W.distinct_per_text(*W.shingles(hashes, ptr, SHINGLE_WORDS))
                sizes = np.bincount(text, minlength=end - first).astype(np.int64)
                full = np.flatnonzero(sizes)
                sig = np.zeros((len(full), chunks), np.uint64)
                digest = np.zeros((2, end - first), np.uint64)
                if len(full):
                    begin = (np.cumsum(sizes) - sizes)[full]
                    digest[0, full] = np.add.reduceat(values, begin)
                    digest[1, full] = np.add.reduceat(W.mix(values ^ _U(0xA5A5A5A5)), begin)
                    for k in range(PER_CHUNK * chunks):
                        least = np.minimum.reduceat((values ^ adds[k]) * factors[k], begin)
                        low = W.mix(least) & _U(_LANE)
                        sig[:, k // PER_CHUNK] |= low << _U(VALUE_BITS * (k % PER_CHUNK))
                packed = [None] * (end - first)
                for row, chunk_values in zip(full, sig):
                    packed[row] = chunk_values.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][first:end],
                        pa.array(sizes),
                        pa.array(digest[0].view(np.int64)),
                        pa.array(digest[1].view(np.int64)),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "sig"],
                )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, sig binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def index_keys(sets: DataFrame, chunks: int) -> DataFrame:
    """``key, node``: every chunk with each of its values left out in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holes = np.array([~(_LANE << (VALUE_BITS * h)) & (2**64 - 1) for h in range(PER_CHUNK)], np.uint64)
        salt = W.mix(np.arange(1, chunks * PER_CHUNK + 1, dtype=np.uint64)).reshape(chunks, PER_CHUNK)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                sig = _matrix(part["sig"], chunks)
                keys = W.mix((sig[:, :, None] & holes) ^ salt).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.repeat(part["node"].to_numpy(), chunks * PER_CHUNK)),
                    ],
                    ["key", "node"],
                )

    return sets.select("node", "sig").mapInArrow(run, "key long, node long")


def _matrix(column: pa.Array, chunks: int) -> np.ndarray:
    """Signatures of a binary column without nulls, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), chunks)


def _differing(x: np.ndarray) -> np.ndarray:
    """For chunks ``a ^ b`` a number with one bit, at the foot of its lane, per differing value."""
    x = x | (x >> _U(1))
    x = x | (x >> _U(2))
    # offsets 0-3 of each lane of 12 bits so far, then 0-7 and 8-11
    return (x | (x >> _U(4)) | (x >> _U(8))) & _U(_LANES)


def _within_distance(pairs: DataFrame, chunks: int) -> DataFrame:
    """Those of ``pairs(a, b, sig_a, sig_b)`` whose signatures are within the distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                bits = _differing(_matrix(batch["sig_a"], chunks) ^ _matrix(batch["sig_b"], chunks))
                keep = pa.array(np.bitwise_count(bits).sum(axis=1) <= 2 * chunks - 1)
                yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingles of each text, in order."""
    for first, end, data, offsets in W.pieces(column):
        starts, ends, ptr = W.word_spans(data, offsets)
        values, text = W.distinct_per_text(
            *W.shingles(W.word_hashes(data, starts, ends), ptr, SHINGLE_WORDS)
        )
        yield from np.split(values, np.searchsorted(text, np.arange(1, end - first)))


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, set``: the shingles of the nodes, as sorted 64-bit numbers in bytes.

    ``nodes`` has ``node, rep`` and the digest of its set; a doc_id may stand for several texts, of which
    the one with that digest is taken. Texts of other documents stay where they are.
    """
    texts = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("bits", bitmap(nodes, "rep").scalar())
        .where(marked(F.col("bits"), F.col("doc_id")))
        .drop("bits")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets, held = [], [], 0

            def packed() -> pa.RecordBatch:
                size, d1, d2 = (pa.array(column, pa.int64()) for column in zip(*[(len(x), *_digest(x)) for x in sets]))
                ids = batch["doc_id"].take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [ids, size, d1, d2, pa.array([x.tobytes() for x in sets], pa.binary())],
                    ["rep", "n_shingles", "d1", "d2", "set"],
                )

            for row, values in enumerate(_sets_of(batch["text"])):
                rows.append(row)
                sets.append(values)
                held += len(values)
                if held > 500_000:
                    yield packed()
                    rows, sets, held = [], [], 0
            if rows:
                yield packed()

    read = texts.mapInArrow(run, "rep long, n_shingles long, d1 long, d2 long, set binary")
    found = stored(read.join(nodes, ["rep", "n_shingles", "d1", "d2"]).select("node", "set"), "shingle-sets")
    # a representative may stand in the table more than once
    if found.groupBy("node").count().where("count > 1").limit(1).count():
        found = stored(found.groupBy("node").agg(F.min("set").alias("set")), "shingle-sets")
    return found


def _digest(values: np.ndarray) -> tuple[int, int]:
    """The digest of a set as ``signatures`` computes it."""
    if not len(values):
        return 0, 0
    both = np.array([np.add.reduce(values), np.add.reduce(W.mix(values ^ _U(0xA5A5A5A5)))])
    first, second = both.view(np.int64).tolist()
    return first, second


def confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have ``100 * intersection >= percent * union``."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"], batch["set_b"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    met = pairs.join(right, "b").join(left, "a")
    return met.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


class _Linking:
    """The state of a run: nodes, what is known of their components, and how pairs are looked at."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, percent: int, chunks: int):
        self.docs, self.nodes, self.percent, self.chunks = docs, nodes, percent, chunks
        self.groups = docs.sparkSession.createDataFrame([], "node long, component long")
        #: pairs compared on full sets, for tests
        self.compared: list[int] = []

    def mixed(self, members: DataFrame) -> DataFrame:
        """Members of the keys that hold several components, with ``group``, the key's size ``n`` and
        its smallest ``spot`` as ``least``."""
        grouped = members.join(self.groups, "node", "left").select(
            *members.columns, F.coalesce("component", "node").alias("group")
        )
        grouped = stored(grouped, "grouped")
        keys = grouped.groupBy("key").agg(
            F.count("*").alias("n"), F.min("spot").alias("least"), F.min("group").alias("lo"), F.max("group").alias("hi"),
            *([F.max(_self_reaching(self.percent)).alias("reached")] if "at" in members.columns else []),
        )
        if "reached" in keys.columns:
            keys = keys.where("reached").drop("reached")
        # written, so that both sides of the join are plain shuffles and a hot key can be split
        keys = stored(keys.where("lo < hi").drop("lo", "hi"), "mixed-keys")
        return stored(grouped.join(keys, "key"), "mixed")

    def link(self, pairs: DataFrame, near: bool, sets: DataFrame | None = None) -> None:
        """Compare the pairs ``a, b`` of nodes and join the components of those that are similar."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        facts = self.nodes.select("node", "n_shingles", "sig")
        left = facts.select(F.col("node").alias("a"), F.col("n_shingles").alias("size_a"), F.col("sig").alias("sig_a"))
        right = facts.select(F.col("node").alias("b"), F.col("n_shingles").alias("size_b"), F.col("sig").alias("sig_b"))
        least, most = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
        pairs = stored(pairs, "pairs").join(left, "a").join(right, "b").where(100 * least >= self.percent * most)
        if near:
            pairs = _within_distance(pairs.select("a", "b", "sig_a", "sig_b"), self.chunks)
        pairs = stored(pairs.select("a", "b"), "candidates")
        self.compared.append(pairs.count())
        if not self.compared[-1]:
            return
        if sets is None:
            ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            ends = stored(ends.join(self.nodes, "node").drop("sig"), "ends")
            sets = shingle_sets(self.docs, ends)
        found = stored(confirmed(sets, pairs, self.percent), "links")
        if not found.limit(1).count():
            return
        named = self.groups
        for end in ("a", "b"):
            found = found.join(named.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of")), end, "left")
        found = found.select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
        joined = components(found, "a", "b")
        # nodes under a component that has joined another, and the component's own node
        moved = named.join(joined.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
        moved = moved.select("node", F.coalesce("now", "component").alias("component"))
        self.groups = stored(moved.union(joined), "groups")


def _self_reaching(percent: int):
    """Whether a set of the same size could be similar, if this shingle is the first of the order that
    the two have in common. Of a similar pair the smaller set is such a member of the first common key."""
    return (100 + percent) * (F.col("size") - F.col("at")) >= 2 * percent * F.col("size")


def _with_centres(live: DataFrame, centres: int, percent: int = 0) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of each member with the centres of its key that are in other components, and the
    members that remain: a centre has then met all other members of its key. Where members have the place
    ``at`` of the key in the order of their set, pairs that have too little left behind it are left out:
    if they are similar, they have met under an earlier key."""
    is_centre = (F.col("spot") == F.col("least")) | (F.col("spot") < F.lit(float(centres)) / F.col("n"))
    live = live.withColumn("centre", is_centre)
    placed = [c for c in ("size", "at") if c in live.columns]
    them = live.where("centre").select(
        "key", F.col("node").alias("b"), F.col("group").alias("b_group"), *[F.col(c).alias(f"b_{c}") for c in placed]
    )
    apart = (F.col("group") != F.col("b_group")) & (~F.col("centre") | (F.col("node") < F.col("b")))
    if placed:
        left = F.least(F.col("size") - F.col("at"), F.col("b_size") - F.col("b_at"))
        apart = apart & ((100 + percent) * left >= percent * (F.col("size") + F.col("b_size")))
    pairs = live.join(them, "key").where(apart)
    return pairs.select(F.col("node").alias("a"), "b"), live.where("NOT centre")


def _one_centre_each(live: DataFrame) -> DataFrame:
    """Each member with the one centre of its keys that has the smallest spot."""
    them = live.where(F.col("spot") == F.col("least")).select("key", F.struct(F.col("least").alias("at"), F.col("node").alias("b"), F.col("group").alias("b_group")).alias("c"))
    best = live.join(them, "key").groupBy(F.col("node").alias("a"), "group").agg(F.min("c").alias("c"))
    return best.where(F.col("group") != F.col("c.b_group")).select("a", F.col("c.b").alias("b"))


def _rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``key, node, size, at``: of every set the shingles that are rarest among these sets, so many that two sets of
    the wanted similarity cannot do without a common one. Rarity is counted in buckets; any order of
    the shingles would be right, and all sets use the same."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(RARITY_BUCKETS, np.int64)
        for batch in batches:
            for value in batch["set"]:
                np.add.at(counts, _bucket(np.frombuffer(value.as_buffer(), np.uint64)), 1)
        for at in range(0, RARITY_BUCKETS, 1 << 16):
            part = counts[at : at + (1 << 16)]
            if part.any():
                row = [pa.array([at], pa.int64()), pa.array([np.minimum(part, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
        for block, counts in sums.items():
            row = [pa.array([block], pa.int64()), pa.array([np.minimum(counts, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["block", "counts"])

    kinds = "block long, counts binary"
    summed = sets.mapInArrow(count, kinds).repartition("block").mapInArrow(total, kinds)
    table = np.zeros(RARITY_BUCKETS, np.int32)
    for row in summed.toLocalIterator():  # RARITY_BUCKETS numbers, however many sets there are
        table[row["block"] : row["block"] + (1 << 16)] = np.frombuffer(row["counts"], np.int32)
    known = sets.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = known.value
        for batch in batches:
            keys = [np.zeros(0, np.uint64)]
            nodes, sizes, places = ([np.zeros(0, np.int64)] for _ in range(3))
            for node, value in zip(batch["node"].to_pylist(), batch["set"]):
                shingles = np.frombuffer(value.as_buffer(), np.uint64)
                n = len(shingles) - ceil(percent * len(shingles) / 100) + 1
                rare = np.lexsort((shingles, often[_bucket(shingles)]))[:n]
                keys.append(shingles[rare])
                nodes.append(np.full(len(rare), node))
                sizes.append(np.full(len(rare), len(shingles)))
                places.append(np.arange(len(rare)))
            columns = [np.concatenate(keys).view(np.int64), *map(np.concatenate, (nodes, sizes, places))]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "node", "size", "at"])

    return sets.mapInArrow(run, "key long, node long, size long, at long")


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & _U(RARITY_BUCKETS - 1)).astype(np.int64)


def _spot():
    """A place in [0, 1) that depends on the node only."""
    return F.pmod(F.xxhash64("node"), F.lit(1 << 40)) / float(1 << 40)


def linked(docs: DataFrame, nodes: DataFrame, percent: int, chunks: int) -> _Linking:
    """Link the nodes ``node, rep, d1, d2, n_shingles, sig``."""
    state = _Linking(docs, nodes, percent, chunks)
    keys = index_keys(nodes, chunks)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(keys.join(shared, "key").withColumn("spot", _spot()), "members")
    live = state.mixed(members)
    state.link(_one_centre_each(live), near=True)
    for _ in range(KEY_ROUNDS):
        live = state.mixed(live.select("key", "node", "spot"))
        if not live.limit(1).count():
            return state
        pairs, rest = _with_centres(live, 0)
        state.link(pairs, near=True)
        live = rest
    apart = state.mixed(live.select("key", "node", "spot")).select("node").distinct()
    apart = stored(apart.join(nodes, "node").drop("sig"), "apart")
    if not apart.limit(1).count():
        return state
    sets = shingle_sets(docs, apart)
    live = stored(_rare_shingles(sets, percent).withColumn("spot", _spot()), "rare")
    centres = 2
    while True:
        live = state.mixed(live.select("key", "node", "spot", "size", "at"))
        if not live.limit(1).count():
            return state
        pairs, live = _with_centres(live, centres, percent)
        state.link(pairs, near=False, sets=sets)
        centres *= GROWTH


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs(doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id that links reach, itself included; ``kept`` marks that
    document. Null and empty texts, and texts of white space, have an empty set and stand alone.
    Rows without doc_id have no component and are kept. Repeated rows of one doc_id are one
    document and each is returned; if their texts differ, each text is linked under that id, and all of the
    id's rows are one component. Other columns are not looked at. An empty table gives an empty result.
    """
    chunks = chunks_needed(percent / 100)
    with small_batches(docs.sparkSession):
        rows = stored(signatures(docs, chunks), "signatures")
        known = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        nodes = known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
        nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        groups = linked(docs, nodes, percent, chunks).groups
    named = nodes.join(groups, "node", "left").select(
        "d1", "d2", "n_shingles", "rep", F.coalesce("component", "node").alias("component")
    )
    placed = rows.join(named, ["d1", "d2", "n_shingles"], "left").select("doc_id", "n_shingles", "component")
    return _named(placed, named)


def _named(placed: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of ``placed(doc_id, n_shingles, component)`` under the smallest doc_id of their component.

    A doc_id that stands for several texts connects their components.
    """
    placed, named = stored(placed, "placed"), stored(named, "named")
    several = placed.where("component IS NOT NULL").groupBy("doc_id").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    several = stored(several.where("lo < hi").select("doc_id", "lo"), "several")
    if several.limit(1).count():
        joined = components(placed.join(several, "doc_id").select("component", "lo"), "component", "lo")
        joined = joined.withColumnRenamed("node", "was").withColumnRenamed("component", "now")
        placed, named = (
            stored(
                t.join(joined, F.col("component") == F.col("was"), "left")
                .withColumn("component", F.coalesce("now", "component"))
                .drop("was", "now"),
                "renamed",
            )
            for t in (placed, named)
        )
    # written, so that both sides of the join are plain shuffles and a large component can be split
    ids = stored(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component-ids")
    found = placed.join(ids, "component", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
