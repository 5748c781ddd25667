"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


#: so many edges, counted first, are few enough for one task; more are contracted by joins
ONE_TASK_EDGES = 1 << 18


def _in_one_task(edges: DataFrame) -> DataFrame:
    """``node, component`` of a counted few edges, by union-find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(x, x)) != top and x != top:
                parent[x], x = top, up
            return top

        for batch in batches:
            for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        names = [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())]
        yield pa.RecordBatch.from_arrays(names, ["node", "component"])

    return edges.coalesce(1).mapInArrow(run, "node long, component long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join has plain shuffles on both sides and the node of many edges can be split
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return (
        both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    hung = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    roots = edges.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    under = edges.select(F.col("u").alias("v")).distinct()
    wrong = roots.where("n > 1").select("v").union(roots.join(under, "v", "left_semi").select("v"))
    return wrong.limit(1).count() == 0


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``(node, component)`` for every node but the smallest of each component, which is its name.

    ``links`` may hold repeats, loops and both directions. Few edges are joined in one task. Each further step is two aggregations and two
    joins on written tables; the number of steps grows with the logarithm of the longest path.
    """
    edges = stored(
        links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .where("u != v")
        .distinct(),
        "edges",
    )
    if edges.count() <= ONE_TASK_EDGES:
        return stored(_in_one_task(edges), "components")
    while not _all_stars(edges):
        edges = stored(_small_star(_large_star(edges)).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
