"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import release, stored


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges from each node to the smallest it reaches within its partition.

    Connects the same nodes with at most one edge for each node and partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(node: int) -> int:
            while (up := above.setdefault(node, node)) != node:
                above[node] = node = above[up]
            return node

        for batch in batches:
            for a, b in zip(*(batch[c].to_pylist() for c in ("a", "b"))):
                a, b = top(a), top(b)
                above[max(a, b)] = min(a, b)
        rows = [(node, top(node)) for node in above]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows if r[0] != r[1]], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def _smallest(edges: DataFrame) -> DataFrame:
    """The smallest of each node ``a`` and its neighbours ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return stored(least.select("a", F.least("a", "m").alias("m")), "smallest")


def _tied(edges: DataFrame) -> bool:
    """Whether each node has one edge, to a node that has none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("b", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for all nodes of ``edges(a, b)``.

    Alternates large-star and small-star steps: each node's larger, then its
    smaller neighbours are tied to the smallest node around it, until each node is
    tied to the smallest of its component. A step joins edges with one row per node; both sides are shuffled, so
    a node with very many edges can be split. Edges from a node to itself count for
    nothing; no edges: no rows.
    """
    # Few edges meet in one partition the second time, and are done.
    edges = stored(_contracted(_contracted(edges).repartition("a")), "edges")
    while not _tied(edges):
        around = edges.unionAll(edges.select("b", "a"))
        least = _smallest(around)
        large = around.join(least, "a").where("b > a AND b <> m")
        # From the larger node to the smaller.
        large = stored(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        release(edges, least)
        own = large.groupBy("a").agg(F.min("b").alias("b"))
        least = _smallest(large)
        tied = large.join(least, "a").where("b <> m")
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(tied.unionAll(own).distinct(), "small-star")
        release(large, least)
    heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(heads)
