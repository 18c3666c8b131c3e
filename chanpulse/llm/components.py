"""Connected components of a graph of links, by large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanpulse.llm.common import map_in_arrow, materialise

#: Links that a task contracts at once.
CHUNK = 1_000_000


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and roots of the links (a, b): each node with the smallest it reaches here."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        # a link pulls the roots of both ends, not only the ends
        for end in (root[x], root[y], x, y):
            np.minimum.at(new, end, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def contracted(links: DataFrame) -> DataFrame:
    """The same components with fewer links: every task contracts its own, CHUNK at a time."""
    def run(batches):
        held, n = [], 0

        def close():
            a, b = contract(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
            if n >= CHUNK:
                yield close()
                held, n = [], 0
        if n:
            yield close()

    return map_in_arrow(links.select("a", "b"), run, "a long, b long")


def stars(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), both long; root is the smallest node.

    Links point from a larger node to a smaller one.  A round ties a node's larger
    neighbours to the smallest one (large star: the smallest neighbour replaces the
    link's end), then its smaller neighbours and itself (small star), until nothing
    changes; the number of rounds grows with the logarithm of the number of nodes.
    The smallest neighbour is an aggregate that is partial before the shuffle.  Before
    the first round every task contracts the links that it holds.  Links are written to
    the shared checkpoint folder after each round.
    """
    spark = links.sparkSession
    some = links.filter(F.col("a") != F.col("b")).select("a", "b")
    edges = materialise(spark, contracted(materialise(spark, some, "links")), "links")
    mark = None
    while True:
        least = edges.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "of")
        large = edges.join(least, F.col("b") == F.col("of"), "left").select(
            "a", F.coalesce("least", "b").alias("b"))
        large = large.repartition("a")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = materialise(spark, small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
