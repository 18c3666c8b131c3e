"""Approximate nearest neighbours by a permutation index.

A bounded sample of the vectors are pivots (PIVOTS).  A vector is represented by its ORDER
nearest pivots, in order of their inner product with it, and posted in the inverted file of each
of them with its place there.  A query reads the files of its own pivots and adds up, for each
posted point, what their two orders have in common: the footrule distance of two orders (a
pivot outside a list counts as at its end) is a constant less twice the sum over pivots of the
smaller of the two heights, where a pivot's height is how far it stands before the end of the
list.  An order tells a direction and no length, so the sum is multiplied by the point's
length: that ranks by what the inner product is likely to be.  The points that rank first,
``reranked`` of them, FACTOR * points ** GROWTH in all, are compared by the exact inner product
in double precision.

The index is cut by points: a block of about BLOCK points, dealt by a hash, holds the inverted
files of its own points, and each block of queries (QUERIES) visits each block of points, in a
group of its own.  A block is a random part of all points, so each gives its share of the
points that rank first.  What moves is an order of 64 bytes and a vector for each point
and block of queries.  The number of pivots doesn't depend on the input: the share of the
points that has to be reranked for the same recall falls as points grow (README).

Equal vectors are one point.  As ties go to the smaller id, a point never gives a
result more than its TOP + 1 smallest ids, so these stand for its copies; every
query id of a point gets that point's result.  A vector that is repeated very often
thus makes neither long files nor many queries.

Recall against brute force on the given tables, and on unit, clustered and unequally long
vectors: see the README and the tests.

Edge cases: vectors that are null, zero, of another length than most, or that hold
null or non-finite components take no part, nor do rows without an id; repeated
rows count once; fewer candidates than TOP are all returned; an empty table gives no row.
Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import map_in_arrow, materialise, parts_for

TOP = 20
PIVOTS, ORDER = 256, 64
#: How many points are reranked for a query: FACTOR * points ** GROWTH, and LEAST in a block.
FACTOR, GROWTH, LEAST = 2.0, 0.75, 256
BLOCK, QUERIES = 8_192, 32_768


def reranked(points: int) -> int:
    return min(points, math.ceil(FACTOR * points ** GROWTH))


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def rows_of(column, kind, width: int) -> np.ndarray:
    """A column of packed rows as a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(values.to_pylist()), kind).reshape(-1, width)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    near = x @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :length].astype(np.uint8)


class Files:
    """Inverted files of a block of points: for each pivot the points that have it in their
    order, and its height there."""

    def __init__(self, order: np.ndarray, pivots: int):
        n, self.length = order.shape
        by_pivot = np.argsort(order.ravel(), kind="stable")
        self.starts = np.searchsorted(order.ravel()[by_pivot], np.arange(pivots + 1))
        self.point = by_pivot // self.length
        self.height = self.length - by_pivot % self.length
        self.n = n

    def common(self, order: np.ndarray) -> np.ndarray:
        """For each point the sum over pivots of the smaller height, in its and in ``order``."""
        parts = [slice(self.starts[p], self.starts[p + 1]) for p in order.astype(np.int64)]
        points = np.concatenate([self.point[s] for s in parts])
        least = np.concatenate([np.minimum(self.height[s], self.length - k)
                                for k, s in enumerate(parts)])
        return np.bincount(points, weights=least, minlength=self.n)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        return self.length * (self.length + 1) - 2 * self.common(order)


def search_block(q: np.ndarray, q_order: np.ndarray, x: np.ndarray, order: np.ndarray,
                 pivots: int, top: int, keep: int) -> list[np.ndarray]:
    """For each query of a block the best points of a block, of the ``keep`` that rank first."""
    files, lengths, out = Files(order, pivots), np.linalg.norm(x, axis=1), []
    for k in range(len(q)):
        found = np.arange(len(x))
        if len(x) > keep:
            rank = files.common(q_order[k]) * lengths
            found = np.argpartition(-rank, keep - 1)[:keep]
        score = x[found] @ q[k]
        if len(found) > top:
            edge = np.partition(score, len(score) - top)[len(score) - top]
            # products are summed in another order here: what is as near stays
            found = found[score >= edge - 1e-9 * max(1.0, abs(edge))]
        out.append(found)
    return out


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, summed in the same order for each pair."""
    return np.array([float(np.dot(row, q)) for row in x])


def search(embeddings: DataFrame, wanted: Column, top: int = TOP, pivots: int = PIVOTS,
           length: int = ORDER, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that ``wanted`` (on vec_id) picks.
    ``pivots``: at most 256."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), "d").first()
    dims = sizes["d"] if sizes else 1
    rows = rows.filter(F.size("v") == dims).select(
        "vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    points = materialise(spark, rows.groupBy("h1", "h2").agg(F.min("v").alias("v"))
                         .withColumn("point", F.monotonically_increasing_id()), "ann-points")
    n = points.count()
    # the sample: the points of the smallest hashes (at most 256 vectors)
    sample = np.array([r["v"] for r in points.orderBy("h1", "h2").limit(pivots).collect()],
                      np.float64).reshape(-1, dims)
    sample /= np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    width, m = len(sample), min(length, len(sample))
    narrow_type = embeddings.schema["embedding"].dataType.elementType.simpleString() == "float"
    kind = np.float32 if narrow_type else np.float64  # as the table has them

    def represent(batches):
        for batch in batches:
            x = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False),
                         np.float64).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()),
                 pa.array([r.tobytes() for r in nearest_pivots(x, sample, m)], pa.binary())],
                ["point", "x", "ord"])

    index = materialise(spark, map_in_arrow(
        points.select("point", "v"), represent, "point long, x binary, ord binary"), "ann-index")
    small = Window.partitionBy("h1", "h2").orderBy("vec_id")
    narrow = rows.select("vec_id", "h1", "h2").distinct()
    ids = narrow.withColumn("nth", F.row_number().over(small)).filter(F.col("nth") <= top + 1)
    ids = materialise(spark, ids.join(points.select("h1", "h2", "point"), ["h1", "h2"])
                      .select("point", "vec_id", (F.col("nth") == 1).alias("least")), "ann-ids")
    asked = materialise(spark, narrow.filter(wanted).join(
        points.select("h1", "h2", "point"), ["h1", "h2"])
        .select("point", F.col("vec_id").alias("query_id")), "ann-queries")
    asking = asked.select("point").distinct()
    pb, qb = parts_for(n, block), parts_for(asking.count(), queries)
    keep = max(LEAST, math.ceil(1.1 * reranked(n) / pb))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        # aliases: both sides come from the index, and their columns must differ
        return (df.select(*[F.col(c).alias(c) for c in ("point", "x", "ord")])
                .withColumn(own, F.pmod(F.xxhash64("point"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    files = dealt(index, "pb", pb, "qb", qb).groupBy("pb", "qb")
    asks = dealt(index.join(asking, "point", "left_semi"), "qb", qb, "pb", pb).groupBy("pb", "qb")

    def visit(keys, q: pa.Table, x: pa.Table) -> pa.Table:
        found = ([], [], [])
        if q.num_rows and x.num_rows:
            names = (q["point"].to_numpy(), x["point"].to_numpy())
            xs, qs = (rows_of(t["x"], kind, dims).astype(np.float64) for t in (x, q))
            orders = [rows_of(t["ord"], np.uint8, m) for t in (q, x)]
            for k, at in enumerate(search_block(qs, orders[0], xs, orders[1], width, top + 1, keep)):
                found[0].append(np.full(len(at), names[0][k]))
                found[1].append(names[1][at])
                found[2].append(exact_scores(xs[at], qs[k]))
        none = np.zeros(0, np.int64)
        return pa.table({"query": pa.array(np.concatenate([none, *found[0]]), pa.int64()),
                         "point": pa.array(np.concatenate([none, *found[1]]), pa.int64()),
                         "score": pa.array(np.concatenate([none.astype(float), *found[2]]),
                                           pa.float64())})

    seen = asks.cogroup(files).applyInArrow(visit, "query long, point long, score double")
    # a query point's best points: the smaller least id first where scores are equal
    least = ids.filter("least").select("point", F.col("vec_id").alias("first"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    seen = seen.join(least, "point").withColumn("place", F.row_number().over(best)) \
        .filter(F.col("place") <= top + 1)
    each = seen.join(ids.select("point", "vec_id"), "point").withColumn(
        "place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))) \
        .filter(F.col("place") <= top + 1).select("query", "vec_id", "score")
    answer = asked.join(each, F.col("point") == F.col("query")) \
        .filter(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answer.select("query_id", "vec_id", "score").distinct() \
        .withColumn("rank", rank).filter(F.col("rank") <= top) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 20 == 0)
