"""Operator 1: recall against brute force, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanpulse.llm import ann
from chanpulse.llm.common import parts_for


def brute(rows, ids, top=20):
    """Nearest of each query, ties to the smaller id."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None
                   and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v)
                   and any(v)})
    out = {}
    for q, x in good:
        if q in ids:
            scored = sorted((-float(np.dot(np.array(x), np.array(v))), i) for i, v in good if i != q)
            out[q] = scored[:top]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows],
                                 "vec_id long, embedding array<double>, score int, rank double")


def check(spark, rows, least):
    ids = {i for i, _ in rows if i is not None and i % 20 == 0}
    want = brute(rows, ids)
    got = {}
    for r in ann.op1(frame(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) <= set(want)
    recall = []
    for q, best in want.items():
        found = got.get(q, [])
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert q not in {i for _, i, _ in found}
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        recall.append(len({i for _, i, _ in found} & {i for _, i in best}) / max(1, len(best)))
    assert np.mean(recall) >= least
    return got


def test_recall_on_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    got = {}
    for r in ann.op1(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        recall.append(len(got[q] & set(ids[np.lexsort((ids, -s))[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.95


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(1, 150)]
    same = [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    rows += [(1000 + i, same) for i in range(120)]  # a third of all
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [1.0]),
             (2080, [float("nan")] * 8), (2100, [float("inf")] * 8), (None, [1.0] * 8),
             (2120, [-0.0] * 7 + [3.0]), (2120, [-0.0] * 7 + [3.0]), (2140, [])]
    got = check(spark, rows, 0.98)
    assert [i for _, i, _ in got[1100][:19]] == list(range(1000, 1019))
    assert len(got[1100]) == 20 and {2000, 2020, 2040, 2060, 2080, 2100, 2140}.isdisjoint(got)


def test_few_vectors(spark):
    check(spark, [(20, [1.0] * 8), (3, [2.0] * 8), (4, [2.0] * 8)], 1.0)
    check(spark, [(20, [1.0] * 8)], 0.0)
    assert ann.op1(frame(spark, [(20, [1.0] * 8)]).limit(0)).count() == 0
    assert ann.op1(frame(spark, [(20, None)])).count() == 0


def test_blocks_don_t_change_the_result(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    df = frame(spark, rows)
    one = sorted(map(tuple, ann.search(df, F.col("vec_id") % 20 == 0).collect()))
    cut = ann.search(df, F.col("vec_id") % 20 == 0, block=40, queries=5)
    assert sorted(map(tuple, cut.collect())) == one


def test_footrule_from_the_files():
    """The sum over shared pivots gives the footrule distance of the two orders."""
    rng = np.random.default_rng(2)
    orders = np.array([rng.permutation(12)[:5] for _ in range(40)], np.uint8)
    files = ann.Files(orders, 12)
    for own in orders[:10]:
        def place(order, p):
            return order.tolist().index(p) if p in order else 5
        want = [sum(abs(place(o, p) - place(own, p)) for p in range(12)) for o in orders]
        assert files.footrule(own).tolist() == want


def vectors(kind, n, rng):
    x = rng.standard_normal((n, 64), dtype=np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "clustered":
        c = rng.standard_normal((200, 64), dtype=np.float32)
        c /= np.linalg.norm(c, axis=1, keepdims=True)
        x = c[rng.integers(0, 200, n)] + 0.5 * x
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    elif kind != "unit":
        x *= np.exp(rng.normal(0, float(kind), (n, 1))).astype(np.float32)
    return x


@pytest.mark.parametrize("n", [40_000, 1_000_000])
@pytest.mark.parametrize("kind", ["unit", "clustered", "0.5", "1"])
def test_recall_by_kind_and_number(kind, n):
    """Of the best 20, and how few points are compared: blocks as the query cuts them."""
    rng = np.random.default_rng(5)
    x = vectors(kind, n, rng)
    pivots = x[:ann.PIVOTS] / np.linalg.norm(x[:ann.PIVOTS], axis=1, keepdims=True)
    asked = rng.choice(n, 12, replace=False)
    blocks = parts_for(n, ann.BLOCK)
    keep = max(ann.LEAST, int(np.ceil(1.1 * ann.reranked(n) / blocks)))
    assert keep * blocks < n * (0.2 if n < 100_000 else 0.08)
    found = [[] for _ in asked]
    for part in np.array_split(np.arange(n), blocks):
        order = ann.nearest_pivots(x[part], pivots, ann.ORDER)
        own = ann.nearest_pivots(x[asked], pivots, ann.ORDER)
        for k, at in enumerate(ann.search_block(x[asked], own, x[part], order, ann.PIVOTS, 21, keep)):
            found[k] += part[at].tolist()
    recall = []
    for q, near in zip(asked, found, strict=True):
        best = set(np.argpartition(-(x @ x[q]), 20)[:21].tolist()) - {q}
        recall.append(len(best & set(near)) / len(best))
    assert np.mean(recall) >= 0.95
