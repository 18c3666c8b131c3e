"""Operator 10 against brute force, and the pipeline's stage."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chanpulse.llm import neardup
from chanpulse.llm.components import stars
from chanpulse.llm.textarrays import spans
from tests.llm.fixtures import SCHEMA, empty, messy, messy_rows, row, words_of

SF = "/root/testdata/sf0.01"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, w):
    ws = words_of(lower(text))
    return frozenset(tuple(ws[k:k + w]) for k in range(len(ws) - w + 1)) if len(ws) >= w \
        else frozenset([tuple(ws)] if ws else [])


def brute(rows, w):
    """(id, set size, smallest id of the component) of each row."""
    found = [shingles(t, w) for _, t in rows]
    own = list(range(len(rows)))

    def top(k):
        while own[k] != k:
            k = own[k]
        return k

    by = {}
    for k, s in enumerate(found):
        for x in s:
            by.setdefault(x, []).append(k)
    for k, s in enumerate(found):
        for j in {j for x in s for j in by[x] if j < k}:
            if top(j) != top(k) and 100 * len(s & found[j]) >= 80 * len(s | found[j]):
                own[top(k)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if found[k] and i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted((str(i), len(found[k]), str(least.get(top(k)) if found[k] else i))
                  for k, (i, _) in enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


@pytest.mark.parametrize("w,most", [(2, 2000), (2, 3), (5, 2000)])
def test_given_documents(spark, w, most):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(neardup.components(docs, w, most)) == brute(rows, w)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in messy_rows()]
    out = neardup.op10(messy(spark)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) \
        == brute(rows, 2)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    assert neardup.op10(empty(spark)).count() == 0


def chains(seed=1, groups=4, size=60):
    """Groups whose members drift apart, so that ends are linked only through the middle."""
    rng = random.Random(seed)
    out, k = [], 0
    for g in range(groups):
        words = [f"g{g}w{rng.randrange(500)}" for _ in range(80)]
        for _ in range(size):
            words = list(words)
            words[rng.randrange(80)] = f"x{rng.randrange(10_000)}"
            out.append((k, " ".join(words)))
            k += 1
    out += [(k + j, out[0][1]) for j in range(50)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("most", [7, 1000])
def test_chains_and_large_clusters(spark, most):
    """Parts much smaller than the clusters give the same components."""
    rows = chains()
    docs = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    assert got(neardup.components(docs, 2, most)) == brute(rows, 2)


def family(n, seed=3):
    """Texts of one template: about 0.64 alike, none of them linked."""
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(160)]
    return [(k, " ".join([*common, *[f"u{k}x{rng.randrange(10 ** 9)}" for _ in range(45)]]))
            for k in range(n)]


def test_a_template_family_makes_no_quadratic_pairs(spark, monkeypatch):
    """Twice the documents give at most about twice the pairs, and the same answer."""
    tested = []
    whole = neardup.confirmed

    def counted(pairs, sets):
        tested.append(pairs.count())
        return whole(pairs, sets)
    monkeypatch.setattr(neardup, "confirmed", counted)
    made = []
    for n in (200, 400):
        rows = family(n)
        rows += [(n + k, rows[k][1] + f" y{k}") for k in range(5)]  # linked to one of them
        docs = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
        del tested[:]
        assert got(neardup.components(docs, 2, 40)) == brute(rows, 2)
        made.append(sum(tested))
    assert 0 < made[0] and made[1] <= 2.5 * made[0], made


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    near = np.r_[base[:340], rng.integers(0, 1 << 62, 60).astype(np.uint64)]
    few = base[:3]
    element = np.concatenate([np.sort(base), np.sort(near), np.sort(few)])
    of = np.repeat([0, 1, 2], [400, 400, 3])
    s = neardup.signatures(element, of, 4, 240)
    assert np.isinf(s[3]).all() and np.isfinite(s[:3]).all()
    assert abs((s[0] == s[1]).mean() - 340 / 460) < 0.12
    # a set of three: each value is one of its elements' draws, all rounds were needed
    assert s[2].max() > 1 and (s[:3] < 240).all()
    alone = neardup.signatures(np.sort(near), np.zeros(400, np.int64), 1, 240)
    assert np.array_equal(alone[0], s[1])


def test_permutation_covers_each_component_once():
    one = neardup.signatures(np.array([12345], np.uint64), np.array([0]), 1, 64)
    assert sorted(np.floor(one[0]).astype(int).tolist()) == list(range(64))


def test_sets_are_those_of_the_definition():
    texts = ["A b a b", "a  B\ta\nb", "one", "", "é é é", "x y"]
    element, of = neardup.sets(*spans(pa.array(texts)), 2)
    sizes = np.bincount(of, minlength=len(texts)).tolist()
    assert sizes == [len(shingles(t, 2)) for t in texts]
    assert element[of == 0].tolist() == element[of == 1].tolist()


def test_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in stars(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_stage_keeps_one_document_of_each_group(spark):
    docs = messy(spark)
    out = neardup.deduplicated(docs)
    assert out.columns == docs.columns
    rows = [(r[0], r[1]) for r in messy_rows()]
    groups = {c for i, n, c in brute(rows, 5) if n}
    kept = [r for r in out.collect() if shingles(r["text"], 5)]
    assert len(kept) == len(groups)
    # documents without words are no copies of each other, unless row equals row
    assert {r["doc_id"] for r in out.collect()} >= {100, 101, 102, None}
    assert out.filter(F.col("doc_id") == 108).count() == 1


KEYS = ["none", "id", "th"]


def keyed(spark, ids):
    return spark.createDataFrame([(i is None, i or 0, (i or 0) % 1_000) for i in ids],
                                 "none boolean, id long, th long")


def test_the_bitmap_loses_no_wanted_row(spark):
    rows = keyed(spark, [None, None, *range(20_000), 5, -3, 1 << 62])
    wanted = keyed(spark, [None, *range(0, 20_000, 40), -3, 1 << 62])
    left = neardup.maybe_among(rows, wanted, KEYS)
    there = left.join(wanted, KEYS).count()
    assert there == rows.join(wanted, KEYS).count() == 504
    assert left.count() - there < 20_000 / 8  # 16 bits a key, one hash: about 6 %


def test_a_full_bitmap_keeps_all(spark):
    rows, wanted = keyed(spark, range(5_000)), keyed(spark, range(0, 200_000, 2))
    kept = neardup.maybe_among(rows, wanted, KEYS, most_bits=neardup.BITMAP_ROW)
    assert kept.join(wanted, KEYS).count() == 2_500
    assert neardup.maybe_among(rows, wanted.limit(0), KEYS).count() == 0


def test_the_bitmap_moves_no_row(spark):
    rows, wanted = keyed(spark, range(5_000)), keyed(spark, range(100))
    plan = neardup.maybe_among(rows, wanted, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
