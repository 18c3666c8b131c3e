"""Operators 7, 8 and 9 against brute force."""

import hashlib
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from chanpulse.llm import fingerprint, mixing, sharding
from tests.llm.fixtures import LONG, empty, messy, messy_rows, row, SCHEMA, words_of


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_each_cell_once_by_unit_steps(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, [f"x{k}" for k in range(dims)])
    rows = df.withColumn("h", sharding.hilbert_index([F.col(f"x{k}") for k in range(dims)], bits)) \
        .orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(len(cells)))
    for a, b in itertools.pairwise(rows):
        assert sum(abs(x - y) for x, y in zip(a[:-1], b[:-1], strict=True)) == 1


def test_shards_have_equal_row_counts_and_gapless_slots(spark):
    got = sharding.op8(messy(spark)).collect()
    rows = messy_rows()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    counts = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(40)]
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    assert all(c == list(range(len(c))) for c in counts)
    # runs of the curve: shards follow each other on it
    ends = [[r["hilbert"] for r in got if r["shard"] == s] for s in range(40)]
    assert all(max(a) <= min(b) for a, b in itertools.pairwise(e for e in ends if e))


def test_shards_with_many_partitions_and_files(spark, tmp_dir):
    got = sharding.shard_rows(messy(spark), shards=7, rows_per_part=9).collect()
    assert sorted(r["rank"] for r in got) == list(range(len(messy_rows())))
    sharding.write_shards(messy(spark).drop("size", "rank"), tmp_dir, shards=3)
    assert spark.read.parquet(tmp_dir).count() == len(messy_rows())


def water_fill(sizes, weights, most):
    """Reshares the excess until none is above its bound."""
    stopped, total = {}, float(sum(sizes))
    while True:
        left = total - sum(stopped.values())
        share = sum(w for k, w in enumerate(weights) if k not in stopped)
        t = [stopped.get(k, left * w / share if share else 0.0) for k, w in enumerate(weights)]
        above = [k for k in range(len(sizes)) if k not in stopped and t[k] > most * sizes[k]]
        if not above:
            return t
        for k in above:
            stopped[k] = float(most * sizes[k])


def check_mix(docs_rows, got):
    by = {}
    for r in docs_rows:
        by.setdefault(r[3], []).append(len(words_of(r[1])))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(by[s]) for s in names]
    want = water_fill(sizes, [(5, 2, 1)[k % 3] for k in range(len(names))], 3)
    assert len(got) == len(docs_rows)
    rest = list(got)
    for name, size, goal in zip(names, sizes, want, strict=True):
        ids = {r[0] for r in docs_rows if r[3] == name}
        own = [r for r in rest if r["doc_id"] in ids and r["source_size"] == size
               and abs(r["target"] - goal) < 1e-6 * max(1, goal)]
        assert len(own) == len(by[name])
        assert sorted(r["size"] for r in own) == sorted(by[name])
        assert abs(sum(r["taken"] for r in own) - goal) <= 2
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)


def test_mix_meets_the_targets(spark):
    got = mixing.op9(messy(spark)).collect()
    check_mix(messy_rows(), got)
    again = mixing.op9(messy(spark).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_resharing_and_empty_sources(spark):
    rows = [row(k, "w " * 5, source="a") for k in range(3)]
    rows += [row(10 + k, "w " * 400, source="b") for k in range(9)]
    rows += [row(30, None, source="c"), row(31, "x " * 77, source="d")]
    rows += [row(40, "same words here", source=None)] * 3
    check_mix(rows, mixing.op9(spark.createDataFrame(rows, SCHEMA)).collect())


def test_mixed_documents_are_the_words_taken(spark):
    docs = messy(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    found = {}
    for r in out.collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + len(words_of(r["text"]))
        assert r["n_chars"] == len(r["text"]) and r["_key"] == "e"
    assert {k: v for k, v in taken.items() if v} == found


def next_of(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    return [(r, order[(k + 1) % len(order)]) for k, r in enumerate(order)]


@pytest.mark.parametrize("per_block", [3, 1000])
def test_edited_text_and_likeness(spark, per_block):
    got = fingerprint.with_edited(messy(spark), rows_per_block=per_block).collect()
    want = []
    for r, after in next_of([(x[0], x[1] or "") for x in messy_rows()]):
        n = len(r[1])
        want.append((str(r[0]), n, r[1][:n - n // 4] + after[1][:n // 4]))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_text"]) for r in got) == sorted(want)


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def rows_at_a_time(monkeypatch):
    """The largest group of each window over blocks that a run makes."""
    from pyspark.sql.classic.dataframe import DataFrame
    seen = []
    whole = DataFrame.repartition

    def spy(self, n, *cols):
        if cols == ("_at",):
            seen.append(max((r["count"] for r in self.groupBy("_at").count().collect()), default=0))
        return whole(self, n, *cols)
    monkeypatch.setattr(DataFrame, "repartition", spy)
    return seen


@pytest.mark.parametrize("ids", ["gap", "nulls", "one id", "one row"])
def test_blocks_hold_few_rows_whatever_the_ids(spark, monkeypatch, ids):
    """An outlying id, missing ids, one id for a third of the rows, one row for a third."""
    n, per_block = 1_200, 30
    make = {"gap": lambda k: (k if k < n - 1 else 10 ** 18, f"text {k * 7 % n}"),
            "nulls": lambda k: (None if k % 3 else k, f"text {k * 7 % n}"),
            "one id": lambda k: (5 if k % 3 == 0 else k, f"text {k * 7 % n}"),
            "one row": lambda k: (5, "always the same") if k % 3 == 0 else (k, f"text {k}")}[ids]
    rows = [make(k) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = rows_at_a_time(monkeypatch)
    got = fingerprint.with_next(docs, [], rows_per_block=per_block).collect()
    assert max(seen) < 5 * per_block
    assert sorted(map(str, rows)) == sorted(str((r["doc_id"], r["text"])) for r in got)
    if ids == "one id":  # of equal ids the order is that of the texts
        rows = sorted(rows)
    else:
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    follow = {}
    for a, b in zip(rows, [*rows[1:], rows[0]]):
        follow.setdefault(a, []).append(b[1])
    for r in got:
        follow[r["doc_id"], r["text"]].remove(r["next_text"])
    assert not any(follow.values())


def test_fingerprints_estimate_resemblance(spark):
    rows = fingerprint.op7(messy(spark)).collect()
    assert len(rows) == len(messy_rows())
    by_text, of = {}, {}
    for r in messy_rows():
        of.setdefault(r[0], r[1] or "")
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] is None:
            continue
        by_text.setdefault(of[r["doc_id"]], set()).add(r["fingerprint"])
        a = shingles(of[r["doc_id"]])
        if len(a) < fingerprint.K:
            assert r["est_shingles"] == len(a)
    assert all(len(v) == 1 for v in by_text.values())
    longest = next(r for r in rows if r["doc_id"] == 103)
    assert abs(longest["est_shingles"] / len(shingles(LONG)) - 1) < 0.5
    pairs = next_of([(x[0], x[1] or "") for x in messy_rows()])
    exact = {r[0]: len(shingles(r[1]) & shingles(a[1])) / max(1, len(shingles(r[1]) | shingles(a[1])))
             for r, a in pairs if r[0] is not None and r[0] != 108}
    for r in rows:
        if r["doc_id"] in exact and (of[r["doc_id"]].strip()):
            assert abs(r["near_next"] - exact[r["doc_id"]]) < 0.25


def test_sketches_merge(spark):
    df = spark.createDataFrame([("g", " ".join(f"a{k}" for k in range(300))),
                                ("g", " ".join(f"a{k}" for k in range(150, 500))), ("h", "")],
                               "g string, text string")
    one = fingerprint.add_sketch(df, "text", "sketch")
    merged = {r["g"]: r["sketch"] for r in
              fingerprint.merge_groups(one, ["g"], "sketch").collect()}
    both = sorted({h for r in fingerprint.add_sketch(df, "text", "sketch", k=10_000).collect()
                   for h in r["sketch"]})[:fingerprint.K]
    assert merged["g"] == both


def test_empty_tables(spark):
    assert sharding.op8(empty(spark)).count() == 0
    assert mixing.op9(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
    assert fingerprint.op7(empty(spark)).count() == 0


def test_edited_sha(spark):
    one = spark.createDataFrame([row(1, "abcdefgh"), row(2, "XY")], SCHEMA)
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprint.op7(one).collect()}
    assert got[1] == hashlib.sha256(b"abcdefXY").hexdigest()
    assert got[2] == hashlib.sha256(b"XY").hexdigest()
