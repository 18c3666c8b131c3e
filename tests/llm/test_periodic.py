"""Operator 13 against brute force."""

import hashlib
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from chanpulse.llm import periodic

from .fixtures import SCHEMA, empty, messy, row, words_of


def brute(words, least_words=24, least_periods=3):
    n, found = len(words), set()
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least_words, least_periods * q):
                found.add((i, j - i + q, q))
            i = j
    return sorted(r for r in found if not any(
        q < r[2] and s <= r[0] and s + n >= r[0] + r[1] for s, n, q in found))


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    a = (h // 10) % n
    p = 1 + (n - a) // (3 + (h // 10) % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, words_of(text))
    found = brute(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *four, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


PERIODIC = st.builds(lambda head, body, times, tail: head + (body * times) + tail,
                     st.lists(st.integers(0, 2), max_size=9),
                     st.lists(st.integers(0, 2), min_size=1, max_size=17), st.integers(1, 14),
                     st.lists(st.integers(0, 2), max_size=9))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PERIODIC, st.lists(st.integers(0, 1), max_size=90)), max_size=5))
def test_runs_of_few_words(docs):
    assert periodic.runs_of(docs) == [brute(d) for d in docs]
    assert periodic.runs_of(docs, least_words=4, least_periods=3) == [brute(d, 4) for d in docs]


def test_overlapping_runs():
    """Runs that share words, nested periods and exact bounds of length."""
    inner = ([1] * 30 + [2]) * 4
    assert periodic.runs_of([inner]) == [brute(inner)]
    assert len(periodic.runs_of([inner])[0]) == 5
    assert periodic.runs_of([[5] * 23, [5] * 24, list(range(8)) * 3, list(range(9)) * 2 + [0, 1]]) \
        == [[], [(0, 24, 1)], [(0, 24, 8)], []]


def test_query_on_odd_rows(spark):
    docs = messy(spark)
    got = sorted(map(tuple, periodic.op13(docs).collect()), key=str)
    assert got == sorted((expected(r["doc_id"], r["text"]) for r in docs.collect()), key=str)


def test_query_on_repeating_texts(spark):
    rows = [row(k, " ".join(f"w{(i * i) % (3 + k % 11)}" for i in range(k * 7 % 400)))
            for k in range(300)]
    rows += [row(1000 + k, "\t one two\nthree " * (5 + k)) for k in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, periodic.op13(docs).collect()))
    assert got == sorted(expected(r["doc_id"], r["text"]) for r in docs.collect())


def test_a_very_long_periodic_text():
    words = [f"w{k % 977}" for k in range(200_000)]
    assert periodic.runs_of([words, ["a"] * 100_000]) == [[(0, 200_000, 977)], [(0, 100_000, 1)]]


def test_runs_and_collapsed_columns(spark):
    docs = spark.createDataFrame([row(1, "x " + "a b " * 20 + "y"), row(2, None)], SCHEMA)
    got = docs.select(periodic.runs_column()("text").alias("r"),
                      periodic.collapsed_column()("text").alias("t")).collect()
    assert [[tuple(x) for x in r["r"]] for r in got] == [[(1, 40, 2)], []]
    assert [r["t"] for r in got] == ["x a b y", ""]


def test_empty_table(spark):
    assert periodic.op13(empty(spark)).collect() == []
