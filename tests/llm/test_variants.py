"""Operator 11 against brute force."""

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from chanpulse.llm import variants

from .fixtures import empty, messy, row, SCHEMA


def words_of_table(rows):
    count = Counter()
    for r in rows:
        for m in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def grouped(count):
    near = {w: [v for v in count if v != w and one_edit(v, w)] for w in count}
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda v: (-count[v], v.encode()), default=None)
        form[w] = best if best and count[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), count[form[w]] if form[w] else None)
            for w, n in count.items()}


def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in df.collect()}


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.text("aabé", min_size=1, max_size=6), st.integers(3, 40), max_size=40))
def test_words_of_few_letters(spark, counts):
    """Equal letters side by side, where several edits give the same word."""
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_dict(variants.grouped(words, words_per_part=7)) == grouped(counts)


def test_chain_of_forms(spark):
    """Each word's form is one letter away and twice as frequent; roots are followed to the end."""
    words = ["a" * k + "b" * (12 - k) for k in range(13)]
    counts = {w: 3 * 2 ** k for k, w in enumerate(words)}
    got = as_dict(variants.grouped(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == grouped(counts)
    assert {v[1] for v in got.values()} == {"a" * 12}


def test_ties_take_the_smaller_word(spark):
    counts = {"stein": 10, "stemn": 10, "steen": 4, "stern": 3}
    got = as_dict(variants.grouped(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == grouped(counts)
    assert got["steen"][0] == "stein"


def test_whole_query_on_odd_rows(spark):
    docs = messy(spark)
    assert as_dict(variants.op11(docs)) == grouped(words_of_table(docs.collect()))


def test_edited_occurrences_make_variants(spark):
    """Frequent words in many documents: one occurrence in 97 loses a character."""
    rows = [row(k, f"Straße {'Garten ' * (k % 3)}naïveté gardens garden") for k in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = as_dict(variants.op11(docs))
    assert got == grouped(words_of_table(docs.collect()))
    assert any(v[0] == "straße" for v in got.values())


def test_a_group_holds_one_word_a_letter(spark):
    """What a scan writes grows with the words, not with the pairs of a prefix's group."""
    letters = [chr(c) for c in (*range(97, 123), *range(0xE0, 0x100))]
    words = spark.createDataFrame([(f"cab{c}ra", 5) for c in letters], "word string, n long")
    rows = variants.scanned(variants.rotations(words), 3)
    assert rows.filter("near > 1").count() == len(letters)
    assert {v[3] for v in as_dict(variants.grouped(words)).values()} == {len(letters) - 1}


def test_empty_table(spark):
    assert variants.op11(empty(spark)).collect() == []
