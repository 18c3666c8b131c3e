"""Operator 2 against the tokenizers library."""

import hashlib
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chanpulse.llm import bpe
from tests.llm.fixtures import empty, messy, messy_rows

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(PATH)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_random_texts(texts):
    e, t = bpe.encoder(PATH), LIBRARY
    for x, y in zip(e.encode(texts), t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(x) == y.ids
        assert e.decode(y.ids) == t.decode(y.ids, skip_special_tokens=False)


LIBRARY = Tokenizer.from_file(PATH)


def test_prose_spaces_marks_and_added_tokens(encoder, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aeiou st'd\n\t\xa0 <|endoftext|>日é1½") for _ in range(rng.randint(0, 90)))
             for _ in range(3000)]
    texts += ["a<|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext", " " * 300, "=" * 5000,
              "ab" * 3000, "x" * 20_000]
    got = encoder.encode(texts)
    assert [ids(x) for x in got] == [y.ids for y in library.encode_batch(texts, add_special_tokens=False)]


def test_speculation_is_verified(encoder):
    """Words that pass are as exact merging has them; some must fail, or nothing is tested."""
    rng = random.Random(5)
    words = ["".join(rng.choice("thenigrasd ") for _ in range(rng.randint(1, 14))).encode()
             for _ in range(5000)]
    found, failed = encoder.vocab.encode_words(words)
    assert 0 < failed < len(words)
    assert found == [encoder.vocab.merge(w) for w in words]


def test_query_and_columns_on_odd_rows(spark, library):
    got = {}
    for r in bpe.op2(messy(spark)).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    want = {}
    for r in messy_rows():
        text = r[1] or ""
        found = library.encode(text, add_special_tokens=False).ids
        back = library.decode(found, skip_special_tokens=False)
        want.setdefault(r[0], []).append((
            len(found), hashlib.sha256(struct.pack(f"<{len(found)}I", *found)).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_round_trip_columns(spark):
    docs = messy(spark).select("text")
    out = docs.withColumn("ids", bpe.encode_column(PATH)(F.col("text"))) \
        .withColumn("back", bpe.decode_column(PATH)(F.col("ids")))
    assert out.filter(F.coalesce("text", F.lit("")) != F.col("back")).count() == 0
    assert bpe.op2(empty(spark)).count() == 0
