"""Operator 12 against the tokenizers library, and its coding by round trips."""

import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chanpulse.llm import tokenfile as T

from .fixtures import SCHEMA, empty, messy, row


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(T.default_path())


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(T.default_path())


IDS = st.integers(0, 64).flatmap(lambda bits: st.integers(0, (1 << bits) - 1 if bits else 0))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(IDS, max_size=200), max_size=6), st.sampled_from([1, 3, 64, 1024]))
def test_words_give_the_ids_back(docs, block):
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.array([x for d in docs for x in d], np.uint64)
    per_block, first = T.cut(sizes, block)
    assert per_block.sum() == len(ids) and (per_block <= block).all()
    words, counts, escapes = T.pack(ids, per_block)
    assert (escapes >= 1 << 60).all() and len(escapes) == (ids >= 1 << 60).sum()
    assert (T.unpack(words, np.cumsum(counts) - counts, per_block, escapes) == ids).all()


def test_greedy_packing():
    """A word takes as many ids as fit: 60 bits, 20 of three bits, one of 31."""
    ids = np.array([1] * 60 + [7] * 20 + [1 << 30], np.uint64)
    words, counts, _ = T.pack(ids, np.array([81]))
    assert [int(w) >> 60 for w in words] == [1, 3, 14] and counts.tolist() == [3]


def test_zeroed_words_are_noticed():
    with pytest.raises(ValueError):
        T.unpack(np.zeros(2, np.uint64), np.array([0]), np.array([5]), np.zeros(0, np.uint64))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("'stredlvm ab1²é ÀÉß\x85\xa0\x1c.!İſλ日😀́"),
                         st.characters(max_codepoint=255)), max_size=60))
def test_ids_are_the_library_s(library, encoder, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected


def test_every_code_point_of_latin_1(library, encoder):
    texts = [f"{a}{chr(c)}{b}" for c in range(256) for a, b in (("", ""), ("a", "b"), ("'", "s"))]
    texts += ["x<|endoftext|>y", "<|startoftext|>", "w" * 5_000]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == expected


def expected_rows(docs, library):
    rows = sorted(docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
                  .collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    out, at = [], 0
    for r in rows:
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def as_rows(df):
    return sorted([tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()],
                  key=lambda r: r[1])


@pytest.mark.parametrize("options", [{}, {"part_bytes": 500, "file_documents": 3, "block": 5},
                                     {"file_bytes": 8, "part_bytes": 4_000}])
def test_files_of_odd_rows(spark, library, options):
    docs = messy(spark)
    assert as_rows(T.read(T.write(docs, **options))) == expected_rows(docs, library)


def test_ids_come_back_whole(spark, library):
    docs = messy(spark)
    got = T.read(T.write(docs, end_id=None), with_ids=True).collect()
    expected = sorted((r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids)
                      for r in docs.filter("doc_id is not null").collect())
    assert sorted((r["doc_id"], r["ids"]) for r in got if r["doc_id"] is not None) == expected


def test_one_id_on_many_rows_fills_several_parts(spark, library):
    docs = spark.createDataFrame([row(7 if k % 3 else k, "the same words again and again")
                                  for k in range(600)], SCHEMA)
    index = T.write(docs, part_bytes=4_000)
    assert max(r["documents"] for r in index.collect()) < 200
    assert as_rows(T.read(index)) == expected_rows(docs, library)


def test_a_damaged_file_is_noticed(spark, tmp_dir):
    index = T.write(messy(spark), path=tmp_dir)
    file = index.first()["file"]
    fs, place = pafs.FileSystem.from_uri(file)
    with fs.open_input_file(place) as f:
        raw = bytearray(f.read())
    raw[len(T.MAGIC) + 3] ^= 1
    with fs.open_output_stream(place, compression=None) as f:
        f.write(bytes(raw))
    with pytest.raises(Exception, match="crc32"):
        T.read(index).collect()


def test_no_documents(spark):
    assert T.op12(empty(spark)).collect() == []
