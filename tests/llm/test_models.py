"""Operators 3, 5 and 6: learnt models, on held-out rows and odd cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chanpulse.llm import langid, quality, toxicity
from chanpulse.llm.common import held_out
from chanpulse.llm.textarrays import spans
from tests.llm.fixtures import SCHEMA, empty, messy, messy_rows, row

SF = "/root/testdata/sf0.01"


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def auc(y, s):
    y, s = np.array(y), np.array(s)
    a, b = s[y == 1], s[y == 0]
    return ((a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean())


# ---- language

def test_language_of_held_out_documents(spark):
    got = langid.op3(docs(spark)).join(docs(spark).select("doc_id", "lang"), "doc_id") \
        .filter("held_out").collect()
    assert len(got) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_grams_against_brute_force():
    text = "Abc, déf-ghi 123 x"
    words = ["abc", "déf", "ghi", "x"]
    have = langid.gram_counts([text, "", "zz"])
    flat = " ".join(words) + " "
    grams = [g for n in (1, 2, 3) for k in range(len(flat) - n + 1)
             for g in [flat[k:k + n]] if n > 1 or g != " "]
    assert have[0].sum() == len(grams) and have[1].sum() == 0
    assert (langid.gram_counts(["abc def"]) == langid.gram_counts(["ABC... def!"])).mean() > 0.99


def test_language_odd_rows(spark):
    got = {}
    for r in langid.op3(messy(spark)).collect():
        got.setdefault(r["doc_id"], r)
    assert len(got) == len({r[0] for r in messy_rows()})
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == got[102]["lang_pred"] == "und"
    assert got[100]["score"] == 0 and got[100]["rejected"]
    assert got[103]["lang_pred"] in ("en", "de", "fr") and not got[103]["rejected"]
    assert langid.op3(empty(spark)).count() == 0
    none = spark.createDataFrame([row(1, "some words", None)], SCHEMA)
    assert [r["lang_pred"] for r in langid.op3(none).collect()] == ["und"]


def test_several_centroids_per_language(spark):
    model = langid.fit(docs(spark), F.lit(True))
    assert len(model.langs) > len(set(model.langs)) == 4
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-3)
    again = langid.fit(docs(spark).repartition(7), F.lit(True))
    assert model.langs == again.langs and np.allclose(model.centroids, again.centroids, atol=1e-4)


def test_language_stage_keeps_clean_documents(spark):
    out = langid.accepted(docs(spark))
    assert out.columns == docs(spark).columns and out.count() >= 0.99 * docs(spark).count()
    odd = langid.accepted(messy(spark))
    assert odd.columns == messy(spark).columns
    assert {100, 101, 102}.isdisjoint({r["doc_id"] for r in odd.collect()})


def test_unlearnt_scripts_and_noise_are_rejected(spark):
    model, rng = langid.fit(docs(spark), ~held_out()), random.Random(6)
    for first, last in ((0x430, 0x44f), (0x3b1, 0x3c9), (0x5d0, 0x5ea), (0x4e00, 0x9fa0), (97, 122)):
        for n in (40, 200, 2000):
            noise = [" ".join("".join(chr(rng.randint(first, last)) for _ in range(rng.randint(2, 9)))
                              for _ in range(n)) for _ in range(20)]
            assert np.mean(model.predict(noise)[2]) >= 0.95, (first, n)
    held = [r["text"] for r in docs(spark).filter(held_out()).collect()]
    for n in (3, 10, 40, 10 ** 6):
        clean = [" ".join(t.split()[:n]) for t in held]
        assert np.mean(model.predict(clean)[2]) <= 0.02, n


def test_least_cosines_by_length():
    group, near = np.repeat([3, 5, 7, 9], [50, 2, 50, 50]), np.repeat([0.2, 0.0, 0.6, 0.5], [50, 2, 50, 50])
    least = langid.least_cosines(group, near) / langid.SLACK
    assert np.allclose(least[:10], [0, 0, 0, 0.2, 0.2, 0.2, 0.2, 0.5, 0.5, 0.5]) and least[39] == least[9]


# ---- quality

def test_quality_against_labels(spark):
    rows = quality.op5(docs(spark)).join(labels(spark), "doc_id").collect()
    assert auc([r["quality"] for r in rows], [r["score"] for r in rows]) > 0.97
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.95
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert np.mean(good) > 0.98


def test_expectation_maximisation_finds_the_rates():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    right_bad = np.array([0.3, 0.5, 0.2, 0.4, 0.6])
    v = np.ones((len(good), 5), np.int8)
    v[(rng.random(v.shape) < np.where(good[:, None], 0.0005, right_bad))] = 0
    v[rng.random(v.shape) < 0.1] = -1
    pats, inverse, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    found = quality.estimate(pats, counts.astype(float))
    assert abs(found.good - 0.8) < 0.05
    assert np.abs(found.on_bad - right_bad).max() < 0.08
    sure = ~((v == 0).sum(1) == 0)
    assert np.mean((found.posterior(v)[sure] < 0.5) == ~good[sure]) > 0.97


def test_measures_of_known_texts():
    texts = ["Plain words stand here. And more of them.", "A!! B!! C!!", "x | y | z", "",
             "same same same same same same same same same same same same same same"]
    m = quality.measures(*spans(pa.array(texts)))
    assert m["words"].tolist() == [8, 3, 5, 0, 14]
    assert m["shouting"][1] == 2 and m["bars"][2] == 0.4 and m["stutter"][4] > 0.9
    assert m["repeats"][4] > 0.9 and m["repeats"][0] == 0
    assert 0 in quality.votes(m)[4] and 0 not in quality.votes(m)[0]


def test_quality_odd_rows_and_stage(spark):
    got = {}
    for r in quality.op5(messy(spark)).collect():
        got.setdefault(r["doc_id"], r)
    for k in (100, 101, 102):
        assert got[k]["score"] == 0 and got[k]["predicted"] == 0
    assert quality.op5(empty(spark)).count() == 0
    out = quality.accepted(docs(spark))
    assert out.columns == docs(spark).columns
    kept = {r["doc_id"] for r in out.collect()}
    marked = labels(spark).collect()
    assert np.mean([r["doc_id"] in kept for r in marked if r["quality"] == 1]) > 0.98
    assert np.mean([r["doc_id"] in kept for r in marked if r["quality"] == 0]) < 0.2


# ---- toxicity

def test_folding():
    assert toxicity.fold("IDI0T").split() == toxicity.fold("idiot").split()
    assert toxicity.fold("mоrоn l0ser").split() == toxicity.fold("moron loser").split()
    assert toxicity.fold("st​upid $tupid").split() == ["stupid", "stupid"]
    assert toxicity.fold("thoner$$$ the&&&").split() == ["thoner", "the"]
    assert toxicity.fold("ｉｄｉｏｔ").split() == ["idiot"]


def test_matching_weights_and_exceptions():
    lex = toxicity.Lexicon({" bad ": 2.0, " awfu": 1.0}, ("not bad at",))
    hits = lambda t: sorted(lex.hits(toxicity.fold(t)).values())
    assert hits("bad and awfully bad bad") == [1.0, 2.0, 2.0, 2.0]
    assert hits("it's not bad at all, but bad") == [2.0]
    assert hits("badly made") == [] and lex.measures("") == (0.0, 0.0, 0.0)
    long, short = lex.measures("bad " + "word " * 99), lex.measures("bad word")
    assert long[0] < short[0]


def made(n=600, seed=4):
    """Clean texts, and toxic ones with some of a dozen words; both share a phrase."""
    rng = random.Random(seed)
    plain = [f"w{k}ord" for k in range(400)]
    rude = [f"grr{c}ab" for c in "abcdefghijkl"]
    out, marks = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        bad = k % 5 == 0
        if bad:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(rude)
        elif k % 31 == 0:
            words[3:3] = ["very", "grraab", "indeed"]
        out.append(row(k, " ".join(words)))
        marks.append((k, 1, int(bad)))
    return out, marks


def test_lexicon_is_learnt(spark):
    rows, marks = made()
    d = spark.createDataFrame(rows, SCHEMA)
    m = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    lex = toxicity.fit(d, m, F.lit(True))
    assert sum(w.strip().startswith("grr") for w in lex.weights) >= 10
    assert any("very grraab" in e for e in lex.exceptions)
    got = {r["doc_id"]: r for r in toxicity.op6(d, m).collect()}
    held = [(t, got[k]) for k, _, t in marks if got[k]["held_out"]]
    assert auc([t for t, _ in held], [r["score"] for _, r in held]) > 0.98
    assert np.mean([t == r["predicted"] for t, r in held]) > 0.95


def test_toxicity_on_given_tables(spark):
    rows = toxicity.op6(docs(spark), labels(spark)).join(labels(spark), "doc_id") \
        .join(docs(spark).select("doc_id", "lang"), "doc_id").filter("held_out and lang = 'en'").collect()
    assert auc([r["toxic"] for r in rows], [r["score"] for r in rows]) > 0.9


def test_toxicity_odd_rows(spark):
    m = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 0, 0), (None, 1, 1), (3, 1, None), (100, 0, 0),
                               (101, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.op6(messy(spark), m).collect()
    assert len(got) == len(messy_rows()) and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.op6(messy(spark), none).collect()
    assert len(got) == len(messy_rows()) and not any(r["predicted"] for r in got)
    assert toxicity.op6(empty(spark), m).count() == 0
    given = toxicity.fit(messy(spark), none, F.lit(True), given={"fox": 2.0})
    assert given.score(["fox fox", "hen"]).tolist()[0] > 0.5 > given.score(["hen"])[0]


@pytest.mark.parametrize("module", [langid, quality])
def test_long_text_counts_to_its_end(spark, module):
    """Whole texts are read: what stands at the end changes the result."""
    head = "plain words of prose stand here. " * 3000
    if module is langid:
        a, b = langid.gram_counts([head, head + "zzzqqq"])
    else:
        a, b = (quality.measures(*spans(pa.array([t])))["words"] for t in (head, head + " tail"))
    assert not np.array_equal(a, b)
