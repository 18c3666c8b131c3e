"""Bounded samples of the learnt operators, ties, and their scores against plain loops."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chanpulse.llm import langid, quality, sharding, toxicity
from chanpulse.llm.textarrays import mix64, spans
from tests.llm.fixtures import SCHEMA, row

SF = "/root/testdata/sf0.01"


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def copied(spark, copies=50_000):
    """The given documents and one text copied very often, in a language of its own."""
    text = "zwo kleine Hasen hoppeln munter durch den tiefen dunklen Wald und fressen Klee. " * 3
    many = spark.range(copies).select(
        (F.col("id") + 1_000_000).alias("doc_id"), F.lit(text).alias("text"),
        F.lit("xx").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("int").alias("n_chars"))
    given = docs(spark)
    return given.unionByName(many.select(*[F.col(f.name).cast(f.dataType) for f in given.schema.fields])), text


def test_a_copied_text_is_one_of_the_language_sample(spark, monkeypatch):
    """No language gives more than per_lang texts, and a much copied one is still learnt."""
    sizes = []
    whole = langid.materialise

    def spy(spark, df, name):
        out = whole(spark, df, name)
        if name == "lang-sample":
            sizes.extend(r["n"] for r in out.filter("head = 0").groupBy("lang")
                         .agg(F.count("*").alias("n")).collect())
        return out
    monkeypatch.setattr(langid, "materialise", spy)
    d, text = copied(spark)
    model = langid.fit(d, F.lit(True), per_lang=60)
    assert max(sizes) <= 60 and min(sizes) == 1 and len(sizes) == 5
    assert model.predict([text])[0] == ["xx"]


def test_a_copied_text_is_one_of_the_quality_sample(spark, monkeypatch):
    rows = []
    whole = quality.logistic

    def spy(x, y, weight, *a, **kw):
        rows.append(len(x))
        assert len({r.tobytes() for r in x}) > 0.9 * len(x)
        return whole(x, y, weight, *a, **kw)
    monkeypatch.setattr(quality, "logistic", spy)
    d, _ = copied(spark)
    quality.fit(d, sample=400)
    assert 200 < rows[0] <= 400


def test_a_labeller_that_is_often_wrong_is_found_out():
    """One votes bad on a fifth of the good texts; counts outweigh the prior."""
    rng = np.random.default_rng(2)
    good = rng.random(50_000) < 0.8
    right_bad = np.array([0.3, 0.5, 0.4, 0.6, 0.7])
    wrong = np.array([0.0005, 0.0005, 0.2, 0.001, 0.0005])
    v = np.ones((len(good), 5), np.int8)
    v[rng.random(v.shape) < np.where(good[:, None], wrong, right_bad)] = 0
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    found = quality.estimate(patterns, counts.astype(float))
    assert abs((1 - found.on_good)[2] - 0.2) < 0.03 and (1 - found.on_good)[[0, 1, 3, 4]].max() < 0.01
    assert abs(found.good - 0.8) < 0.03
    alone = np.array([[1, 1, 0, 1, 1]], np.int8)
    assert found.posterior(alone)[0] > 0.8  # that vote alone marks no text as bad


def test_language_scores_against_plain_loops(spark):
    """The query's language and score of every text, from dictionaries of hashed grams."""
    d = docs(spark)
    model = langid.fit(d, ~langid.held_out())

    def brute(text):
        runs, word = [], ""
        for c in (text or "").lower():
            if c.isalpha():
                word += c
            elif word:
                runs.append(word)
                word = ""
        code = np.array([ord(c) for c in " ".join(runs + ([word] if word else [])) + " "], np.uint64)
        if len(code) < 2:
            return "und", 0.0
        counts = Counter()
        gram = code.copy()
        for n in (1, 2, 3):
            if n > 1:
                gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:]
            h = mix64(gram + np.uint64(n << 40)) & np.uint64(langid.DIMS - 1)
            for k, x in enumerate(h.tolist()):
                if n > 1 or code[k] != 32:
                    counts[x] += 1
        w = {k: (1 + math.log(c)) * model.idf[k] for k, c in counts.items()}
        size = math.sqrt(sum(x * x for x in w.values()))
        near = [sum(x * float(c[k]) for k, x in w.items()) / size for c in model.centroids]
        best = max(range(len(near)), key=lambda j: (near[j], -j))
        return model.langs[best], near[best]

    got = {r["doc_id"]: r for r in langid.op3(d).collect()}
    for r in d.limit(150).collect():
        # a text that begins with another character has a border in front of it, too
        text = r["text"].lstrip("0123456789 \t\n.,;:-–—\"'«»¿¡()[]{}#*<>/|!?&$%@~^_=+\\`")
        if text != r["text"]:
            continue
        lang, score = brute(text)
        assert got[r["doc_id"]]["lang_pred"] == lang
        assert abs(got[r["doc_id"]]["score"] - score) < 1e-3


def test_toxicity_scores_against_plain_loops(spark):
    """The query's score of every text, from a scan of its words without an automaton."""
    d, labels = docs(spark), spark.read.parquet(f"{SF}/labels.parquet")
    lexicon = toxicity.fit(d, labels, ~toxicity.held_out())

    def brute(text):
        words = toxicity.fold(text or "").split()
        weight = [max([w for e, w in lexicon.weights.items()
                       if (f" {word} ").startswith(e)], default=0.0) for word in words]
        for phrase in lexicon.exceptions:
            p = phrase.split()
            for k in range(len(words) - len(p) + 1):
                if words[k:k + len(p)] == p:
                    weight[k:k + len(p)] = [0.0] * len(p)
        hits = [w for w in weight if w]
        x = (0.0, 0.0, 0.0) if not hits else (
            min(10 * sum(hits) / len(words), 10.0), math.log1p(sum(hits)), len(hits) / len(words))
        a, b, c, e = lexicon.curve
        return 1 / (1 + math.exp(-max(-50, min(50, a * x[0] + b * x[1] + c * x[2] + e))))

    got = {r["doc_id"]: r["score"] for r in toxicity.op6(d, labels).collect()}
    rows = [r for r in d.collect() if len(r["text"]) < 2_000]
    assert len(rows) > 300
    for r in rows:
        assert abs(got[r["doc_id"]] - brute(r["text"])) < 1e-9


def test_quality_scores_against_plain_loops(spark):
    """The query's score of every text, from a walk over its bytes."""
    d = docs(spark)
    model = quality.fit(d)
    low = {2: ("repeats", 97), 3: ("stutter", 197)}

    def brute(text):
        raw = (text or "").encode()
        cls = []
        for b in raw:
            c = int(quality.CLASS[b])
            if c != 1 or not cls or cls[-1] != 1:
                cls.append(c)
        x = np.zeros(quality.DIMS)
        for a, b, c in zip(cls, cls[1:], cls[2:]):
            gram = (a * quality.CLASSES + b) * quality.CLASSES + c
            x[(gram * 2_654_435_761 >> 7) % quality.DIMS] += 1
        x = np.sqrt(x / max(x.sum(), 1))
        m = quality.measures(*spans(pa.array([text or ""])))
        for name, salt in low.values():
            tenth = int(math.floor(min(max(m[name][0], 0), 0.99) * 10)) + salt
            x[int(mix64(np.array([tenth], np.uint64))[0]) % quality.DIMS] += 0.5
        z = float(x @ model.weights[:-1] + model.weights[-1])
        return 1 / (1 + math.exp(-max(-50, min(50, z)))) if (text or "").split() else 0.0

    got = {r["doc_id"]: r["score"] for r in quality.op5(d).collect()}
    for r in [r for r in d.collect() if len(r["text"]) < 1_500][:200]:
        assert abs(got[r["doc_id"]] - brute(r["text"])) < 1e-4


def test_phrases_beside_very_long_words():
    lexicon = toxicity.Lexicon({" bad ": 1.0})
    long = "x" * 500
    assert toxicity.phrases_around(toxicity.fold(f"{long} bad {long} bad"), lexicon) \
        == {f"{long} bad {long}"}
    assert toxicity.phrases_around(toxicity.fold("bad one"), lexicon) == set()
    assert toxicity.phrases_around(toxicity.fold("so bad one bad two"), lexicon) \
        == {"so bad one", "one bad two"}


def test_contradicting_labels_count_as_toxic(spark):
    rows = [row(k, f"some words here {'grrab' if k % 2 else 'fine'} and w{k}") for k in range(80)]
    marks = [(k, 1, k % 2) for k in range(80)]
    both = marks + [(k, 1, 0) for k in range(80)]
    d = spark.createDataFrame(rows, SCHEMA)
    table = lambda m: spark.createDataFrame(m, "doc_id long, quality int, toxic int")
    one = toxicity.fit(d, table(marks), F.lit(True))
    assert toxicity.fit(d, table(both), F.lit(True)) == one == \
        toxicity.fit(d, table(both[::-1]), F.lit(True))


def test_written_shards_keep_every_column(spark, tmp_dir):
    names = ["size", "rank", "slot", "place", "shard", "text_crc32", "_row"]
    d = spark.createDataFrame([row(k, f"text {k}") for k in range(50)], SCHEMA).drop("size", "rank")
    for n in names:
        d = d.withColumn(n, F.concat(F.lit(f"{n}-"), F.col("doc_id")))
    sharding.write_shards(d, tmp_dir, shards=4)
    back = spark.read.parquet(tmp_dir)
    assert set(back.columns) == {*d.columns, "shard_"}
    rows = back.collect()
    assert len(rows) == 50 and {r["shard_"] for r in rows} == {0, 1, 2, 3}
    assert all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names)
