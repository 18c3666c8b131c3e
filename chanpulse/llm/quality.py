"""Quality classifier from weak labels.

Labellers look at a text's characters and words and vote good, bad or abstain;
they overlap and none is right throughout.  Expectation-maximisation over the
counts of their vote patterns (every document counts; there are at most
3 ** labellers patterns) estimates how each votes on good and on bad texts (its
accuracies), and the share of good ones.  The posterior of a document's votes is its
soft label.  A linear scorer over hashed character-class trigrams (and repetition) learns these
labels by logistic regression, on at most SAMPLE distinct texts (those of the smallest
hashes), evenly from likely good and likely bad ones and weighted back to the corpus; a
text counts once, however often it is copied.  It has no access to the votes, so it carries over to texts on which
they abstain.

Scale: two passes over whole texts, a shuffle of at most 3 ** labellers counts a
task, and SAMPLE * DIMS floats to the driver, whatever the input.

Edge cases: a null text, or one without a word, has score 0 and is rejected;
other texts are scored however short; labels, lang, source and ids are never
inputs; extra columns are kept by the stage; repeated rows have equal scores; an
empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import arrow_udf, fresh, map_in_arrow
from chanpulse.llm.textarrays import mix64, slices, spans, word_bounds, word_hashes

DIMS = 1024
SAMPLE = 6_000
ROUNDS = 100
KEEP = 0.5
LABELLERS = ("symbols", "capitals", "bars", "shouting", "plain", "clean_words", "word_length",
             "sentences", "repeats", "stutter")
#: How often labellers are taken to vote bad on good texts, and of how many votes that is worth.
FALSE_ALARM, WORTH = 0.002, 100.0
#: Prior counts of right and wrong votes on bad texts, and of good and bad texts.
ON_BAD, PRIOR = (2.0, 3.0), (8.0, 2.0)


def byte_classes() -> np.ndarray:
    """Small letter (or a byte beyond ASCII), capital, digit, space, line end; each mark its own."""
    c = np.zeros(256, np.int64)
    c[ord("a"):ord("z") + 1] = 1
    c[ord("A"):ord("Z") + 1] = 2
    c[ord("0"):ord("9") + 1] = 3
    c[[9, 11, 12, 32]] = 4
    c[[10, 13]] = 5
    c[0x80:] = 1
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    c[marks] = 6 + np.arange(len(marks))
    return c


CLASS = byte_classes()
CLASSES = int(CLASS.max()) + 1


def repeats(words: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Share of a text's word triples that stood in it before."""
    if len(words) < 3:
        return np.zeros(n)
    triple = mix64(mix64(words[:-2]) + mix64(words[1:-1] * np.uint64(3)) + words[2:] * np.uint64(5))
    fine = of[:-2] == of[2:]
    text, triple = of[:-2][fine], triple[fine]
    total = np.bincount(text, minlength=n)
    order = np.lexsort((triple, text))
    text, triple = text[order], triple[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (triple[1:] != triple[:-1])
    return 1 - np.bincount(text[new], minlength=n) / np.maximum(total, 1) - (total == 0)


def stutter(words: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Words of a text that are one of the three before them."""
    again = np.zeros(len(words), bool)
    for back in (1, 2, 3):
        again[back:] |= (words[back:] == words[:-back]) & (of[back:] == of[:-back])
    return np.bincount(of[again], minlength=n).astype(float)


def measures(body: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Shares per text; characters are counted without continuation bytes."""
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    count = lambda mask: np.bincount(doc[mask], minlength=n).astype(float)
    cls, lead = CLASS[body], (body & 0xC0) != 0x80
    space = (cls == 4) | (cls == 5)
    begin, end, of = word_bounds(body, at)
    mark, letter = cls >= 6, (cls == 1) | (cls == 2)
    soft = np.isin(body, np.frombuffer(b".,;:?'\"()-", np.uint8))
    # a word is clean if it has letters and, but for marks of prose, nothing else
    sums = lambda mask: np.r_[0, np.cumsum(mask)]
    own = sums(~space & letter)
    has = own[end] > own[begin]
    other = sums(~space & ~letter & ~soft)
    odd = other[end] > other[begin]
    n_words = np.bincount(of, minlength=n).astype(float)
    one = np.maximum(n_words, 1)
    chars = np.maximum(count(lead), 1)
    n_letters = count(letter & lead)
    return {
        "words": n_words,
        "symbols": count(mark & ~soft) / chars,
        "capitals": count(cls == 2) / np.maximum(n_letters, 1),
        "letters": n_letters,
        "bars": count(body == ord("|")) / one,
        "shouting": count(body == ord("!")) / one,
        "plain": (n_letters + count((cls == 3) | space | soft)) / chars,
        "clean_words": np.bincount(of[has & ~odd], minlength=n) / one,
        "word_length": count(lead & ~space) / one,
        "repeats": repeats(word_hashes(body, begin, end), of, n),
        "stutter": stutter(word_hashes(body, begin, end), of, n) / one,
        "sentences": n_words / np.maximum(count(np.isin(body, np.frombuffer(b".?", np.uint8))), 1),
    }


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """A column per labeller: 1 good, 0 bad, -1 abstains."""
    def vote(good, bad, may=True):
        return np.where(np.logical_and(may, bad), 0, np.where(np.logical_and(may, good), 1, -1))
    some = m["words"] >= 3
    return np.stack([
        vote(m["symbols"] < 0.03, m["symbols"] > 0.08),
        vote(m["capitals"] < 0.2, m["capitals"] > 0.5, m["letters"] >= 10),
        vote(m["bars"] < 0.02, m["bars"] > 0.2),
        vote(m["shouting"] < 0.05, m["shouting"] > 0.4),
        vote(m["plain"] > 0.93, m["plain"] < 0.88, some),
        vote(m["clean_words"] > 0.8, m["clean_words"] < 0.5, some),
        vote((m["word_length"] > 2.5) & (m["word_length"] < 12),
             (m["word_length"] < 1.5) | (m["word_length"] > 25), some),
        vote(m["sentences"] < 40, m["sentences"] > 120, m["words"] >= 20),
        vote(m["repeats"] < 0.25, m["repeats"] > 0.5, m["words"] >= 12),
        vote(m["stutter"] < 0.1, m["stutter"] > 0.35, m["words"] >= 12)], axis=1).astype(np.int8)


def features(body: np.ndarray, at: np.ndarray, m: dict[str, np.ndarray],
             dims: int = DIMS) -> np.ndarray:
    """Hashed trigrams of character classes, as square roots of their shares, and
    hashed indicators of how much a text repeats itself and stutters, in tenths."""
    n = len(at) - 1
    cls = CLASS[body]
    # runs of small letters count once: shapes of words, not their letters
    keep = np.ones(len(body), bool)
    keep[1:] = (cls[1:] != 1) | (cls[:-1] != 1)
    doc = np.repeat(np.arange(n), np.diff(at))[keep]
    cls = cls[keep]
    gram = (cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:]
    fine = doc[:-2] == doc[2:] if len(doc) > 2 else np.zeros(0, bool)
    h = (gram[fine] * 2_654_435_761 >> 7) % dims
    x = np.bincount(doc[:-2][fine] * dims + h, minlength=n * dims).reshape(n, dims).astype(np.float32)
    x = np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1))
    for k, name in enumerate(("repeats", "stutter")):
        tenth = np.floor(np.clip(m[name], 0, 0.99) * 10).astype(np.uint64) + np.uint64(100 * k + 97)
        x[np.arange(n), (mix64(tenth) % np.uint64(dims)).astype(np.int64)] += 0.5
    return x


@dataclass
class Labels:
    """What EM found: the share of good texts, and each labeller's rate of being right
    where it votes, on good and on bad texts."""
    good: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        yes, no = (v == 1).astype(float), (v == 0).astype(float)
        g = np.log(self.good) + yes @ np.log(self.on_good) + no @ np.log(1 - self.on_good)
        b = np.log(1 - self.good) + no @ np.log(self.on_bad) + yes @ np.log(1 - self.on_bad)
        return 1 / (1 + np.exp(np.clip(b - g, -500, 500)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Labels:
    """EM over distinct vote patterns and their counts; abstaining says nothing.

    A labeller knows one kind of fault, so on bad texts it may often be wrong; it is meant
    to vote bad on grounds that good texts hardly give.  That is a prior (FALSE_ALARM, worth
    WORTH votes) which names the sides, and which counts outweigh: a labeller that often
    votes bad on texts that the others find good is found to do so.
    """
    k = patterns.shape[1]
    found = Labels(PRIOR[0] / sum(PRIOR), np.full(k, 1 - FALSE_ALARM),
                   np.full(k, ON_BAD[0] / sum(ON_BAD)))
    yes, no = (patterns == 1).astype(float), (patterns == 0).astype(float)
    for _ in range(rounds if len(counts) else 0):
        p = found.posterior(patterns)
        g, b = p * counts, (1 - p) * counts
        wrong = (g @ no + WORTH * FALSE_ALARM) / (g @ (yes + no) + WORTH)
        on_bad = (b @ no + ON_BAD[0]) / (b @ (yes + no) + sum(ON_BAD))
        good = (g.sum() + PRIOR[0]) / (counts.sum() + sum(PRIOR))
        # only what a logarithm can't take is kept away
        found = Labels(float(good), 1 - np.clip(wrong, 1e-6, 0.5), np.clip(on_bad, 1e-6, 1 - 1e-6))
    return found


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300,
             ridge: float = 1e-5) -> np.ndarray:
    """Soft-label logistic regression by accelerated gradient steps; last weight: intercept."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = weight / weight.sum()
    rate = 4.0 / max((weight[:, None] * x * x).sum(), 1e-9)
    w = z = np.zeros(x.shape[1])
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ z, -50, 50)))
        new = z - rate * (x.T @ (weight * (p - y)) + ridge * z)
        z, w = new + t / (t + 3) * (new - w), new
    return w


@dataclass
class Model:
    labels: Labels
    weights: np.ndarray

    def score(self, body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = measures(body, at)
        x = features(body, at, m)
        s = 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -50, 50)))
        some = m["words"] > 0
        return np.where(some, s, 0.0), np.where(some, self.labels.posterior(votes(m)), 0.0)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    def pattern(text: pa.Array) -> pa.Array:
        out = []
        for part in slices(text):
            body, at = spans(part)
            m = measures(body, at)
            found = (votes(m).astype(np.int64) + 1) @ (3 ** np.arange(len(LABELLERS)))
            out.append(np.where(m["words"] > 0, found, -1))
        return pa.array(np.concatenate([*out, np.zeros(0, np.int64)]).astype(np.int32))

    voted = arrow_udf(pattern, "int")(F.col("text"))
    own = F.xxhash64("text").alias("h")
    seen = [(r["p"], r["n"], r["d"]) for r in docs.select(voted.alias("p"), own).groupBy("p")
            .agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("d")).collect()
            if r["p"] >= 0]
    codes = np.array([p for p, _, _ in seen], np.int64).reshape(-1)
    counts, texts = (np.array([r[k] for r in seen], float) for k in (1, 2))
    patterns = codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1
    labels = estimate(patterns, counts)
    if not seen:
        return Model(labels, np.zeros(DIMS + 1))
    side = labels.posterior(patterns) >= 0.5
    total = {True: counts[side].sum(), False: counts[~side].sum()}
    # about twice as many distinct texts of each side as are wanted, and then the first
    share = {k: min(1.0, (sample + 50) / max(n, 1))
             for k, n in ((True, texts[side].sum()), (False, texts[~side].sum()))}

    def draw(batches):
        taken: set = set()
        for batch in batches:
            rows, done = [], 0
            for part in slices(batch.column(0)):
                body, at = spans(part)
                m = measures(body, at)
                p = labels.posterior(votes(m))
                h = batch.column(1).slice(done, len(part)).to_pylist()
                u = batch.column(2).slice(done, len(part)).to_numpy()
                done += len(part)
                take = (u < np.where(p >= 0.5, share[True], share[False])) & (m["words"] > 0)
                # a copy is told by its hash; there are about SAMPLE of them
                new = [k for k in np.flatnonzero(take).tolist()
                       if h[k] not in taken and not taken.add(h[k])]
                x = features(body, at, m) if new else None
                rows += [(bool(p[k] >= 0.5), h[k], u[k], p[k], x[k].tobytes()) for k in new]
            kinds = (pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["good", "h", "u", "p", "x"])

    u = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    may = docs.select("text", own, u.alias("u")).filter(F.col("u") < max(share.values())) \
        .filter(F.col("text").isNotNull())
    near = map_in_arrow(may, draw, "good boolean, h long, u double, p double, x binary")
    nth = F.row_number().over(Window.partitionBy("good").orderBy("u", "h"))
    drawn = near.dropDuplicates(["h"]).withColumn("nth", nth) \
        .filter(F.col("nth") <= sample // 2).select("p", "x").collect()
    drawn.sort(key=lambda r: (r["p"], r["x"]))
    y = np.array([r["p"] for r in drawn])
    x = np.array([np.frombuffer(r["x"], np.float32) for r in drawn]).reshape(-1, DIMS)
    if not len(y):
        return Model(labels, np.zeros(DIMS + 1))
    # each side weighs what its documents are
    weight = np.where(y >= 0.5, total[True] / max(1, (y >= 0.5).sum()),
                      total[False] / max(1, (y < 0.5).sum()))
    return Model(labels, logistic(x, y, weight))


def score_column(model: Model):
    """Arrow UDF: text to score and posterior of being good."""
    def run(text: pa.Array) -> pa.Array:
        score, post = [np.zeros(0)], [np.zeros(0)]
        for part in slices(text):
            s, p = model.score(*spans(part))
            score.append(s)
            post.append(p)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(score)),
                                           pa.array(np.concatenate(post))], ["score", "posterior"])
    return arrow_udf(run, "score double, posterior double")


def op5(docs: DataFrame) -> DataFrame:
    s = score_column(fit(docs))
    return docs.select("doc_id", s(F.col("text")).alias("_s")).select(
        "doc_id", "_s.score", "_s.posterior", (F.col("_s.score") >= KEEP).cast("int").alias("predicted"))


def accepted(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    model, s = fit(docs), fresh(docs, "_quality")
    return docs.withColumn(s, score_column(model)(F.col("text"))) \
        .filter(F.col(s)["score"] >= KEEP).drop(s)
