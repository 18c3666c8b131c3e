"""Language identification by the nearest centroid.

Features are hashed 1- to 3-grams of letters with word borders, weighted by
(1 + log count) * idf and normalised.  Each language has several centroids, the
result of spherical k-means over its training documents, so that registers of a
language needn't share one direction.  A text takes the language of the centroid
with the largest cosine, which is its score; a text without any letter is rejected,
and so is one whose distance (1 - cosine) exceeds FAR or what texts of that language
and length have.

The latter comes from the training documents: they and their beginnings (HEADS code
points) are held against centroids of the other half of their language's documents,
the cosines are grouped by the power of two of the number of grams, and SLACK times the
QUANTILE of a group is the least cosine that is accepted.  A group of fewer than
LEAST_SEEN takes the bound of the next shorter one, no bound exceeds that of a longer
group, and a language of too few documents for any has FAR alone.

Training: at most PER_LANG distinct texts of each language (those of the smallest hashes,
from all documents that may be learnt from; a text counts once, however often it is copied)
give the idf and the centroids: a group of that size per language is what meets in one task, and
langs * CENTROIDS * DIMS floats are what reaches the driver and the workers.
Scoring is one pass over whole texts without a shuffle.

Edge cases: a null text or one without a letter is ``und`` with score 0, and
rejected; null languages aren't learnt; without any training document every text
is ``und``; ties go to the language first in code point order; extra columns are
ignored by the query and kept by the stage; empty tables give no row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import arrow_udf, fresh, held_out, materialise
from chanpulse.llm.textarrays import mix64, slices, texts

DIMS = 4096
PER_LANG = 1_000
CENTROIDS = 4
ROUNDS = 12
#: Largest distance from the nearest centroid that is still accepted.
FAR = 0.98
#: Quantile of the training cosines of a length, the share of it that is still accepted,
#: and how many cosines make a quantile.
QUANTILE, SLACK, LEAST_SEEN = 0.01, 0.7, 5
#: Code points of the beginnings that stand for shorter texts.
HEADS = (8, 16, 32, 64, 128, 256, 512, 1024, 4096)
#: Groups of lengths: powers of two of the number of grams.
LENGTHS = 40
UNKNOWN = "und"
SLICE, SLICE_TEXTS = 1 << 19, 256


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(values: list[str], dims: int = DIMS) -> np.ndarray:
    """Counts of hashed 1- to 3-grams, a row per text."""
    low = [v.lower() for v in values]
    sizes = np.fromiter((len(v) + 1 for v in low), np.int64, len(low))
    code = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low)), sizes)
    letter = letters()[code]
    # one border between words: a run of other characters counts as its first one
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = np.where(letter, code, 32)[keep].astype(np.uint64)
    doc, letter = doc[keep], letter[keep]
    out = np.zeros(len(low) * dims, np.int64)
    mask = np.uint64(dims - 1)
    gram = c.copy()
    for n in range(1, 4):
        if n > 1:
            gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:]
        m = len(gram)
        fine = doc[:m] == doc[n - 1:]
        if n == 1:
            fine = letter
        h = (mix64(gram[fine] + np.uint64(n << 40)) & mask).astype(np.int64)
        out += np.bincount(doc[:m][fine] * dims + h, minlength=len(out))
    return out.reshape(len(low), dims)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    np.log(x, out=x, where=x > 0)
    x = np.where(counts > 0, 1 + x, 0) * idf.astype(np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def spherical_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k unit centroids; the start is the mean, then whatever lies farthest."""
    first = x.sum(0)
    found = [first / max(np.linalg.norm(first), 1e-12)]
    while len(found) < min(k, len(x)):
        near = (x @ np.array(found).T).max(1)
        if near.min() > 1 - 1e-6:
            break
        found.append(x[int(near.argmin())])
    c = np.array(found)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.array([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def length_group(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts.sum(1), 1)).astype(int), LENGTHS - 1)


def least_cosines(group: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The least cosine that is accepted, by group of lengths."""
    found = np.full(LENGTHS, np.nan)
    for g in np.unique(group):
        if (group == g).sum() >= LEAST_SEEN:
            found[g] = SLACK * np.quantile(near[group == g], QUANTILE)
    out, longer = np.zeros(LENGTHS), np.inf
    for g in range(LENGTHS)[::-1]:
        longer = np.fmin(longer, found[g])
        found[g] = np.nan if np.isnan(found[g]) else longer
    for g in range(LENGTHS):
        out[g] = (out[g - 1] if g else 0.0) if np.isnan(found[g]) else found[g]
    return out


def rows_of(group: pa.Table) -> np.ndarray:
    """Dense counts of a table's sparse ones."""
    out = np.zeros((group.num_rows, DIMS), np.int64)
    at = group["at"].combine_chunks()
    sizes = np.diff(at.offsets.to_numpy())
    out[np.repeat(np.arange(len(sizes)), sizes), at.flatten().to_numpy()] = \
        group["n"].combine_chunks().flatten().to_numpy()
    return out


@dataclass
class Model:
    langs: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    #: By centroid and group of lengths, the least cosine that is accepted.
    least: np.ndarray

    def predict(self, values: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and whether the text is rejected."""
        counts = gram_counts(values)
        some = counts.any(1)
        if not self.langs:
            return [UNKNOWN] * len(values), np.zeros(len(values)), np.ones(len(values), bool)
        near = weigh(counts, self.idf) @ self.centroids.T
        best = near.argmax(1)
        score = np.where(some, np.clip(near[np.arange(len(best)), best], 0, 1), 0.0)
        least = np.maximum(1 - FAR, self.least[best, length_group(counts)])
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], \
            score, ~some | (score < least)


def fit(docs: DataFrame, may_learn: Column, per_lang: int = PER_LANG, k: int = CENTROIDS) -> Model:
    """Centroids from the rows of ``docs`` (text, lang) that ``may_learn`` allows."""
    spark = docs.sparkSession
    rows = docs.filter(may_learn).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # copies are one text: about how many distinct ones a language has
    own = rows.select("lang", "text", F.xxhash64("text").alias("_h"))
    counts = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(
        F.approx_count_distinct("_h").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((0, DIMS), np.float32), np.ones(DIMS), np.zeros((0, LENGTHS)))
    # the texts of the smallest hashes, per_lang of a language: from about twice as many,
    # each of which is one row before the rank is taken
    share = F.create_map(*[x for lang, n in counts.items()
                           for x in (F.lit(lang), F.lit(min(1.0, (2 * per_lang + 50) / n)))])
    u = F.pmod(F.col("_h"), F.lit(1 << 30))
    near = own.filter(u < F.element_at(share, F.col("lang")) * (1 << 30)) \
        .groupBy("lang", "_h").agg(F.min("text").alias("text")).withColumn("_u", u)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_u", "_h"))
    drawn = near.withColumn("_nth", first).filter(F.col("_nth") <= per_lang)

    def sparse(text: pa.Array) -> pa.Array:
        out = []
        for part in slices(text, SLICE, SLICE_TEXTS):
            some = texts(part)
            of = [[] for _ in some]
            for head in (None, *HEADS):
                own = [k for k, t in enumerate(some) if head is None or len(t) > head]
                for k, row in zip(own, gram_counts([some[k][:head] for k in own]), strict=True):
                    at = np.flatnonzero(row)
                    of[k].append({"at": at.tolist(), "n": row[at].tolist()})
            out += of
        return pa.array(out, pa.list_(pa.struct([("at", pa.list_(pa.int32())),
                                                 ("n", pa.list_(pa.int32()))])))

    grams = arrow_udf(sparse, "array<struct<at: array<int>, n: array<int>>>")
    # copies of a text are in one half
    half = F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(2)).cast("int")
    sample = materialise(spark, drawn.select(
        "lang", half.alias("half"), F.posexplode(grams(F.col("text"))).alias("head", "g"))
        .select("lang", "half", "head", "g.*").filter(F.size("at") > 0), "lang-sample")
    whole = sample.filter("head = 0")
    n = whole.count()
    df = np.zeros(DIMS)
    for r in whole.select(F.explode("at").alias("at")).groupBy("at").agg(
            F.count("*").alias("n")).collect():
        df[r["at"]] = r["n"]
    idf = np.log((1 + n) / (1 + df)) + 1

    def means(x: np.ndarray) -> np.ndarray:
        # the order of a shuffle's rows is not fixed; the means' start must be
        x = x[np.lexsort(x.T[::-1][-64:])]
        return spherical_means(weigh(x, idf), k).astype(np.float32)

    def cluster(group: pa.Table) -> pa.Table:
        head, side = group["head"].to_numpy(), group["half"].to_numpy()
        x = rows_of(group.filter(pa.array(head == 0)))
        c, own = means(x), side[head == 0]
        others = [means(x[own != h]) if (own != h).any() else None for h in (0, 1)]
        seen, near = [np.zeros(0, int)], [np.zeros(0)]
        for h in (0, 1):
            for part in np.unique(head[side == h]) if others[h] is not None else ():
                x = rows_of(group.filter(pa.array((head == part) & (side == h))))
                seen.append(length_group(x))
                near.append((weigh(x, idf) @ others[h].T).max(1))
        least = least_cosines(np.concatenate(seen), np.concatenate(near)).tobytes()
        lang = group["lang"][0].as_py()
        return pa.table({"lang": [lang] * len(c), "c": [row.tobytes() for row in c],
                         "least": [least] * len(c)}, schema=pa.schema(
                             [("lang", pa.string()), ("c", pa.binary()), ("least", pa.binary())]))

    found = sorted(((r["lang"], bytes(r["c"]), bytes(r["least"])) for r in sample.groupBy("lang")
                    .applyInArrow(cluster, "lang string, c binary, least binary").collect()))
    return Model([lang for lang, _, _ in found],
                 np.array([np.frombuffer(c, np.float32) for _, c, _ in found]).reshape(-1, DIMS), idf,
                 np.array([np.frombuffer(b) for _, _, b in found]).reshape(-1, LENGTHS))


def predict_column(model: Model):
    """Arrow UDF: text to lang_pred, score and rejected."""
    def run(text: pa.Array) -> pa.Array:
        lang, score, gone = [], [], [np.zeros(0, bool)]
        for part in slices(text, SLICE, SLICE_TEXTS):
            found, near, far = model.predict(texts(part))
            lang += found
            score.append(near.astype(np.float64))
            gone.append(far)
        score = np.concatenate([*score, np.zeros(0)])
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(np.concatenate(gone))],
            ["lang_pred", "score", "rejected"])
    return arrow_udf(run, "lang_pred string, score double, rejected boolean")


def op3(docs: DataFrame) -> DataFrame:
    model = fit(docs, ~held_out())
    p = predict_column(model)
    return docs.select("doc_id", held_out().alias("held_out"), p(F.col("text")).alias("_p")) \
        .select("doc_id", "held_out", "_p.lang_pred", "_p.score", "_p.rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    model, p = fit(docs, F.lit(True)), fresh(docs, "_lang")
    return docs.withColumn(p, predict_column(model)(F.col("text"))) \
        .filter(~F.col(p)["rejected"]).drop(p)
