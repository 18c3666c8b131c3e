"""Toxicity by a weighted lexicon.

Text is folded before matching: lower case, compatibility forms, homoglyphs of
other scripts, invisible characters, digits and signs that stand for letters (l
and i fold to one letter, since 1 stands for either).  An Aho-Corasick automaton
finds the entries, whole words and beginnings of words, in one pass over a text.
Where several entries match at a word, the heaviest counts; a word inside an
exception phrase doesn't count.  The summed weight is normalised by the number
of words, and a logistic curve turns it into a score from 0 to 1.

Learning: from labelled rows that may be learnt from, at most about SAMPLE of each
class, drawn by a hash of the id in the narrow label table.  On four folds of
five, entries are the words and beginnings that stand in more toxic texts than
chance explains (signed root of the likelihood ratio at least SURE), weighted by
log odds, at most ENTRIES; exception phrases are an entry's neighbours that clean
texts share and toxic ones don't.  The curve is fitted on the other fold, whose
words the lexicon has not seen.  GIVEN names entries known beforehand.

Scale: the sampled ids (under a megabyte) and the lexicon are broadcast; words
are counted in every task before they are shuffled; whole texts are scored in one
pass without a shuffle.

Edge cases: a null text or one without a word has no hit and gets the score of
such texts; without labels of both classes, given entries alone decide; null
labels and null ids aren't learnt from; repeated rows have equal scores; other
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanpulse.llm.common import arrow_udf, held_out, map_in_arrow, materialise
from chanpulse.llm.quality import logistic
from chanpulse.llm.textarrays import slices, texts

SAMPLE = 5_000
ENTRIES = 5_000
PHRASES = 5_000
SURE = 4.0
HEAVIEST = 6.0
STEMS = (4, 5, 6, 7, 8)
#: Entries known beforehand, with their weights (a parameter of ``fit``).
GIVEN: dict[str, float] = {}

# fixed values: letters of other scripts that look like Latin ones
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԛ": "q",
    "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ʀ": "r",
}
# fixed values: digits and signs that stand for letters
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
# fixed values: characters that aren't seen
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

#: A sign within a word, or at its beginning
_BETWEEN = re.compile(r"(?:(?<=\w)|(?<!\S))[@$!|+](?=[^\W\d_])")
_ODD = re.compile(r"[^\x00-\x7f\w]+")
_WORD = re.compile(r"[^ ]+")


@lru_cache(maxsize=1)
def _table() -> dict[int, str | None]:
    """Folds a lower-case character; what is neither letter nor digit becomes a space."""
    table: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum()}
    table.update({ord(a): b for a, b in (HOMOGLYPHS | DIGITS).items()})
    table.update({ord(c): None for c in INVISIBLE})
    table[ord("l")] = "i"
    return table


def fold(text: str) -> str:
    """Folded words, each between single or more spaces, with one at either end."""
    text = text.lower()
    plain = text.isascii()
    if not plain:
        text = unicodedata.normalize("NFKC", text)
    if any(s in text for s in SIGNS):
        text = _BETWEEN.sub(lambda m: SIGNS[m[0]], text)
    text = text.translate(_table())
    return f" {text} " if plain else f" {_ODD.sub(' ', text)} "


def entries_of(word: str) -> list[str]:
    """A word's possible entries: itself, and its beginnings."""
    return [f" {word} ", *[f" {word[:n]}" for n in STEMS if len(word) > n]]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = ()
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return (self.weights, self.exceptions, self.curve)

    def __setstate__(self, state):
        self.weights, self.exceptions, self.curve = state
        self._automaton = None

    def automaton(self):
        if self._automaton is None:
            import ahocorasick
            a = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                a.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                a.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def hits(self, folded: str) -> dict[int, float]:
        """Weight by the place where a matched word begins."""
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        if self.weights:
            for end, (size, weight) in self.automaton().iter(folded):
                start = end - size + 1
                if weight:
                    if weight > found.get(start, 0.0):
                        found[start] = weight
                else:
                    excused.append((start, end))
        for a, b in excused if found else ():
            for k in [k for k in found if a <= k < b]:
                del found[k]
        return found

    def measures(self, text: str) -> tuple[float, float, float]:
        """Weight per word, log of the summed weight, share of words that match."""
        folded = fold(text)
        found = self.hits(folded)
        if not found:
            return 0.0, 0.0, 0.0
        words, total = max(1, len(folded.split())), sum(found.values())
        return min(10 * total / words, 10.0), float(np.log1p(total)), len(found) / words

    def score(self, values: list[str]) -> np.ndarray:
        x = np.array([self.measures(v) for v in values]).reshape(-1, 3)
        if not self.curve:  # nothing learnt: a word in ten of weight 1 is even odds
            return 1 - 0.5 ** x[:, 0]
        c = np.array(self.curve)
        return 1 / (1 + np.exp(-np.clip(x @ c[:3] + c[3], -50, 50)))


def phrases_around(folded: str, lexicon: Lexicon) -> set[str]:
    """Matched words with the word before and the word after, however long these are."""
    hits = lexicon.hits(folded)
    words = [(m.start(), m[0]) for m in _WORD.finditer(folded)] if hits else []
    # a match begins at the space before its word
    return {" ".join(w for _, w in words[i - 1:i + 2])
            for i, (start, _) in enumerate(words[:-1]) if i and start - 1 in hits}


def _signed_root(a, n_a, b, n_b):
    """Signed root of the likelihood ratio of two shares, a of n_a and b of n_b."""
    def part(x, n):
        rate = (a + b) / (n_a + n_b)
        with np.errstate(divide="ignore", invalid="ignore"):
            yes = np.where(x > 0, x * np.log(x / (n * rate)), 0)
            no = np.where(n > x, (n - x) * np.log((n - x) / (n * (1 - rate))), 0)
        return yes + no
    g = 2 * (part(a, n_a) + part(b, n_b))
    return np.sign(a / n_a - b / n_b) * np.sqrt(np.maximum(g, 0))


def _counts(rows: DataFrame, per_text, keep: int) -> DataFrame:
    """How many toxic and clean texts have each key; a task's counts are summed first."""
    def run(batches):
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                (toxic if y else clean).update(per_text(text))
            keys = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                 pa.array([clean[k] for k in keys], pa.int64())], ["key", "toxic", "clean"])
    return map_in_arrow(rows, run, "key string, toxic long, clean long").groupBy("key").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .filter(F.col("toxic") + F.col("clean") >= keep)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: int = SAMPLE,
        given: dict[str, float] | None = None) -> Lexicon:
    """Lexicon and curve from rows of ``docs`` (doc_id, text) that ``labels`` marks."""
    spark = docs.sparkSession
    known = {f" {w} ": x for k, x in (GIVEN if given is None else given).items()
             for w in [fold(k).strip()]}
    # of contradicting labels of a document the toxic one counts
    marked = labels.filter(may_learn & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("y")).filter(F.col("y").isNotNull())
    n = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Lexicon(known)
    share = {y: min(1.0, sample / k) for y, k in n.items()}
    u = F.pmod(F.xxhash64(F.lit("draw"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = marked.filter(u < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    fold_of = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5))
    # about 2 * sample narrow rows, whatever the input
    rows = materialise(spark, docs.select("doc_id", "text").filter(F.col("text").isNotNull())
                       .join(F.broadcast(drawn), "doc_id")
                       .select("text", "y", (fold_of == 0).alias("other")), "toxic-sample")
    first = rows.filter(~F.col("other")).select("text", "y")
    size = {r["y"]: r["n"] for r in first.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Lexicon(known)

    def candidates(text: str) -> set[str]:
        return {e for w in set(fold(text).split()) if len(w) > 1 for e in entries_of(w)}

    rate_a, rate_b = F.col("toxic") / size[1], F.col("clean") / size[0]
    # few keys stand in a larger share of toxic texts: the exact test is made on the driver
    found = _counts(first, candidates, 2).filter((F.col("toxic") >= 2) & (rate_a > 3 * rate_b)) \
        .orderBy(F.desc(rate_a - rate_b), "key").limit(4 * ENTRIES).collect()
    a, b = (np.array([r[c] for r in found], float) for c in ("toxic", "clean"))
    sure = _signed_root(a, size[1], b, size[0])
    weight = (np.log((a + 0.5) / (size[1] - a + 0.5))
              - np.log((b + 0.5) / (size[0] - b + 0.5))).clip(0, HEAVIEST)
    best = sorted((k for k in range(len(found)) if sure[k] >= SURE), key=lambda k: -sure[k])[:ENTRIES]
    lexicon = Lexicon({found[k]["key"]: float(weight[k]) for k in best} | known)

    def around(text: str) -> set[str]:
        return phrases_around(fold(text), lexicon)

    phrases = _counts(first, around, 3).filter(F.col("toxic") * size[0] < F.col("clean") * size[1]) \
        .orderBy(F.desc("clean"), "key").limit(PHRASES).collect()
    lexicon.exceptions = tuple(r["key"] for r in phrases)
    # the curve: on the fold that the lexicon has not seen, if it has both classes
    final = Lexicon(lexicon.weights, lexicon.exceptions)

    def look(text: pa.Array) -> pa.Array:
        found = [final.measures(t) for part in slices(text) for t in texts(part)]
        return pa.array([list(x) for x in found], pa.list_(pa.float64()))

    seen = rows.select(arrow_udf(look, "array<double>")(F.col("text")).alias("x"), "y", "other").collect()
    use = [r for r in seen if r["other"]]
    if len({r["y"] for r in use}) < 2 or sum(r["y"] for r in use) < 20:
        use = seen
    use.sort(key=lambda r: (r["y"], r["x"]))
    x = np.array([r["x"] for r in use]).reshape(-1, 3)
    y = np.array([r["y"] for r in use], float)
    w = logistic(x, y, np.where(y == 1, 1 / share[1], 1 / share[0]), rounds=3000)
    final.curve = tuple(float(v) for v in w)
    return final


def score_column(lexicon: Lexicon):
    """Arrow UDF: text to score."""
    def run(text: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *[lexicon.score(texts(p)) for p in slices(text)]]))
    return arrow_udf(run, "double")


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = score_column(fit(docs, labels, ~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), s(F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
