"""Periodic runs of words, by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, 8, ... words.  Each level names
the equal ones of a document with the same number: a factor of 2^(k+1) words is a pair of
names of level k.  A factor that occurs once takes no part in any higher level, so levels
after the first hold repeated passages alone.

At level k, an occurrence whose successor (the next occurrence of the same factor in the
document) begins d words later, with 2^(k-1) < d <= 2^k, overlaps or touches it, and so
proposes the period d; occurrences i, i + d, i + 2d, ... form an arithmetic progression,
and neighbouring positions with the same d belong to the same run.  One proposal of each such
stretch is extended in both directions by comparing names, from the longest level to the
shortest, and equal results are one run.  This finds every run of three periods or more: with
2^(k-1) < q <= 2^k, the first factor of a run of period q recurs q words later inside the
run, and no sooner, since its first q words are primitive.  For the same reason a proposed
period is the smallest of its stretch.

Documents are handled in slices of bounded text inside a task; there is no shuffle.

Edge cases: a null or empty text, or one without words, has no run; a null doc_id is never
changed (see ``modified``); a very long text takes memory in proportion to its words (and to
its repeated factors, level by level); repeated rows give repeated rows; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanpulse.llm.common import arrow_udf
from chanpulse.llm.textarrays import slices, spans

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Text bytes whose words are named together.
BATCH_BYTES = 1 << 20
RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
RUNS = "array<struct<start:long,length:long,period:long>>"


class Factors:
    """Names of the basic factors of several documents' words, laid end to end.

    ``words``: a number for each word, different documents sharing none; ``ends``: for each
    position the end of its document.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.n, self.ends = len(words), ends
        #: for each level, the positions of the factors that recur, and their names (-1: once)
        self.names: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        counts = np.bincount(words) if self.n else np.zeros(0, np.int64)
        names = np.where(counts[words] > 1, words, -1).astype(np.int64)
        at = np.flatnonzero(names >= 0)
        while len(at):
            self.names.append(names)
            self.at.append(at)
            names, at = self._doubled(len(self.names) - 1)

    def _doubled(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the next level, for pairs of neighbouring factors that both recur."""
        names, at, size = self.names[level], self.at[level], 1 << level
        at = at[at + size < self.ends[at]]
        at = at[names[at + size] >= 0]
        pairs = names[at] * np.int64(self.n + 1) + names[at + size]
        _, found, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        again = counts[found] > 1
        at, found = at[again], found[again]
        out = np.full(self.n, -1, np.int64)
        out[at] = found
        return out, at

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Position and period of the first of each stretch of equal successor distances."""
        starts, periods = [], []
        for level, (names, at) in enumerate(zip(self.names, self.at, strict=True)):
            order = at[np.argsort(names[at], kind="stable")]  # by name, then position
            same = names[order[1:]] == names[order[:-1]]
            here, gap = order[:-1][same], (order[1:] - order[:-1])[same]
            near = (gap <= 1 << level) & (2 * gap > 1 << level)
            here, gap = here[near], gap[near]
            distance = np.zeros(self.n + 1, np.int64)
            distance[here + 1] = gap  # moved by one, so that position -1 reads as none
            first = distance[here] != gap
            starts.append(here[first])
            periods.append(gap[first])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *starts]), np.concatenate([none, *periods])

    def _same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the factors at a and b are equal; positions out of reach aren't."""
        names = self.names[level]
        inside = (a >= 0) & (b < self.n)
        x, y = names[np.where(inside, a, 0)], names[np.where(inside, b, 0)]
        return inside & (x >= 0) & (x == y)

    def extended(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretch around each position that keeps the period: start and length."""
        right, left = at.copy(), at.copy()
        for level in range(len(self.names) - 1, -1, -1):
            size = 1 << level
            right += size * self._same(level, right, right + period)
            left -= size * self._same(level, left - size, left - size + period)
        return left, right + period - left


def runs(words: np.ndarray, ends: np.ndarray, least_words: int = LEAST_WORDS,
         least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, by start, then period."""
    factors = Factors(words, ends)
    at, period = factors.proposals()
    start, length = factors.extended(at, period)
    fine = length >= np.maximum(least_words, least_periods * period)
    found = np.unique(np.stack([start[fine], period[fine], length[fine]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def numbered(docs: Iterable[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each word (documents share none), each position's end, documents' starts."""
    flat, sizes, base = [], [], 0
    for words in docs:
        known: dict = {}
        flat.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64,
                                len(words)) + base)
        sizes.append(len(words))
        base += len(known)
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    numbers = np.concatenate([np.zeros(0, np.int64), *flat])
    return numbers, np.repeat(bounds[1:], sizes), bounds


def runs_of(docs: list[list], **bounds) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document's words."""
    numbers, ends, at = numbered(docs)
    start, length, period = runs(numbers, ends, **bounds)
    doc = np.searchsorted(at, start, side="right") - 1
    out: list[list] = [[] for _ in docs]
    for d, s, n, q in zip(doc.tolist(), (start - at[doc]).tolist(), length.tolist(),
                          period.tolist(), strict=True):
        out[d].append((s, n, q))
    return out


def modified(doc_id: int | None, words: list) -> list:
    """The words as the query takes them: one document in ten, by crc32 of its id, repeats
    a passage up to its end."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    passage = words[a:a + p]
    return words[:a] + (passage * -(-(n - a) // p))[:n - a]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run holds after its first period, joined by a space."""
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep)])


def summary(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """A row of RESULT."""
    text = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = None
    for s, n, q in found:  # by start, then period, so of equals the first stays
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (len(found), *four, hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, found)).hexdigest())


def _split(part: pa.Array) -> list[list[bytes]]:
    body, at = spans(part)
    raw = body.tobytes()
    return [raw[a:b].split() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def runs_column(**bounds):
    """Arrow UDF: a text's runs, as an array of (start, length, period)."""
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(text: pa.Array) -> pa.Array:
        out = []
        for part in slices(text, BATCH_BYTES):
            out += [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found]
                    for found in runs_of(_split(part), **bounds)]
        return pa.array(out, kind)
    return arrow_udf(run, RUNS)


def collapsed_column(**bounds):
    """Arrow UDF: a text's words without the repeats of its runs, joined by a space."""
    def run(text: pa.Array) -> pa.Array:
        out = []
        for part in slices(text, BATCH_BYTES):
            docs = _split(part)
            out += [collapsed(w, f).decode("utf-8", "replace")
                    for w, f in zip(docs, runs_of(docs, **bounds), strict=True)]
        return pa.array(out, pa.string())
    return arrow_udf(run, "string")


def summary_column():
    """Arrow UDF: doc_id and text to a row of RESULT, of the modified words."""
    fields = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64())
              for c in RESULT.split(", ")]

    def run(doc_id: pa.Array, text: pa.Array) -> pa.Array:
        rows, done = [], 0
        for part in slices(text, BATCH_BYTES):
            ids = doc_id.slice(done, len(part)).to_pylist()
            done += len(part)
            docs = [modified(i, w) for i, w in zip(ids, _split(part), strict=True)]
            rows += [summary(w, f) for w, f in zip(docs, runs_of(docs), strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)],
            [name for name, _ in fields])
    return arrow_udf(run, RESULT)


def op13(docs: DataFrame) -> DataFrame:
    found = summary_column()(F.col("doc_id").cast("long"), F.col("text"))
    return docs.select("doc_id", found.alias("_r")).select("doc_id", "_r.*")
