"""BPE encoding and decoding by speculation and verification.

Every distinct word of a batch is first split greedily, by the longest token that
matches.  A split is what exact merging would give if and only if every token
encodes to itself and no merge would ever cross the border of two neighbours.
That is tested for all adjacent pairs of all words at once, with numpy: each pair
is unmerged backwards in time, and a merge across the border that ranks before
the end of the state at hand refutes it.  Only words with a refuted pair are
merged exactly.

The vocabulary is a tokenizer file of the byte-level kind (vocabulary, merges,
added tokens); its path is a parameter and each Python worker reads it once.
Words already encoded are remembered in two generations of at most REMEMBERED words
(and a batch's) a worker: when the younger is full it becomes the older, and words
that are still met move on.

Edge cases: a null text is empty; an empty text has no token; added tokens in a
text become their id, as the tokenizers library does; a very long word costs time
in proportion to its length (times its logarithm where it is merged exactly);
repeated rows give repeated rows; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanpulse.llm.common import arrow_udf
from chanpulse.llm.textarrays import slices, texts

FILE = "byte_bpe_50k.json"
REMEMBERED = 150_000
#: Text bytes whose new words are encoded together.
BATCH_BYTES = 1 << 21
#: Longer words aren't remembered.
LONGEST_REMEMBERED = 64
#: Words of up to so many bytes are merged without a heap.
SHORT = 24
NEVER = np.int64(1) << 40
# fixed values: the pattern of byte-level pre-tokenization, with \s as Unicode's White_Space
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# the same for texts of ASCII alone, which need no tables of letters
ASCII_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
                 r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(FILE)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and added tokens of one file, as tables."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        if model.get("type", "BPE") != "BPE" or kind != "ByteLevel" or spec.get("normalizer") \
                or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only plain byte-level BPE files are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take white space aren't supported")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = {as_bytes(s): i for s, i in model["vocab"].items() if s not in self.added}
        self.ids = vocab
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token: list[bytes] = [b""] * size
        for s, i in vocab.items():
            self.token[i] = s
        for s, i in self.added.items():
            self.token[i] = s.encode()
        self.prefixes = {s[:k] for s in vocab for k in range(1, len(s) + 1)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[as_bytes(a)] for a, _ in pairs], np.int64)
        right = np.array([vocab[as_bytes(b)] for _, b in pairs], np.int64)
        made = np.array([vocab[as_bytes(a + b)] for a, b in pairs], np.int64)
        rank = np.arange(len(pairs))
        self.size = size
        self.merges = {(int(a), int(b)): (k, int(c))
                       for k, (a, b, c) in enumerate(zip(left, right, made, strict=True))}
        order = np.argsort(left * size + right)
        self.pair_keys, self.pair_ranks = (left * size + right)[order], rank[order]
        #: when a token is made, and of what; a single byte is there from the start (-1)
        self.when = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.when[made[::-1]] = rank[::-1]
        self.left[made[::-1]], self.right[made[::-1]] = left[::-1], right[::-1]
        once = np.bincount(made, minlength=size) == 1
        whole = self.compatible(left, right, rank)
        #: tokens that encode to themselves (those that two merges make are left to merging)
        self.sound = np.array([len(t) == 1 for t in self.token])
        for k, (a, b, c) in enumerate(zip(left, right, made, strict=True)):
            if once[c]:
                self.sound[c] = whole[k] and self.sound[a] and self.sound[b]
        special = "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True))
        self.special = regex.compile(f"({special})") if special else None
        every, plain = regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN).findall
        self.words = lambda text: plain(text) if text.isascii() else every(text)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until=None) -> np.ndarray:
        """Whether no merge crosses the border of each pair (before rank ``until``)."""
        fine = np.ones(len(a), bool)
        where = np.arange(len(a))
        x, y = a.copy(), b.copy()
        end = np.full(len(a), NEVER) if until is None else until.astype(np.int64)
        while len(where):
            crossed = self.rank_of(x, y) < end
            fine[where[crossed]] = False
            made_x, made_y = self.when[x], self.when[y]
            go = ~crossed & (np.maximum(made_x, made_y) >= 0)
            where, x, y, made_x, made_y = where[go], x[go], y[go], made_x[go], made_y[go]
            # the later of the two came last: undo it.  At equal ranks the left one merges
            # first, so a merge over the border wins against one to its right.
            undo_x = made_x > made_y
            end = np.where(undo_x, made_x, made_y + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return fine

    def propose(self, word: bytes) -> list[int]:
        """Greedy split by the longest token."""
        out, i, n = [], 0, len(word)
        prefixes, ids = self.prefixes, self.ids
        while i < n:
            j, best, end = i + 1, None, i + 1
            while j <= n and (piece := word[i:j]) in prefixes:
                if piece in ids:
                    best, end = ids[piece], j
                j += 1
            if best is None:
                raise ValueError(f"no token for byte {word[i]}")
            out.append(best)
            i = end
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, the leftmost of equals."""
        parts = [self.ids[word[k:k + 1]] for k in range(len(word))]
        n = len(parts)
        if n <= SHORT:
            return self._merge_short(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], k, parts[k], parts[k + 1]) for k in range(n - 1)
                if (m := self.merges.get((parts[k], parts[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k] if parts[k] == a else n
            if j >= n or parts[j] != b:
                continue
            parts[k], parts[j] = self.merges[a, b][1], -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if m := self.merges.get((parts[k], parts[after[k]])):
                    heapq.heappush(heap, (m[0], k, parts[k], parts[after[k]]))
            if before[k] >= 0 and (m := self.merges.get((parts[before[k]], parts[k]))):
                heapq.heappush(heap, (m[0], before[k], parts[before[k]], parts[k]))
        return [p for p in parts if p >= 0]

    def _merge_short(self, parts: list[int]) -> list[int]:
        """Exact merging by looking at all pairs each time, which is faster for few."""
        merges, last = self.merges, (int(NEVER), -1)
        found = [merges.get(p, last) for p in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best is last:
                break
            k = found.index(best)
            parts[k:k + 2] = [best[1]]
            del found[k]
            if k:
                found[k - 1] = merges.get((parts[k - 1], parts[k]), last)
            if k < len(found):
                found[k] = merges.get((parts[k], parts[k + 1]), last)
        return parts

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Ids of each word, and how many words had to be merged exactly."""
        out = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter((t for ids in out for t in ids), np.int64, int(lengths.sum()))
        word = np.repeat(np.arange(len(out)), lengths)
        failed = np.zeros(len(out), bool)
        failed[word[~self.sound[flat]]] = True
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size)[back]
        failed[word[inner[~fine]]] = True
        for k in np.flatnonzero(failed):
            out[k] = self.merge(words[k])
        return out, int(failed.sum())


class Encoder:
    """Encodes texts, remembering words."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, values: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        v, known, older = self.vocab, self.known, self.older
        split = []
        for text in values:
            if v.special is not None and any(s in text for s in v.added):
                split.append([w for k, piece in enumerate(v.special.split(text))
                              for w in ([v.added[piece]] if k % 2 else v.words(piece))])
            else:
                split.append(v.words(text))
        new = set().union(*split).difference(known)
        here: dict = {i: np.array([i], "<u4").tobytes() for i in v.added.values() if i in new}
        known.update((w, older[w]) for w in new if w in older)
        new = [w for w in new if w not in known and not isinstance(w, int)]
        ids, _ = v.encode_words([w.encode("utf-8") for w in new])
        for w, found in zip(new, ids, strict=True):
            (known if len(w) <= LONGEST_REMEMBERED else here)[w] = np.array(found, "<u4").tobytes()
        if not here:
            return [b"".join(map(known.__getitem__, words)) for words in split]
        return [b"".join([known[w] if w in known else here[w] for w in words]) for words in split]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that aren't UTF-8 become replacement characters."""
        return b"".join(map(self.vocab.token.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_column(path: str):
    """Arrow UDF: text to its ids (array of int)."""
    def run(text: pa.Array) -> pa.Array:
        parts = []
        for part in slices(text, BATCH_BYTES):
            found = [np.frombuffer(b, "<u4").astype(np.int32) for b in encoder(path).encode(texts(part))]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, np.int32)]))))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
    return arrow_udf(run, "array<int>")


def decode_column(path: str):
    """Arrow UDF: ids to their text; null stays null."""
    def run(ids: pa.Array) -> pa.Array:
        return pa.array([None if x is None else encoder(path).decode(x) for x in ids.to_pylist()],
                        pa.string())
    return arrow_udf(run, "string")


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoded(path: str, with_ids: bool):
    def run(text: pa.Array) -> pa.Array:
        counts, ids_sha, text_sha, raws = [], [], [], []
        for part in slices(text, BATCH_BYTES):
            e = encoder(path)
            for raw in e.encode(texts(part)):
                ids = np.frombuffer(raw, "<u4")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(e.decode(ids.tolist()).encode()).hexdigest())
                if with_ids:
                    raws.append(raw)
        columns = [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                   pa.array(text_sha, pa.string())]
        names = ["n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            columns.append(pa.ListArray.from_arrays(
                ends, pa.array(np.frombuffer(b"".join(raws), "<i4"))))
            names.append("ids")
        return pa.StructArray.from_arrays(columns, names)
    return run


def digest_column(path: str):
    """Arrow UDF: text to n_tokens and the digests of its ids and of their decoding.

    The ids stay in the worker: over a corpus they are larger than the text.
    """
    return arrow_udf(_encoded(path, False), DIGESTS)


def encoded_column(path: str):
    """Arrow UDF: like ``digest_column``, with the ids."""
    return arrow_udf(_encoded(path, True), f"{DIGESTS}, ids array<int>")


def op2(docs: DataFrame, path: str | None = None) -> DataFrame:
    d = digest_column(path or default_path())
    return docs.select("doc_id", d(F.col("text")).alias("_d")).select("doc_id", "_d.*")
