"""Token ids in a binary file format: Simple-8b, word-aligned.

A 64-bit word holds a selector (the high four bits) and as many ids as fit the other 60 at
the selector's width.  Selectors 1 to 14 pack 60 ids of one bit down to one id of 60
(COUNTS, WIDTHS); selector 15 is the escape: one id that no width can hold, whose place in
the file's list of escapes is in the word; selector 0 stands for nothing, so zeroed bytes
are noticed.  The encoder takes, at each id, the selector that packs most.  The decoder needs
no loop over words: selectors give the counts, a running sum gives each word's place, and
all words of a selector are unpacked at once.

A file::

    b"S8BTOK1\\n"
    words       64-bit, little-endian
    escapes     64-bit
    blocks      per block: first word, ids             (64-bit each)
    documents   per document: id, 0 where the id is null, ids before it, first block
    trailer     numbers of words, escapes, blocks, documents, ids, ids a block; crc32 of all
                between magic and trailer; the same magic again

A block is at most BLOCK ids of one document and starts at a word of its own, so any document,
and any block of a long one, can be decoded without the words before it.

``write`` deals the documents by ranges of doc_id (rows of equal ids by their text, equal
rows by their place in the input, so one much repeated id fills several parts), encodes each
part in order, and closes a file at FILE_BYTES or FILE_DOCUMENTS.  The index has one row per
file; the running sum of ids over it gives each file's first id.  ``read`` opens the files
that an index names.

Tokens are what the tokenizers library gives.  Words of Latin-1 texts are split as the
file's own normalizer and pattern would, and each distinct word is given to the library once
(remembered in two generations of at most REMEMBERED words); any other text, one with an
added token, and any tokenizer file of another kind goes to the library whole.

Lost executors: an attempt writes to files with names of its own, and a file counts only
through index rows, which Spark commits once.  The crc32 of a file is checked when it is read.

Edge cases: a null text is empty (the end id alone); an empty text likewise; a very long text
is encoded in one piece and its ids stand in several blocks; rows that repeat a doc_id stand
side by side; null ids come first; equal rows are separate documents; an empty table writes
no file and reads back as no row; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import map_in_arrow, materialise, parts_for, qualified, text_or_empty
from chanpulse.llm.textarrays import slices, texts
from chanpulse.session import scratch_path

FILE = "word_bpe_49k.json"
#: What the query puts after each document.
END_ID = 2
# fixed values: widths and counts of the selectors 1 to 14
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
LANES = 60
MAGIC = b"S8BTOK1\n"
TRAILER = struct.Struct("<7Q")
BLOCK = 1_024
FILE_BYTES, FILE_DOCUMENTS = 64 << 20, 1_000_000
#: Text bytes of a part, and of what is encoded at once; words that are decoded at once.
PART_BYTES, BATCH_BYTES, SLICE_WORDS = 32 << 20, 1 << 20, 1 << 17
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64
#: New words that the library gets at once, as one text.
WORDS_AT_ONCE = 1_000
INDEX = "part long, number long, file string, documents long, ids long, bytes long"

# fixed values: the normalizer and the pattern of the word-level tokenizer file
NORMALIZERS = ("NFC", "Replace", "Lowercase")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same pattern for lower-case texts of Latin-1, with their letters, digits and spaces
_L, _N, _S = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(FILE)


# -- coding -------------------------------------------------------------------------

def pack(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the blocks laid end to end in ``ids`` (of ``sizes`` ids each), the number of
    words of each block, and the escaped ids; escapes are numbered from 0."""
    ids = ids.astype(np.uint64, copy=False)
    blocks = len(sizes)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(blocks, np.int64), np.zeros(0, np.uint64)
    # each block with room for a last word that isn't full: zeros, which fit any width
    room = np.zeros(blocks + 1, np.int64)
    np.cumsum(sizes + LANES, out=room[1:])
    into = np.arange(len(ids)) + np.repeat(LANES * np.arange(blocks), sizes)
    padded = np.zeros(room[-1], np.uint64)
    padded[into] = ids
    limits = np.array([(1 << w) - 1 for w in WIDTHS], np.uint64)
    kind = np.searchsorted(limits, padded).astype(np.uint8)  # 14: no width holds it
    # the widest id of each window: from windows of powers of two
    spans, size = {1: kind}, 1
    while 2 * size <= LANES:
        wider = spans[size].copy()
        np.maximum(wider[:-size], spans[size][size:], out=wider[:-size])
        spans[2 * size] = wider
        size *= 2
    choice = np.full(len(padded), len(WIDTHS), np.uint8)
    for k in range(len(WIDTHS) - 1, -1, -1):
        half = 1 << (COUNTS[k].bit_length() - 1)
        widest, rest = spans[half], COUNTS[k] - half
        if rest:
            widest = widest.copy()
            np.maximum(widest[:-rest], spans[half][rest:], out=widest[:-rest])
        choice[widest <= k] = k
    # all blocks advance by a word at a time
    step = np.array([*COUNTS, 1], np.int64)
    at, end = room[:-1].copy(), room[:-1] + sizes
    live = np.flatnonzero(at < end)
    spots, owners, turns, turn = [], [], [], 0
    while len(live):
        spots.append(at[live])
        owners.append(live)
        turns.append(np.full(len(live), turn))
        at[live] += step[choice[at[live]]]
        live = live[at[live] < end[live]]
        turn += 1
    spot, owner, turns = (np.concatenate(x) for x in (spots, owners, turns))
    counts = np.bincount(owner, minlength=blocks)
    first = np.cumsum(counts) - counts
    ordered = np.empty(len(spot), np.int64)
    ordered[first[owner] + turns] = spot
    picked = choice[ordered]
    words = np.empty(len(ordered), np.uint64)
    for k in np.unique(picked):
        which = np.flatnonzero(picked == k)
        if k == len(WIDTHS):
            words[which] = np.arange(len(which), dtype=np.uint64) \
                | (np.uint64(ESCAPE) << np.uint64(60))
            continue
        lanes = np.arange(COUNTS[k])
        values = padded[ordered[which][:, None] + lanes] << (lanes * WIDTHS[k]).astype(np.uint64)
        words[which] = np.bitwise_or.reduce(values, axis=1) | (np.uint64(k + 1) << np.uint64(60))
    return words, counts, padded[ordered[picked == len(WIDTHS)]]


def unpack(words: np.ndarray, first: np.ndarray, sizes: np.ndarray,
           escapes: np.ndarray) -> np.ndarray:
    """Ids of neighbouring blocks: ``first`` word of each (from 0) and its number of ids."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    held = np.array([0, *COUNTS, 1], np.int64)[selector]
    if (selector == 0).any():
        raise ValueError("a word without a selector")
    place = np.cumsum(held) - held
    out = np.zeros(int(held.sum()), np.uint64)
    body = words & np.uint64((1 << 60) - 1)
    for k in np.unique(selector):
        which = np.flatnonzero(selector == k)
        if k == ESCAPE:
            out[place[which]] = escapes[body[which].astype(np.int64)]
            continue
        lanes = np.arange(COUNTS[k - 1])
        values = body[which][:, None] >> (lanes * WIDTHS[k - 1]).astype(np.uint64)
        out[place[which][:, None] + lanes] = values & np.uint64((1 << WIDTHS[k - 1]) - 1)
    # the last word of a block may hold more than the block has ids
    start = place[first] if len(words) else np.zeros(0, np.int64)
    lead = np.cumsum(sizes) - sizes
    return out[np.repeat(start - lead, sizes) + np.arange(int(sizes.sum()))]


def cut(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of documents with ``sizes`` ids (none for an empty one): ids of each block, and
    each document's first block."""
    full = -(-sizes // block)
    out = np.full(int(full.sum()), block, np.int64)
    last = np.cumsum(full)
    some = sizes > 0
    out[last[some] - 1] = (sizes - block * (full - 1))[some]
    return out, last - full


# -- tokens -------------------------------------------------------------------------

class Encoder:
    """Texts to ids (little-endian unsigned 32-bit), as the tokenizers library gives them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers") or []
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.by_word = (tuple(s["type"] for s in steps) == NORMALIZERS
                        and split.get("pattern") == {"Regex": SPLIT} and split.get("invert") is True
                        and split.get("behavior") == "Removed" and not spec.get("post_processor")
                        and not spec["model"].get("dropout"))
        suffix = spec["model"].get("end_of_word_suffix")
        self.last = np.zeros(self.library.get_vocab_size(), bool)  # tokens that end a word
        self.last[[i for t, i in spec["model"]["vocab"].items() if suffix and t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, values: list[str]) -> list[bytes]:
        # never cut or filled up, whatever the file says of truncation and padding
        self.library.no_truncation()
        self.library.no_padding()
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.library.encode_batch_fast(values, add_special_tokens=False)]

    def words(self, values: list[str]) -> list[bytes]:
        """Ids of single words: they are given as texts of many, and cut after each token
        that ends a word."""
        out: list[bytes] = []
        for k in range(0, len(values), WORDS_AT_ONCE):
            some = values[k:k + WORDS_AT_ONCE]
            raw, = self.whole([" ".join(some)])
            ends = 4 * np.flatnonzero(self.last[np.frombuffer(raw, "<u4")]) + 4
            if len(ends) == len(some) and ends[-1] == len(raw):
                bounds = [0, *ends.tolist()]
                out += [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            else:  # a vocabulary without ends of words
                out += self.whole(some)
        return out

    def _plain(self, text: str) -> bool:
        if not self.by_word or any(s in text for s in self.added):
            return False
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def encode(self, values: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        split = [LATIN.findall(v.lower()) if self._plain(v) else None for v in values]
        new = set().union(*[w for w in split if w is not None]).difference(known)
        known.update((w, older[w]) for w in new if w in older)
        new = [w for w in new if w not in known]
        here = dict(zip(new, self.words(new), strict=True))
        known.update((w, ids) for w, ids in here.items() if len(w) <= LONGEST_REMEMBERED)
        long = {w: ids for w, ids in here.items() if len(w) > LONGEST_REMEMBERED}
        rest = iter(self.whole([v for v, w in zip(values, split, strict=True) if w is None]))
        find = (lambda w: known.get(w) or long.get(w, b"")) if long else known.__getitem__
        return [next(rest) if words is None else b"".join(map(find, words)) for words in split]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# -- files --------------------------------------------------------------------------

class Writer:
    """One file; documents in the order they come."""

    def __init__(self, folder: str, block: int):
        self.file = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.s8b"
        fs, place = pafs.FileSystem.from_uri(self.file)
        fs.create_dir(os.path.dirname(place), recursive=True)
        self.out = fs.open_output_stream(place, compression=None)
        self.out.write(MAGIC)
        self.block, self.crc = block, 0
        self.words = self.ids = self.docs = 0
        self.blocks: list[np.ndarray] = []
        self.documents: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        self.escaped = self.n_blocks = 0

    def _put(self, array: np.ndarray) -> None:
        raw = np.ascontiguousarray(array).astype("<u8", copy=False).tobytes()
        self.crc = zlib.crc32(raw, self.crc)
        self.out.write(raw)

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents whose ids lie end to end."""
        per_block, first_block = cut(sizes, self.block)
        words, counts, escapes = pack(ids, per_block)
        if len(escapes):
            escaped = words >> np.uint64(60) == ESCAPE
            words[escaped] += np.uint64(self.escaped)
        self._put(words)
        self.blocks.append(np.stack([self.words + np.cumsum(counts) - counts, per_block], axis=1))
        before = self.ids + np.cumsum(sizes) - sizes
        self.documents.append(np.stack([
            np.array([d or 0 for d in doc_ids], np.int64),
            np.array([d is not None for d in doc_ids], np.int64),
            before, self.n_blocks + first_block], axis=1))
        self.escapes.append(escapes)
        self.words += len(words)
        self.ids += len(ids)
        self.docs += len(doc_ids)
        self.escaped += len(escapes)
        self.n_blocks += len(per_block)

    def close(self) -> tuple[str, int, int, int]:
        """Path, documents, ids and bytes."""
        for table in (self.escapes, self.blocks, self.documents):
            for part in table:
                self._put(part)
        self.out.write(TRAILER.pack(self.words, self.escaped, self.n_blocks, self.docs, self.ids,
                                    self.block, self.crc) + MAGIC)
        size = self.out.tell()
        self.out.close()
        return self.file, self.docs, self.ids, size


class Reader:
    """One file: its tables are read at once, its words as asked for."""

    def __init__(self, file: str):
        fs, place = pafs.FileSystem.from_uri(file)
        self.src = fs.open_input_file(place)
        size, tail = self.src.size(), TRAILER.size + len(MAGIC)
        end = self.src.read_at(tail, size - tail) if size >= tail + len(MAGIC) else b""
        if end[TRAILER.size:] != MAGIC or self.src.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{file} is no complete token file")
        self.words, n_escapes, n_blocks, n_docs, self.ids, self.block, self.crc = \
            TRAILER.unpack(end[:TRAILER.size])
        at = len(MAGIC) + 8 * self.words
        self.body = at + 8 * (n_escapes + 2 * n_blocks + 4 * n_docs)
        if self.body != size - tail:
            raise ValueError(f"{file}: its tables don't add up")
        self.escapes = self._array(at, n_escapes)
        at += 8 * n_escapes
        self.blocks = self._array(at, 2 * n_blocks).astype(np.int64).reshape(-1, 2)
        at += 16 * n_blocks
        self.documents = self._array(at, 4 * n_docs).view("<i8").reshape(-1, 4)

    def _array(self, at: int, n: int) -> np.ndarray:
        return np.frombuffer(self.src.read_at(8 * n, at), "<u8")

    def check(self) -> None:
        """The whole body against its crc32."""
        crc, at = 0, len(MAGIC)
        while at < self.body:
            piece = self.src.read_at(min(1 << 22, self.body - at), at)
            crc, at = zlib.crc32(piece, crc), at + len(piece)
        if crc != self.crc:
            raise ValueError("a token file differs from its crc32")

    def decode(self, first_block: int, last_block: int) -> np.ndarray:
        """Ids of blocks ``first_block`` up to ``last_block`` (excluded)."""
        if first_block == last_block:
            return np.zeros(0, np.uint64)
        rows = self.blocks[first_block:last_block]
        start = rows[0, 0]
        stop = self.blocks[last_block, 0] if last_block < len(self.blocks) else self.words
        words = self._array(len(MAGIC) + 8 * int(start), int(stop - start))
        return unpack(words, rows[:, 0] - start, rows[:, 1], self.escapes)

    def runs(self, slice_words: int):
        """Documents in runs of about so many words: rows of the table, ids, sizes."""
        n = len(self.documents)
        block = np.append(self.documents[:, 3], len(self.blocks))
        starts = np.append(self.documents[:, 2], self.ids)
        word = np.append(self.blocks[:, 0], self.words)[block]
        k = 0
        while k < n:
            j = int(np.searchsorted(word, word[k] + slice_words, side="right")) - 1
            j = min(max(j, k + 1), k + slice_words, n)
            yield self.documents[k:j], self.decode(block[k], block[j]), np.diff(starts[k:j + 1])
            k = j


def write(docs: DataFrame, path: str | None = None, tokenizer: str | None = None,
          end_id: int | None = END_ID, block: int = BLOCK, file_bytes: int = FILE_BYTES,
          file_documents: int = FILE_DOCUMENTS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``path`` (by default the shared
    checkpoint folder), in ascending doc_id order; returns the index, a row per file."""
    spark = docs.sparkSession
    folder = qualified(spark, path or scratch_path(spark, "tokens"))
    tokenizer = tokenizer or default_path()
    tail = np.array([] if end_id is None else [end_id], "<u4").tobytes()

    def run(batches):
        part, number, out = TaskContext.get().partitionId(), 0, None

        def closed():
            row = (part, number, *out.close())
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in row], [c.split()[0] for c in INDEX.split(", ")])

        for batch in batches:
            done = 0
            for piece in slices(batch.column(1), BATCH_BYTES):
                doc_ids = batch.column(0).slice(done, len(piece)).to_pylist()
                done += len(piece)
                found = [ids + tail for ids in encoder(tokenizer).encode(texts(piece))]
                sizes = np.fromiter((len(x) >> 2 for x in found), np.int64, len(found))
                if out is None:
                    out = Writer(folder, block)
                out.add(doc_ids, np.frombuffer(b"".join(found), "<u4"), sizes)
                if 8 * out.words >= file_bytes or out.docs >= file_documents:
                    yield closed()
                    number, out = number + 1, None
        if out is not None:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    keys = ["doc_id", "_text", "_row"]
    rows = rows.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), *keys[1:]]
    rows = rows.repartitionByRange(parts_for(size, part_bytes), *order).sortWithinPartitions(*order)
    return materialise(spark, map_in_arrow(rows.select("doc_id", "text"), run, INDEX),
                       "token-files")


def placed(index: DataFrame) -> DataFrame:
    """The index with the ids before each file, ``start``: a running sum over parts (one row
    each) and over the files of a part."""
    parts = index.groupBy("part").agg(F.sum("ids").alias("_ids")).select(
        "part", (F.sum("_ids").over(Window.orderBy("part")) - F.col("_ids")).alias("_before"))
    files = Window.partitionBy("part").orderBy("number")
    return index.join(parts, "part").withColumn(
        "start", F.col("_before") + F.sum("ids").over(files) - F.col("ids")).drop("_before")


def read(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers) of each document of the files that ``index`` names; its ids, if asked."""
    def run(batches):
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    strict=True):
                reader = Reader(file)
                reader.check()
                for rows, ids, sizes in reader.runs(SLICE_WORDS):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    ends = 4 * np.cumsum(sizes)
                    crcs = [zlib.crc32(raw[a:b]) for a, b in
                            zip((ends - 4 * sizes).tolist(), ends.tolist(), strict=True)]
                    columns = [pa.array(rows[:, 0], pa.int64(), mask=rows[:, 1] == 0),
                               pa.array(rows[:, 2] + before, pa.int64()),
                               pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(
                            pa.array(at), pa.array(ids.astype(np.int64))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    files = placed(index).select("file", "start")
    # a task for each file, about: the index itself is small and would be read by one
    files = files.repartition(max(1, index.count()))
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return map_in_arrow(files, run, kind + (", ids array<long>" if with_ids else ""))


def op12(docs: DataFrame) -> DataFrame:
    return read(write(docs))
