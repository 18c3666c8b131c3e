"""Web archives (WARC 1.1): writing, index, and reading back.

``archive`` writes a record per page, one gzip member each, into archives of at
most FILE_BYTES or FILE_ROWS records; a task writes its own.  Of the pages with equal payloads
of at least REVISIT bytes, that with the largest page_id becomes the response; the
others revisit it and store no payload.

The index is built as an external merge.  Each archive is a capture run: its index
rows are sorted by (URL key, timestamp, page) where it is written.  The runs' rows are
dealt by ranges of that key, and each range merges the runs that reach into it by a
loser tree.  The result is the capture history: rows of a range lie in order, and
ranges follow each other.  The merge doesn't rely on the order in which a shuffle
delivers: what arrives is cut into ascending runs before it is merged.

The payloads that occur more than once are found on their digests alone.  While these are
at most REPEATED, they are broadcast, and no page moves; beyond that, pages large enough to be
revisits are joined by digest, where adaptive execution splits a digest that many share.

``read`` opens the archives at the index's offsets and parses the records.  A response's
payload is checked against its digest.  Revisits are followed: each kind of reference (record
id, digest, size) is looked up once among the responses, a reference that leads nowhere or to
another payload is an error, and so a revisit's size and digest are those of a payload that
was read.

Lost executors: an attempt writes to files with names of its own, and a file counts
only through index rows, which Spark commits once.  What an attempt that failed has
left is never read.  Archives go to the shared checkpoint folder unless a path is
given (a path without a scheme is of Spark's default file system); any file system that
pyarrow.fs can open by URI will do.

Edge cases: a null html is an empty payload; a null url gives the empty URL key; a null
page_id is smaller than any other, and comes back as null; rows that repeat the
response's page_id are responses, too; URLs are stored with spaces and controls
percent-encoded; a page longer than FILE_BYTES ends its archive; empty tables
give no record.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import urllib.parse
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanpulse.llm.common import map_in_arrow, materialise, parts_for, qualified
from chanpulse.session import scratch_path

REVISIT = 1_000
#: Bytes and records of an archive: what a task writes, and what it holds of the index.
FILE_BYTES, FILE_ROWS = 128 << 20, 100_000
ROWS_PER_RANGE = 100_000
#: Repeated payloads (about 100 bytes each) that are broadcast, at most.
REPEATED = 200_000
#: Archive bytes that are read in a row, and by a task, about.
SPOT_BYTES, TASK_BYTES = 1 << 20, 8 << 20
#: Where no capture time is given: this moment (2024-01-01) plus page_id seconds, within a year.
EPOCH, YEAR = 1_704_067_200, 31_536_000
# fixed value: the profile that WARC 1.1 names for revisits by payload digest
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("urlkey string, ts long, page_id long, file string, offset long, length long, "
         "record_type string")


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: sorts a site's pages together."""
    url = (url or "").strip()
    try:
        u = urllib.parse.urlsplit(url)
        host, port = u.hostname, u.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host.lower())
    default = {"http": 80, "https": 443}.get(u.scheme)
    tail = f":{port}" if port and port != default else ""
    query = f"?{u.query}" if u.query else ""
    return f"{','.join(reversed(host.split('.')))}{tail}){u.path or '/'}{query}"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def stamp(ts: int) -> str:
    import datetime
    return datetime.datetime.fromtimestamp(ts, datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id, url, ts: int, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One WARC record; ``refers_to``: the response's page, as (page_id,), for a revisit
    (whose payload of ``size`` bytes isn't stored)."""
    http = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n".encode()]
    if refers_to is None:
        http.append(payload)
    block = b"".join(http)
    target = urllib.parse.quote(url or "", safe="".join(map(chr, range(0x21, 0x7F)))) \
        or f"urn:page:{page_id}"
    own = record_id(page_id, digest) if refers_to is None \
        else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'revisit:{page_id}:{digest}:{url}')}>"
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": own,
            "WARC-Date": stamp(ts), "WARC-Target-URI": target,
            "Content-Type": "application/http;msgtype=response",
            "WARC-Payload-Digest": f"sha1:{sha1}", "Page-Payload-Length": str(size)}
    if page_id is not None:
        head["Page-Id"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to[0], digest),
                 "Page-Refers-To": str(refers_to[0])}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record is cut off")
    return fields, block.partition(b"\r\n\r\n")[2]


def write_runs(rows: DataFrame, path: str, file_bytes: int = FILE_BYTES,
               file_rows: int = FILE_ROWS) -> DataFrame:
    """Archives below ``path``; an index row per record, each archive's in order."""
    path = qualified(rows.sparkSession, path)

    def run(batches):
        fs, folder = pafs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        out = name = None
        index: list[tuple] = []
        at = 0

        def close():
            out.close()
            index.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, r[4]))
            columns = list(zip(*index, strict=True))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
                     pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [c.split()[0] for c in INDEX.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, ts, html, digest, latest, again, *size = (
                    batch.column(k)[i].as_py() for k in range(batch.num_columns))
                payload = (html or "").encode("utf-8")
                size = size[0] if size else len(payload)  # a revisit's html may be left out
                if out is not None and (at >= file_bytes or len(index) >= file_rows):
                    yield close()
                    out = None
                if out is None:
                    leaf = f"{uuid.uuid4().hex}.warc.gz"
                    name = f"{path.rstrip('/')}/{leaf}"  # the URI goes into the index
                    out = fs.open_output_stream(f"{folder}/{leaf}", compression=None)
                    index, at = [], 0
                packed = gzip.compress(
                    record(page_id, url, ts, payload, size, digest, (latest,) if again else None),
                    4, mtime=0)
                out.write(packed)
                index.append((url_key(url), ts, page_id, name, at, len(packed),
                              "revisit" if again else "response"))
                at += len(packed)
        if out is not None:
            yield close()

    return map_in_arrow(rows, run, INDEX)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, the winner goes on.

    Taking the winner replays only the matches on its path: log2(k) comparisons a row.
    """

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        self.winner = self._play(1) if self.k else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.k) // 2
            while node >= 1:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merged(index: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Capture histories: index rows by ranges of (URL key, timestamp, page), in order."""
    def run(batches):
        runs: list[list] = []
        for batch in batches:
            rows = list(zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)],
                            strict=True))
            for r in rows:
                key = (r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4])
                if runs and runs[-1][-1][1][3] == r[3] and runs[-1][-1][0] <= key:
                    runs[-1].append((key, r))
                else:
                    runs.append([(key, r)])
        batch = []
        for _, r in LoserTree(runs):
            batch.append(r)
            if len(batch) == 10_000:
                yield pack(batch)
                batch = []
        if batch:
            yield pack(batch)

    def pack(rows):
        schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64())
                            for c in INDEX.split(", ")])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
            schema=schema)

    key = [F.col("urlkey"), F.col("ts"), F.col("page_id").asc_nulls_first(), F.col("file"),
           F.col("offset")]
    ranged = index.repartitionByRange(parts_for(index.count(), rows_per_range), *key)
    return map_in_arrow(ranged, run, INDEX)


def archive(pages: DataFrame, path: str | None = None, captured: Column | None = None,
            file_bytes: int = FILE_BYTES, file_rows: int = FILE_ROWS,
            repeated: int = REPEATED) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) and returns the capture histories."""
    spark = pages.sparkSession
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    ts = F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(YEAR)) \
        if captured is None else captured
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        ts.cast("long").alias("ts"), "html", F.sha1(body).alias("digest"),
                        F.octet_length(body).alias("size"))
    large = F.col("size") >= REVISIT
    same = rows.filter(large).groupBy("digest").agg(
        F.max("page_id").alias("latest"), F.count("*").alias("n")) \
        .filter(F.col("n") > 1).select("digest", "latest")
    same = materialise(spark, same, "warc-repeated")
    if same.count() <= repeated:
        rows = rows.join(F.broadcast(same), "digest", "left")
    else:
        none = rows.filter(~large).withColumn("latest", F.lit(None).cast("long"))
        rows = rows.filter(large).join(same.hint("merge"), "digest", "left").unionByName(none)
    again = F.col("latest").isNotNull() & ~F.col("latest").eqNullSafe(F.col("page_id"))
    rows = rows.select("page_id", "url", "ts", F.when(~again, F.col("html")).alias("html"),
                       "digest", "latest", again.alias("again"), "size")
    index = write_runs(rows, path or scratch_path(spark, "warc"), file_bytes, file_rows)
    return materialise(spark, merged(materialise(spark, index, "warc-runs")), "warc-index")


FOUND = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, own string, target string, payload binary")


def records(index: DataFrame, payloads: bool) -> DataFrame:
    """What stands in the archives at the index's places: FOUND, an own record id and the
    record that a revisit names; the payload of responses, if asked."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in FOUND.split(", ")])

    def run(batches):
        opened = name = None
        for batch in batches:
            out = []
            for file, offset, length in zip(*[batch.column(k).to_pylist() for k in range(3)],
                                            strict=True):
                if file != name:
                    if opened is not None:
                        opened.close()
                    fs, place = pafs.FileSystem.from_uri(file)
                    opened, name = fs.open_input_file(place), file
                head, payload = parse(gzip.decompress(opened.read_at(length, offset)))
                digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                size, kind = int(head["Page-Payload-Length"]), head["WARC-Type"]
                own, target = head["WARC-Record-ID"], head.get("WARC-Refers-To")
                if kind == "response" and (len(payload) != size
                                           or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"payload of {own} differs from its digest")
                page, ref = head.get("Page-Id"), head.get("Page-Refers-To")
                if target is not None and target != record_id(ref, digest):
                    raise ValueError(f"{own} names a record and a page that differ")
                out.append((page and int(page), size, digest, kind, ref and int(ref), own, target,
                            payload if payloads and kind == "response" else None))
            columns = list(zip(*out, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    # spots of an archive, dealt to as many tasks as the archives' bytes ask for (the
    # index rows themselves are small, and would all be read by one)
    size = index.agg(F.sum("length")).first()[0] or 0
    spot = F.floor(F.col("offset") / SPOT_BYTES)
    rows = index.select("file", "offset", "length", spot.alias("spot")) \
        .repartition(parts_for(size, TASK_BYTES), "file", "spot") \
        .sortWithinPartitions("file", "offset")
    return map_in_arrow(rows.select("file", "offset", "length"), run, FOUND)


def read(index: DataFrame, payloads: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record; with its
    html, if asked, which a revisit has from the response that it names."""
    spark = index.sparkSession
    found = materialise(spark, records(index, payloads), "warc-records")
    reference = ["target", "payload_digest", "payload_bytes"]
    revisit = F.col("record_type") == "revisit"
    wanted = found.filter(revisit).select(*reference).distinct()
    there = found.filter(~revisit).select(
        F.col("own").alias("target"), *reference[1:], "payload").dropDuplicates(["target"])
    lost = wanted.join(there.drop("payload"), reference, "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"a revisit refers to {lost[0]['target']}, which isn't a response "
                         "of its payload")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    if not payloads:
        return found.select(*names)
    shown = there.join(wanted, reference, "left_semi").select(
        "target", F.col("payload").alias("_shown"))
    return found.join(shown, "target", "left").select(
        *names, F.coalesce("payload", "_shown").alias("payload"))


def op4(pages: DataFrame) -> DataFrame:
    return read(archive(pages))
