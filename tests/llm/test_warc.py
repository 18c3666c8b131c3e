"""Operator 4: archives, index and histories against brute force."""

import gzip
import hashlib
import random

import pyarrow.fs as pafs
import pytest

from chanpulse.llm import warc

HTML = "<html>" + "p" * 2000 + "</html>"
ROWS = [(1, "http://www.A.example/x?b=1", HTML), (2, "https://a.example:443/x", HTML),
        (9, "http://b.example/", HTML), (3, "http://b.example/y", "short"), (4, None, "short"),
        (5, "http://b.example:8080/ü x\n", None), (6, "", ""), (None, "http://c.example/", HTML),
        (7, "http://[bad", "é" * 999 + "\r\n\r\n"), (8, "http://c.example/#f", "é" * 499),
        (10, "http://c.example/", "x\r\n\r\n" * 400), (11, "http://c.example/", "x\r\n\r\n" * 400),
        (11, "http://c.example/", "x\r\n\r\n" * 400), (12, "q", "z" * 1000), (13, "q", "z" * 999),
        (14, "q", "z" * 999), (15, "q", "z" * 1000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows],
                                 "page_id long, url string, html string, payload string, digest string")


def brute(rows):
    latest = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            latest[b] = max(i, latest.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ref = latest.get(b)
        again = ref is not None and ref != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response",
                    ref if again else None))
    return sorted(out, key=str)


def test_records_read_back(spark):
    got = sorted(map(tuple, warc.op4(frame(spark, ROWS)).collect()), key=str)
    assert got == brute(ROWS)
    assert warc.op4(frame(spark, ROWS).limit(0)).count() == 0


def test_payloads_round_trip_and_small_files(spark, tmp_dir):
    index = warc.archive(frame(spark, ROWS), tmp_dir, file_bytes=3000)
    assert index.select("file").distinct().count() > 2
    want = {i: (h or "").encode() for i, _, h in ROWS}
    for r in warc.read(index, payloads=True).collect():
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == want[r["page_id"]]


def test_payloads_of_revisits_come_from_the_response(spark):
    want = {i: (h or "").encode() for i, _, h in ROWS}
    got = warc.read(warc.archive(frame(spark, ROWS)), payloads=True).collect()
    assert len(got) == len(ROWS) and any(r["record_type"] == "revisit" for r in got)
    assert all(bytes(r["payload"]) == want[r["page_id"]] for r in got)


def test_joined_beyond_the_broadcast_bound(spark):
    got = warc.read(warc.archive(frame(spark, ROWS), repeated=0)).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_pages_are_not_moved_to_find_copies(spark):
    """A third of the pages are copies: their html stays where it is."""
    rows = [(k, f"http://a.example/{k}", HTML if k % 3 == 0 else f"{k}" * 600) for k in range(90)]
    seen = []
    whole = warc.write_runs

    def spy(df, *a, **kw):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df, *a, **kw)
    warc.write_runs = spy
    try:
        got = warc.op4(frame(spark, rows)).collect()
    finally:
        warc.write_runs = whole
    assert "Exchange hashpartitioning" not in seen[0] and "BroadcastHashJoin" in seen[0]
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_pages_close_archives(spark):
    rows = [(k, f"http://a.example/{k}", None) for k in range(100)]
    index = warc.archive(frame(spark, rows).coalesce(1), file_rows=30)
    counts = [r["count"] for r in index.groupBy("file").count().collect()]
    assert sorted(counts) == [10, 30, 30, 30]
    few = warc.archive(frame(spark, rows).coalesce(1), file_bytes=2_000)
    assert few.select("file").distinct().count() > 5


def test_revisits_are_followed(spark):
    """A reference to a record that isn't there is an error."""
    index = warc.archive(frame(spark, ROWS))
    assert warc.read(index).count() == len(ROWS)
    with pytest.raises(ValueError, match="isn't a response"):
        warc.read(index.filter("page_id is null or page_id <> 9"))


def test_a_path_without_a_scheme(spark, tmp_dir):
    from chanpulse.session import local_fs_path
    index = warc.archive(frame(spark, ROWS), local_fs_path(tmp_dir))
    assert all(r["file"].startswith("file:///") for r in index.collect())
    assert warc.read(index).count() == len(ROWS)


def test_archives_are_plain_gzip_members(spark, tmp_dir):
    index = warc.archive(frame(spark, ROWS), tmp_dir).collect()
    for name in {r["file"] for r in index}:
        fs, path = pafs.FileSystem.from_uri(name)
        raw = fs.open_input_file(path).read()
        records = gzip.decompress(raw).split(b"WARC/1.1\r\n")[1:]
        assert len(records) == sum(r["file"] == name for r in index)
        assert all(r.endswith(b"\r\n\r\n") for r in records)
        assert len(raw) == sum(r["length"] for r in index if r["file"] == name)


@pytest.mark.parametrize("per_range", [2, 1000])
def test_history_is_in_global_order(spark, per_range):
    rng = random.Random(1)
    rows = [(k, f"http://h{rng.randrange(9)}.example/{rng.randrange(4)}", f"t{k}") for k in range(200)]
    index = warc.write_runs(frame(spark, rows).selectExpr(
        "page_id", "url", "page_id * 7 % 50 ts", "html", "sha1(html) digest", "0L latest",
        "false again").repartition(6), warc.scratch_path(spark, "test-warc"))
    merged = warc.merged(index, per_range)
    parts = merged.rdd.glom().collect()
    flat = [(r["urlkey"], r["ts"], r["page_id"]) for p in parts for r in p]
    assert flat == sorted((warc.url_key(u), k * 7 % 50, k) for k, u, _ in rows)
    assert per_range == 1000 or sum(bool(p) for p in parts) > 1


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(40),) for _ in range(rng.randrange(30))) for _ in range(k)]
    assert list(warc.LoserTree([[(x, None) for x in r] for r in runs])) == \
        [(x, None) for x in sorted(x for r in runs for x in r)]


def test_url_keys():
    assert warc.url_key("HTTP://WWW.Example.COM:80/A?b=C#d") == "com,example)/A?b=C"
    assert warc.url_key("https://x.example:8443") == "example,x:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("not a url") == "not a url"
