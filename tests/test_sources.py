import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from chanpulse.functions.derive import as_of_literal
from chanpulse.session import local_fs_path
from chanpulse.sources import api_json, csv, fs, parquet, snapshots

NOW = dt.datetime(2025, 11, 6)


def write_text(path, text):
    p = local_fs_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)


# fixed value: the header of a video snapshot
VIDEO_HEADER = "video_id,title,publish_time,views,likes,comments,engagement_rate,publish_day,publish_hour\n"


def test_videos_csv_quotes_bigint_and_rejects(spark, tmp_dir):
    p = f"{tmp_dir}/videos_20251105_195805.csv"
    write_text(p, VIDEO_HEADER
               + 'v1,"A, quoted ""x""",2021-03-14T04:30:15+00:00,3000000000,7000,500,'
                 '0.0000025,Saturday,0\n'
               + "bad1,B,not-a-time,1,0,0,0.0,Monday,1\n"
               + "bad2,B,2022-09-25T00:00:00Z,abc,0,0,0.0,Monday,1\n"
               + "short1,C,2022-09-25T00:00:00Z\n")
    loaded = csv.load_videos(spark, p, as_of_literal(NOW))
    rows = {r.video_id: r for r in loaded.rows.collect()}
    assert set(rows) == {"v1"}
    a = rows["v1"]
    assert a.title == 'A, quoted "x"' and a.views == 3000000000 and a.likes == 7000
    assert a.publish_day_of_week == 1 and a.publish_month == "2021-03"
    rej = {r.video_id: r for r in loaded.rejects.collect()}
    assert {k: r.reason for k, r in rej.items()} == {
        "bad1": "unreadable time", "bad2": "malformed record", "short1": "malformed record"}
    assert rej["bad1"].publish_time == "not-a-time" and rej["short1"].record.startswith("short1,C")


def test_channel_csv_write_keeps_microseconds(spark, tmp_dir):
    t = dt.datetime(2025, 11, 5, 19, 58, 4, 120431)
    ch = spark.createDataFrame([(t, "c1", "Teapot Club", 51300, 770042, 12)],
                               "captured_at timestamp, channel_id string, channel_title string, "
                               "subscribers long, total_views long, video_count int")
    vids = spark.createDataFrame([], "video_id string, title string, publish_time timestamp, "
                                     "views long, likes long, comments long, engagement_rate double, "
                                     "publish_day string, publish_hour int")
    cp, vp = csv.save_snapshots(ch, vids, tmp_dir, "20251105_195805")
    assert vp is None  # no videos, no file
    text = spark.read.text(cp).filter(~F.col("value").startswith("captured_at")).first()[0]
    assert text.startswith("2025-11-05T19:58:04.120431+00:00")
    back = csv.read_channel_csv(spark, cp).first()
    assert back.captured_at == t and back.subscribers == 51300


def test_snapshot_choice(spark, tmp_dir):
    for name in ["videos_20251105_190143.csv", "videos_20251105_195805.csv",
                 "top_videos_20251105_200000.csv", "channel_stats_20251105_195805.csv",
                 "videos_20251105_195805.csv.bak"]:
        write_text(f"{tmp_dir}/{name}", "x\n")
    got = snapshots.latest_snapshot(spark, tmp_dir, "videos")
    assert got.endswith("/videos_20251105_195805.csv")
    assert snapshots.latest_snapshot(spark, tmp_dir, "nothing") is None
    with pytest.raises(FileNotFoundError):
        snapshots.require_snapshot(spark, tmp_dir, "nothing")
    # equal mtimes: the newest name stamp wins under both policies
    for e in fs.list_dir(spark, tmp_dir):
        os.utime(local_fs_path(e.path), (1_700_000_000, 1_700_000_000))
    assert snapshots.latest_snapshot(spark, tmp_dir, "videos", policy="mtime").endswith(
        "videos_20251105_195805.csv")


def test_parquet_outputs_and_missing_entity(spark, tmp_dir):
    df = spark.range(3)
    paths = parquet.save_outputs({"videos": df, "top_videos": df.limit(1)}, tmp_dir, "20240101_000000")
    assert paths["videos"].endswith("videos_20240101_000000.parquet")
    ch, v = parquet.read_processed(spark, None, paths["videos"])
    assert ch is None and v.count() == 3


def landed(spark, tmp_dir, kind, lines):
    p = f"{tmp_dir}/{kind}/part-0.json"
    write_text(p, "\n".join(json.dumps(x) if not isinstance(x, str) else x for x in lines) + "\n")
    return api_json.read_landed(spark, f"{tmp_dir}/{kind}", kind)


def test_channel_reply(spark, tmp_dir):
    def reply(cid, time="2025-11-05T19:58:04.120431+00:00", title="Teapot Club", n="51300"):
        return {"channel_id": cid, "captured_at": time, "response": {"items": [
            {"snippet": {"title": title}, "statistics": {"subscriberCount": n, "viewCount": "770042"}}]}}

    r = api_json.channel_rows(landed(spark, tmp_dir, "channels", [reply("c1")])).first()
    assert (r.channel_title, r.subscribers, r.total_views, r.video_count) == ("Teapot Club", 51300,
                                                                             770042, 0)
    missing = {"channel_id": "c2", "captured_at": "2025-11-05T00:00:00Z", "response": {"items": []}}
    df = landed(spark, tmp_dir + "/m", "channels", [reply("c1"), missing])
    with pytest.raises(Exception, match="no channel for id c2"):  # raised by the plan itself
        api_json.channel_rows(df).collect()
    assert api_json.channel_rows(df, on_missing="drop").count() == 1
    df = landed(spark, tmp_dir + "/r", "channels", [
        reply("c1", None), reply("c2", "soon"), reply("c3", title=None), reply("c4", n="many"),
        {"channel_id": "c5", "captured_at": "2025-11-05T00:00:00Z", "response": None}, "{broken"])
    now = as_of_literal(NOW)
    parsed = api_json.channel_replies(df, captured_at=now)
    assert [(r.channel_id, r.captured_at) for r in parsed.rows.collect()] == [("c1", NOW)]
    assert sorted((r.channel_id or "", r.reason) for r in parsed.rejects.collect()) == [
        ("", "broken reply"), ("c2", "unreadable time"), ("c3", "no title"), ("c4", "bad counter"),
        ("c5", "broken reply")]


def test_video_reply_drop_and_reject(spark, tmp_dir):
    lines = [
        {"video_id": "v1", "response": {"items": [{"id": "v1", "snippet": {
            "title": "T", "publishedAt": "2021-03-14T05:07:09Z"},
            "statistics": {"viewCount": "100", "likeCount": "5"}}]}},
        {"video_id": "v2", "response": {"items": []}},
        {"video_id": "v3", "response": {"items": [{"id": "v3", "snippet": {
            "title": "U", "publishedAt": "yesterday"}, "statistics": {}}]}},
        {"video_id": "v4", "response": {"items": [{"id": "v4", "snippet": {
            "title": "U", "publishedAt": "2021-03-14T05:07:09Z"},
            "statistics": {"viewCount": "12x"}}]}},
        {"video_id": "v5", "response": {"items": [{"id": "v5", "snippet": {
            "publishedAt": "2021-03-14T05:07:09Z"}}]}},
        "{not json",
    ]
    parsed = api_json.video_rows(landed(spark, tmp_dir, "videos", lines))
    rows = parsed.rows.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.views, r.likes, r.comments, r.engagement_rate) == (100, 5, 0, 0.05)
    assert (r.publish_day, r.publish_hour) == ("Sunday", 5)
    assert sorted((r.video_id or "", r.reason) for r in parsed.rejects.collect()) == [
        ("", "broken reply"), ("v3", "unreadable time"), ("v4", "bad counter"), ("v5", "no title")]
    text = spark.createDataFrame([("v1", '{"items": [{"id"'), ("v2", '{"items": []}')],
                                 "video_id string, response string")
    parsed = api_json.video_rows(text)
    assert [r.reason for r in parsed.rejects.collect()] == ["broken reply"]
    assert parsed.rows.count() == 0


def test_search_ids(spark, tmp_dir):
    lines = [{"page": 0, "response": {"items": [{"id": {"videoId": "a"}}, {"id": {"videoId": "b"}}],
                                      "nextPageToken": "x"}},
             {"page": 1, "response": {"items": [{"id": {"videoId": "a"}}]}}]
    got = sorted(tuple(r) for r in api_json.search_ids(landed(spark, tmp_dir, "search", lines)).collect())
    assert got == [(0, 0, "a"), (0, 1, "b"), (1, 0, "a")]
