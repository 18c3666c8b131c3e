"""Jobs on hand fixtures shaped like raw snapshots (FIXTURES.md §7)."""

import datetime as dt
import os

import pytest

from chanpulse.functions.derive import as_of_literal
from chanpulse.plans import load as load_job
from chanpulse.plans.quality import quality_check
from chanpulse.plans.report import render, summary_report
from chanpulse.plans.transform import transform
from chanpulse.session import local_fs_path
from chanpulse.sources import csv

# fixed values: the headers of the two snapshot files
CH_HEADER = "captured_at,channel_id,channel_title,subscribers,total_views,video_count\n"
V_HEADER = "video_id,title,publish_time,views,likes,comments,engagement_rate,publish_day,publish_hour\n"
AS_OF = dt.datetime(2025, 11, 6)


def write(path, text):
    p = local_fs_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)


def sample_landing(raw_dir):
    """22 channel and 22 video snapshots of one row each; the first five
    videos carry 7310 likes, the rest 7311."""
    stamps = []
    for i in range(22):
        stamp = f"20251105_19{i:02d}00"
        stamps.append(stamp)
        write(f"{raw_dir}/channel_stats_{stamp}.csv", CH_HEADER
              + f"2025-11-05T19:{i:02d}:31.000417+00:00,channel-one,Teapot Club,51300,770042,12\n")
        likes = 7310 if i < 5 else 7311
        write(f"{raw_dir}/videos_{stamp}.csv", V_HEADER
              + f"video-one,How to Pour - A Long Story,2021-03-14T04:30:15+00:00,400000,{likes},"
                f"399,0.025,Saturday,0\n")
    return stamps


def test_sample_snapshots_loaded_in_name_order(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    stamps = sample_landing(raw)
    wh = load_job.warehouse(spark, f"{tmp_dir}/wh")
    now = as_of_literal(AS_OF)
    # all channel snapshots as one batch: 22 distinct (channel_id, captured_at)
    load_job.load_channels(wh, csv.read_channel_csv(spark, f"{raw}/channel_stats_*.csv"), now)
    # videos one snapshot after the other, in name order, full upsert
    for stamp in stamps:
        load_job.load_videos(wh, csv.read_videos_csv(spark, f"{raw}/videos_{stamp}.csv", now), now)
    assert wh.channels.read().count() == 22
    vids = wh.videos.read().collect()
    assert len(vids) == 1 and vids[0].likes == 7311 and vids[0].id == 1
    assert quality_check(wh, AS_OF) == {"recent_channels": 22, "recent_videos": 1}
    text = render(summary_report(wh.channels.read(), wh.videos.read()))
    assert "Subscribers: 51,300" in text and "1. How to Pour - A Long Story... - 400,000 views" in text


def test_transform_then_load(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    sample_landing(raw)
    res = transform(spark, raw, f"{tmp_dir}/processed", AS_OF, "20251106_000000")
    assert set(res.paths) == {"channel_stats", "videos", "top_videos", "day_performance",
                              "hour_performance", "monthly_trends", "engagement_stats"}
    assert res.summary["video_records"] == 1 and res.summary["channel_records"] == 1
    top = spark.read.parquet(res.paths["top_videos"]).first()
    assert top.likes == 7311  # newest snapshot by name
    out = load_job.load(spark, f"{tmp_dir}/processed", f"{tmp_dir}/wh", AS_OF)
    assert out.merged == {"channel_stats": 1, "videos": 1}
    assert out.summary["videos"]["total_videos"] == 1
    assert out.summary["channel"]["channel_title"] == "Teapot Club"
    # a second identical load changes nothing
    assert res.rejects == {"channel_stats": 0, "videos": 0}
    again = load_job.load(spark, f"{tmp_dir}/processed", f"{tmp_dir}/wh", AS_OF)
    assert again.merged == {"channel_stats": 1, "videos": 1}
    assert again.summary["videos"]["total_videos"] == 1


def test_rule_failure_keeps_table(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T05:07:09+00:00,10,1,1,0.2,Saturday,24\n")
    wh = load_job.warehouse(spark, f"{tmp_dir}/wh")
    from chanpulse.operators.rules import RuleViolation
    with pytest.raises(RuleViolation):
        load_job.load_videos(wh, csv.read_videos_csv(spark, f"{raw}/videos_20251105_190000.csv",
                                                     as_of_literal(AS_OF)), as_of_literal(AS_OF))
    assert wh.videos.read().count() == 0
    res = load_job.LoadResult()
    load_job.load_videos(wh, csv.read_videos_csv(spark, f"{raw}/videos_20251105_190000.csv",
                                                 as_of_literal(AS_OF)), as_of_literal(AS_OF),
                         mode="quarantine", result=res)
    assert res.quarantined["videos"].count() == 1 and wh.videos.read().count() == 0


def test_rejects_are_always_written_and_counted(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/processed"
    write(f"{raw}/channel_stats_20251105_190000.csv", CH_HEADER
          + "2025-11-05T19:00:00Z,c1,C,1,2,3\nsoon,c2,C,1,2,3\n")
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T04:30:15Z,10,1,1,0.2,Saturday,0\n"
          + "v2,T,2021-03-14T04:30:15Z,abc,1,1,0.2,Saturday,0\n"
          + "v3,T,2021-03-14T04:30:15Z,10\n"
          + "v4,T,yesterday,10,1,1,0.2,Saturday,0\n")
    res = transform(spark, raw, out, AS_OF, "20251106_000000")
    assert res.rejects == {"channel_stats": 1, "videos": 3}
    assert spark.read.parquet(res.paths["videos"]).count() == 1
    bad = spark.read.parquet(f"{out}/rejects/videos_rejects_20251106_000000.parquet").collect()
    assert sorted((r.video_id, r.reason) for r in bad) == [
        ("v2", "malformed record"), ("v3", "malformed record"), ("v4", "unreadable time")]
    assert all("abc" in r.record for r in bad if r.video_id == "v2")


def test_absent_required_column_fails(spark, tmp_dir):
    from chanpulse.operators.rules import RuleViolation
    raw = f"{tmp_dir}/raw"
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T04:30:15Z,10,1,1,0.2,Saturday,0\n")
    now = as_of_literal(AS_OF)
    batch = csv.read_videos_csv(spark, f"{raw}/videos_20251105_190000.csv", now)
    wh = load_job.warehouse(spark, f"{tmp_dir}/wh")
    with pytest.raises(RuleViolation, match="not_null_title=1"):
        load_job.load_videos(wh, batch.drop("title", "publish_hour"), now)
    assert wh.videos.read().count() == 0


def test_repeated_ids_in_a_load(spark, tmp_dir):
    from chanpulse.operators.upsert import DuplicateKeyError
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/processed"
    write(f"{raw}/channel_stats_20251105_190000.csv", CH_HEADER + "2025-11-05T19:00:00Z,c1,C,1,2,3\n")
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T04:30:15Z,10,1,1,0.2,Saturday,0\n"
          + "v1,U,2021-03-14T04:30:15Z,20,1,1,0.1,Saturday,0\n")
    transform(spark, raw, out, AS_OF, "20251106_000000")
    with pytest.raises(DuplicateKeyError):
        load_job.load(spark, out, f"{tmp_dir}/wh", AS_OF)
    load_job.load(spark, out, f"{tmp_dir}/wh", AS_OF, on_duplicate="last")
    wh = load_job.warehouse(spark, f"{tmp_dir}/wh")
    assert [(r.title, r.views) for r in wh.videos.read().collect()] == [("U", 20)]


def test_loads_one_after_the_other_keep_ids(spark, tmp_dir):
    raw, now = f"{tmp_dir}/raw", as_of_literal(AS_OF)
    wh = load_job.warehouse(spark, f"{tmp_dir}/wh", video_buckets=1)
    for k in (1, 2, 1):
        write(f"{raw}/videos_2025110{k}_190000.csv", V_HEADER
              + f"v{k},T,2021-03-14T05:07:09Z,10,1,1,0.2,Saturday,0\n")
        load_job.load_videos(
            wh, csv.read_videos_csv(spark, f"{raw}/videos_2025110{k}_190000.csv", now), now)
    assert sorted((r.video_id, r.id) for r in wh.videos.read().collect()) == [("v1", 1), ("v2", 2)]


def test_missing_snapshot_fails(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        transform(spark, f"{tmp_dir}/empty", f"{tmp_dir}/out", AS_OF)


def test_bucket_count_fixed_at_creation(spark, tmp_dir):
    load_job.warehouse(spark, f"{tmp_dir}/wh", video_buckets=4)
    again = load_job.warehouse(spark, f"{tmp_dir}/wh", video_buckets=16)
    assert again.videos.buckets == 4
    raw = f"{tmp_dir}/raw"
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T05:07:09+00:00,10,1,1,0.2,Saturday,0\n")
    batch = csv.read_videos_csv(spark, f"{raw}/videos_20251105_190000.csv", as_of_literal(AS_OF))
    load_job.load_videos(again, batch, as_of_literal(AS_OF))
    # a session whose catalog has forgotten the tables finds them again in their folders
    spark.sql(f"DROP TABLE {again.videos.name}")
    found = load_job.warehouse(spark, f"{tmp_dir}/wh", video_buckets=16)
    assert found.videos.buckets == 4
    assert [r.video_id for r in found.videos.read().collect()] == ["v1"]


def test_each_snapshot_is_parsed_once(spark, tmp_dir, monkeypatch):
    """The raw files are gone once they were parted; rows and rejects still come out."""
    from chanpulse.sources.judged import Judged
    raw = f"{tmp_dir}/raw"
    write(f"{raw}/channel_stats_20251105_190000.csv", CH_HEADER
          + "2025-11-05T19:00:00Z,c1,C,1,2,3\nsoon,c2,C,1,2,3\n")
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T05:07:09Z,10,1,1,0.2,Saturday,0\n"
          + "v2,T,yesterday,10,1,1,0.2,Saturday,0\n")
    part, parted = Judged.parted, []

    def part_and_delete(self, name):
        out = part(self, name)
        for f in self.frame.inputFiles():
            os.remove(local_fs_path(f.replace("file://", "")))
        parted.append(name)
        return out
    monkeypatch.setattr(Judged, "parted", part_and_delete)
    res = transform(spark, raw, f"{tmp_dir}/out", AS_OF, "20251106_000000")
    assert sorted(parted) == ["channel-records", "video-records"]
    assert not any(n.endswith(".csv") for n in os.listdir(local_fs_path(raw)))
    assert res.rejects == {"channel_stats": 1, "videos": 1}
    assert [r.video_id for r in spark.read.parquet(res.paths["videos"]).collect()] == ["v1"]


def test_replies_are_parsed_once(spark, tmp_dir, monkeypatch):
    import json
    import shutil

    from chanpulse.plans.run import extract
    from chanpulse.sources.judged import Judged
    item = {"snippet": {"title": "T", "publishedAt": "2021-03-14T05:07:09Z"},
            "statistics": {"viewCount": "10", "likeCount": "1"}}
    lines = {"channels": [{"channel_id": "c", "captured_at": "2025-11-05T19:00:00Z", "response": {
                 "items": [{"snippet": {"title": "C"}, "statistics": {"viewCount": "1"}}]}}],
             "search": [{"page": 0, "response": {"items": [{"id": {"videoId": "v1"}},
                                                           {"id": {"videoId": "v2"}}]}}],
             "videos": [{"video_id": "v1", "response": {"items": [item]}},
                        {"video_id": "v2", "response": {"items": [
                            {**item, "statistics": {"viewCount": "many"}}]}}]}
    for kind, rows in lines.items():
        write(f"{tmp_dir}/landed/{kind}/part.json", "\n".join(map(json.dumps, rows)) + "\n")
    part, parted = Judged.parted, []

    def part_and_delete(self, name):
        out = part(self, name)
        kind = {"channel-replies": "channels", "video-replies": "videos"}[name]
        shutil.rmtree(local_fs_path(f"{tmp_dir}/landed/{kind}"))
        parted.append(name)
        return out
    monkeypatch.setattr(Judged, "parted", part_and_delete)
    (ch, vid), rejected = extract(spark, f"{tmp_dir}/landed", f"{tmp_dir}/raw", "20251106_000000")
    assert sorted(parted) == ["channel-replies", "video-replies"]
    assert rejected == {"channel_stats": 0, "videos": 1}
    got = csv.read_videos_csv(spark, vid, as_of_literal(AS_OF)).collect()
    assert [(r.video_id, r.views) for r in got] == [("v1", 10)]


def test_repeated_keys_are_quarantined(spark, tmp_dir):
    raw, now = f"{tmp_dir}/raw", as_of_literal(AS_OF)
    write(f"{raw}/videos_20251105_190000.csv", V_HEADER
          + "v1,T,2021-03-14T05:07:09Z,10,1,1,0.2,Saturday,0\n"
          + "v1,U,2021-03-14T05:07:09Z,20,1,1,0.1,Saturday,0\n"
          + "v2,V,2021-03-14T05:07:09Z,20,1,1,0.1,Saturday,0\n"
          + "v3,W,2021-03-14T05:07:09Z,20,1,1,0.1,Saturday,24\n"
          + "v3,X,2021-03-14T05:07:09Z,20,1,1,0.1,Saturday,1\n")
    batch = csv.read_videos_csv(spark, f"{raw}/videos_20251105_190000.csv", now)
    wh, res = load_job.warehouse(spark, f"{tmp_dir}/wh"), load_job.LoadResult()
    load_job.load_videos(wh, batch, now, mode="quarantine", result=res)
    # of v3 one row breaks a rule, and the other is then alone
    assert sorted(r.title for r in wh.videos.read().collect()) == ["V", "X"]
    assert sorted((r.title, r.violations) for r in res.quarantined["videos"].collect()) == [
        ("T", "repeated_key"), ("U", "repeated_key"), ("W", "range_publish_hour")]
    # or the last one wins, if that is asked for
    load_job.load_videos(wh, batch.filter("video_id = 'v1'"), now, mode="quarantine",
                         on_duplicate="last", order_by="views", result=res)
    assert sorted(r.title for r in wh.videos.read().collect()) == ["U", "V", "X"]


def test_jobs_on_the_command_line(spark, tmp_dir, capsys):
    import json

    from chanpulse.__main__ import main
    sample_landing(f"{tmp_dir}/raw")
    when = ["--as-of", AS_OF.isoformat()]
    main(["transform", f"{tmp_dir}/raw", f"{tmp_dir}/processed", *when])
    assert json.loads(capsys.readouterr().out)["rejects"] == {"channel_stats": 0, "videos": 0}
    tables = ["--database", "chanpulse_command_line"]
    main(["load", f"{tmp_dir}/processed", f"{tmp_dir}/wh", *when, *tables])
    assert json.loads(capsys.readouterr().out)["merged"] == {"channel_stats": 1, "videos": 1}
    main(["check", f"{tmp_dir}/wh", *when, *tables])
    assert json.loads(capsys.readouterr().out) == {"recent_channels": 1, "recent_videos": 1}
    main(["report", f"{tmp_dir}/wh", *tables])
    assert "Subscribers: 51,300" in capsys.readouterr().out
    assert spark.table("chanpulse_command_line.videos").count() == 1
