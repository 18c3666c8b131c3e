import datetime as dt

from chanpulse.plans.load import register_views, warehouse
from chanpulse.streaming import start_incremental_load
from test_jobs import AS_OF, CH_HEADER, V_HEADER, sample_landing, write


def test_incremental_load_matches_name_order(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    sample_landing(raw)
    for entity in ("videos", "channel_stats"):
        q = start_incremental_load(spark, raw, f"{tmp_dir}/wh", f"{tmp_dir}/ckpt_{entity}",
                                   entity=entity, as_of=AS_OF)
        q.awaitTermination(300)
    wh = warehouse(spark, f"{tmp_dir}/wh")
    vids = wh.videos.read().collect()
    assert len(vids) == 1 and vids[0].likes == 7311
    assert wh.channels.read().count() == 22
    # a new file is picked up by the next run, old files are not re-read
    write(f"{raw}/videos_20251106_010000.csv", V_HEADER
          + "NEWVIDEO001,New,2025-11-06T00:30:00+00:00,5,1,0,0.2,Thursday,0\n")
    q = start_incremental_load(spark, raw, f"{tmp_dir}/wh", f"{tmp_dir}/ckpt_videos",
                               entity="videos", as_of=AS_OF)
    q.awaitTermination(300)
    assert wh.videos.read().count() == 2
    views = register_views(wh)
    assert spark.sql("SELECT count(*) FROM top_videos").first()[0] == 2
    assert spark.sql("SELECT sum(video_count) FROM hourly_heatmap").first()[0] == 2
    assert set(views) == {"channel_stats", "videos", "top_videos", "daily_performance",
                          "hourly_heatmap", "monthly_trends"}


def test_a_snapshot_that_lands_late_changes_no_newer_row(spark, tmp_dir):
    """The newer row stays as it is, new keys of the late file come in, and a newer
    file than both is taken."""
    raw = f"{tmp_dir}/raw"
    row = "{},{},2025-11-01T00:30:00+00:00,{},1,0,0.2,Saturday,0\n"

    def land(stamp, as_of, *rows):
        write(f"{raw}/videos_{stamp}.csv", V_HEADER + "".join(row.format(*r) for r in rows))
        start_incremental_load(spark, raw, f"{tmp_dir}/wh", f"{tmp_dir}/ckpt", entity="videos",
                               as_of=as_of).awaitTermination(300)

    day = lambda n: dt.datetime(2025, 11, n)
    land("20251105_010000", day(6), ("SAME", "new", 50), ("ONLYNEW", "n", 5))
    land("20251103_010000", day(7), ("SAME", "old", 30), ("ONLYOLD", "o", 3))
    wh = warehouse(spark, f"{tmp_dir}/wh")
    got = {r.video_id: (r.title, r.views, r.updated_at) for r in wh.videos.read().collect()}
    assert got == {"SAME": ("new", 50, day(6)), "ONLYNEW": ("n", 5, day(6)),
                   "ONLYOLD": ("o", 3, day(7))}
    assert "source_stamp" not in wh.videos.read().columns
    land("20251104_010000", day(8), ("ONLYOLD", "later", 4), ("SAME", "between", 40))
    land("20251106_010000", day(9), ("SAME", "newest", 60))
    got = {r.video_id: (r.title, r.views, r.updated_at) for r in wh.videos.read().collect()}
    assert got == {"SAME": ("newest", 60, day(9)), "ONLYNEW": ("n", 5, day(6)),
                   "ONLYOLD": ("later", 4, day(8))}
