"""Registered queries: sources and sinks (round trips through the shared
checkpoint folder), landed replies, and the jobs end to end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import as_of_literal, parse_iso_timestamp
from ..operators import rollup, topk
from ..operators.upsert import keep_last
from ..schemas import CHANNEL_KEYS, RAW_VIDEOS
from ..session import run_jobs, scratch_path
from ..sources import api_json, csv, parquet, snapshots
from . import proxies
from .load import load, warehouse
from .report import summary_report
from .run import run
from .registry import CHANNEL_CTE, EVENTS_AS_OF, present, query, video_cte, with_videos
from .transform import transform

RATE_DIGITS = {"engagement_rate": 9, "likes_per_view": 9, "comments_per_view": 9}
AS_OF = dt.datetime(2024, 1, 31)


def _quoted_raw(spark, sf_dir) -> DataFrame:
    """Raw video rows whose titles hold a comma and doubled quotes."""
    raw = proxies.raw_videos_from_events(proxies.table(spark, sf_dir, "events"))
    raw = raw.withColumn("title", F.concat(F.regexp_replace("title", "-", ', "'), F.lit('"')))
    return proxies.ingested(raw).select(*RAW_VIDEOS.fieldNames())


_QUOTED_TITLE = """concat(replace(title, '-', ', "'), '"')"""


@query("csv_videos_roundtrip", f"""WITH {video_cte()}
SELECT CAST(video_id AS VARCHAR) AS video_id, {_QUOTED_TITLE} AS title, publish_time, views,
       likes, comments, round(engagement_rate, 9) AS engagement_rate, publish_day, publish_hour,
       publish_date, publish_day_of_week, publish_month,
       round(likes_per_view, 9) AS likes_per_view, round(comments_per_view, 9) AS comments_per_view,
       round(views_per_day, 6) AS views_per_day
FROM v""")
def csv_videos_roundtrip(spark, sf_dir):
    """S8 write + S2 read: titles with commas and quotes, microsecond stamps."""
    path = csv.write_csv(_quoted_raw(spark, sf_dir), scratch_path(spark, "videos_csv"))
    return present(csv.read_videos_csv(spark, path, as_of_literal(AS_OF)), per_column=RATE_DIGITS)


@query("csv_channels_roundtrip", """
SELECT o_orderdate AS captured_at, CAST(o_custkey AS VARCHAR) AS channel_id,
       concat('channel-', CAST(o_custkey AS VARCHAR)) AS channel_title,
       CAST(floor(o_totalprice) AS BIGINT) AS subscribers,
       CAST(floor(o_totalprice) AS BIGINT) * 16 AS total_views,
       CAST(o_orderkey % 100 AS INTEGER) AS video_count
FROM orders""")
def csv_channels_roundtrip(spark, sf_dir):
    """S8 write + S1 read of channel snapshots."""
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders")).drop("seq")
    path = csv.write_csv(batch, scratch_path(spark, "channels_csv"))
    return present(csv.read_channel_csv(spark, path))


@query("iso_offsets", """
SELECT event_id AS video_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS publish_time,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS publish_hour,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS publish_date
FROM events""")
def iso_offsets(spark, sf_dir):
    """ISO text with a +02:00 offset -> UTC instant; malformed -> NULL."""
    ev = proxies.table(spark, sf_dir, "events")
    local = F.col("ts").cast("timestamp") + F.expr("INTERVAL 2 HOURS")
    text = F.when(F.col("event_type") == "error", F.lit("not-a-time")).otherwise(
        F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
    t = ev.select(F.col("event_id").alias("video_id"), parse_iso_timestamp(text).alias("pt"))
    return present(t.select("video_id", F.col("pt").alias("publish_time"),
                            F.hour("pt").alias("publish_hour"), F.to_date("pt").alias("publish_date")))


_REPLY_SQL = f"""WITH {video_cte()},
r AS (SELECT CAST(video_id AS VARCHAR) AS video_id, title, publish_time, views, likes,
             CASE WHEN title LIKE 'purchase-%' THEN 0 ELSE comments END AS comments,
             publish_day, publish_hour
      FROM v WHERE title NOT LIKE 'error-%')"""


@query("video_replies", f"""{_REPLY_SQL}
SELECT video_id, title, publish_time, views, likes, comments,
       round(CASE WHEN views > 0 THEN CAST(likes + comments AS DOUBLE) / views ELSE 0.0 END, 9)
         AS engagement_rate,
       publish_day, publish_hour
FROM r""")
def video_replies(spark, sf_dir):
    """S10 + P11 + P7/P5/P6: first item of each reply; no item -> dropped;
    absent counter -> 0."""
    landed = proxies.video_replies(proxies.table(spark, sf_dir, "events"))
    return present(api_json.video_rows(landed).rows, per_column=RATE_DIGITS)


@query("reply_rejects", """
SELECT entity, reason, id FROM (
  SELECT 'video' AS entity, CAST(event_id AS VARCHAR) AS id,
         CASE event_id % 6 WHEN 0 THEN 'bad counter' WHEN 1 THEN 'no title' WHEN 2 THEN 'broken reply'
           WHEN 3 THEN 'unreadable time' END AS reason
  FROM events WHERE event_type <> 'error' OR event_id % 6 = 2
  UNION ALL
  SELECT 'channel', CAST(o_custkey AS VARCHAR),
         CASE o_orderkey % 4 WHEN 0 THEN 'bad counter' WHEN 1 THEN 'broken reply'
           WHEN 2 THEN 'unreadable time' END
  FROM orders)""")
def reply_rejects(spark, sf_dir):
    """S9, S10 on replies with injected faults: every reply is a row (no reason)
    or a reject; only empty item lists are dropped."""
    def spoil(df, kind, changes):
        text = F.col("response")
        for k, change in changes.items():
            text = F.when(kind == k, change(F.col("response"))).otherwise(text)
        return df.withColumn("response", text)

    def counter_x(t):
        return F.regexp_replace(t, '"viewCount":"', '"viewCount":"x')

    def cut(t):
        return F.substring(t, 1, 5)

    videos = spoil(proxies.video_replies(proxies.table(spark, sf_dir, "events")),
                   F.col("video_id").cast("bigint") % 6, {
        0: counter_x, 1: lambda t: F.regexp_replace(t, '"title":', '"name":'), 2: cut,
        3: lambda t: F.regexp_replace(t, '"publishedAt":"', '"publishedAt":"on ')})
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    chans = proxies.channel_replies(batch, keep="seq")
    chans = spoil(chans, F.col("seq") % 4, {0: counter_x, 1: cut}).withColumn(
        "captured_at", F.when(F.col("seq") % 4 == 2, F.lit("soon")).otherwise(F.col("captured_at")))
    out = []
    for entity, key, parsed in (("video", "video_id", api_json.video_rows(videos)),
                                ("channel", "channel_id", api_json.channel_replies(chans.drop("seq")))):
        out += [df.select(F.lit(entity).alias("entity"), reason.alias("reason"), F.col(key).alias("id"))
                for df, reason in ((parsed.rows, F.lit(None).cast("string")),
                                   (parsed.rejects, F.col("reason")))]
    return out[0].union(out[1]).union(out[2]).union(out[3])


@query("capture_stamp", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '2024-01-31 00:00:00' ELSE o_orderdate END
         AS captured_at, CAST(o_custkey AS VARCHAR) AS channel_id
FROM orders""")
def capture_stamp(spark, sf_dir):
    """A channel request that landed without a capture time takes the run's."""
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    landed = proxies.channel_replies(batch, keep="seq").withColumn(
        "captured_at", F.when(F.col("seq") % 2 != 0, F.col("captured_at"))).drop("seq")
    rows = api_json.channel_rows(landed, captured_at=as_of_literal(AS_OF))
    return present(rows.select("captured_at", "channel_id"))


@query("channel_replies", """
SELECT o_orderdate AS captured_at, CAST(o_custkey AS VARCHAR) AS channel_id,
       concat('channel-', CAST(o_custkey AS VARCHAR)) AS channel_title,
       CAST(floor(o_totalprice) AS BIGINT) AS subscribers,
       CAST(floor(o_totalprice) AS BIGINT) * 16 AS total_views,
       CAST(o_orderkey % 100 AS INTEGER) AS video_count
FROM orders""")
def channel_replies(spark, sf_dir):
    """S9 + P11 + P12: channel reply -> snapshot row (id and time from the
    request; an absent counter is 0)."""
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    return present(api_json.channel_rows(proxies.channel_replies(batch), on_missing="error"))


@query("search_pages", """
SELECT CAST(event_id // 50 AS BIGINT) AS page, CAST(event_id % 50 AS INTEGER) AS position,
       CAST(event_id AS VARCHAR) AS video_id
FROM events""")
def search_pages(spark, sf_dir):
    """Ids listed on every search page, with page and position."""
    return api_json.search_ids(proxies.search_replies(proxies.table(spark, sf_dir, "events")))


_A9 = """SELECT count(*) AS total_videos, CAST(sum(views) AS BIGINT) AS total_views,
       round(avg(views), 6) AS avg_views, max(views) AS max_views,
       round(avg(engagement_rate), 6) AS avg_engagement_rate
FROM v"""


@query("parquet_roundtrip", with_videos(_A9))
def parquet_roundtrip(spark, sf_dir):
    """S6 write + S4 choice + S7 read: ``top_videos_<newer>`` sits next to
    ``videos_<older>``; the anchored choice still takes the videos."""
    v = proxies.videos_events(spark, sf_dir, as_of_literal(AS_OF))
    d = scratch_path(spark, "processed")
    parquet.save_outputs({"videos": v}, d, "20240131_000000")
    parquet.save_outputs({"top_videos": topk.top_videos(v)}, d, "20240131_000100")
    chosen = snapshots.latest_dataset(spark, d, "videos")
    _, back = parquet.read_processed(spark, None, chosen)
    return present(rollup.video_summary(back))


def _raw_snapshots(spark, sf_dir) -> str:
    """A landing folder as the ingest step fills it: a stale snapshot pair of
    the day before (one view more per video, one subscriber less per
    channel) and the current pair; only the current pair may be read."""
    raw_dir = scratch_path(spark, "raw")
    videos = _quoted_raw(spark, sf_dir)
    chans = keep_last(proxies.channel_batch(proxies.table(spark, sf_dir, "orders")),
                      CHANNEL_KEYS, "seq").drop("seq")
    run_jobs([  # the two pairs are independent writes
        lambda: csv.save_snapshots(chans.withColumn("subscribers", F.col("subscribers") - 1),
                                   videos.withColumn("views", F.col("views") + 1),
                                   raw_dir, "20240130_000000"),
        lambda: csv.save_snapshots(chans, videos, raw_dir, "20240131_000000")])
    return raw_dir


@query("transform_job", with_videos("""
SELECT publish_day, publish_day_of_week, count(*) AS video_count,
       round(avg(views), 6) AS avg_views, round(avg(engagement_rate), 6) AS avg_engagement_rate,
       CAST(sum(views) AS BIGINT) AS total_views
FROM v GROUP BY publish_day, publish_day_of_week"""))
def transform_job(spark, sf_dir):
    """B1: newest snapshots -> processed datasets + analytics through the
    shared roll-up; returns the written day performance."""
    return _transformed(spark, _raw_snapshots(spark, sf_dir))


def _transformed(spark, raw_dir: str) -> DataFrame:
    res = transform(spark, raw_dir, scratch_path(spark, "processed"), AS_OF, "20240131_000000")
    return present(spark.read.parquet(res.paths["day_performance"]))


@query("transform_rejects", """
SELECT entity, reason, count(*) AS n FROM (
  SELECT 'videos' AS entity, CASE event_id % 5 WHEN 0 THEN 'malformed record'
           WHEN 1 THEN 'unreadable time' END AS reason FROM events
  UNION ALL
  SELECT 'channel_stats', CASE o_orderkey % 3 WHEN 0 THEN 'malformed record'
           WHEN 1 THEN 'unreadable time' END FROM orders)
GROUP BY entity, reason""")
def transform_rejects(spark, sf_dir):
    """B1 on snapshots with counters that are no numbers and times that don't
    parse: rows kept (no reason) and set aside, by entity and reason."""
    raw_dir = scratch_path(spark, "raw")
    v = _quoted_raw(spark, sf_dir)
    kind = F.col("video_id").cast("bigint") % 5
    v = v.select(*[F.col(c).cast("string").alias(c) for c in v.columns]).withColumns({
        "views": F.when(kind == 0, F.concat(F.col("views"), F.lit("x"))).otherwise(F.col("views")),
        "publish_time": F.when(kind == 1, F.lit("yesterday")).otherwise(F.col("publish_time"))})
    c = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    kind = F.col("seq") % 3
    c = c.select(*[F.col(x).cast("string").alias(x) for x in c.columns if x != "seq"], "seq") \
        .withColumns({
            "subscribers": F.when(kind == 0, F.lit("many")).otherwise(F.col("subscribers")),
            "captured_at": F.when(kind == 1, F.lit("today")).otherwise(F.col("captured_at"))})
    csv.save_snapshots(c, v, raw_dir, "20240131_000000")
    out = scratch_path(spark, "processed")
    res = transform(spark, raw_dir, out, AS_OF, "20240131_000000")
    found = []
    for entity in ("videos", "channel_stats"):
        kept = spark.read.parquet(res.paths[entity]).select(F.lit(None).cast("string").alias("reason"))
        bad = spark.read.parquet(parquet.dataset_path(f"{out}/rejects", f"{entity}_rejects",
                                                      "20240131_000000")).select("reason")
        found.append(kept.union(bad).select(F.lit(entity).alias("entity"), "reason"))
    return found[0].union(found[1]).groupBy("entity", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("load_job", f"""WITH {video_cte()}
SELECT count(*) AS total_videos, CAST(sum(views) AS BIGINT) AS total_views,
       round(avg(views), 6) AS avg_views, max(views) AS max_views,
       round(CAST(avg(CAST(engagement_rate AS DECIMAL(10,6))) AS DOUBLE), 6) AS avg_engagement_rate,
       count(DISTINCT video_id) AS distinct_ids,
       (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)) AS channel_rows
FROM v""")
def load_job(spark, sf_dir):
    """B2: transform then load into a fresh warehouse (DDL, choice, rules,
    upsert with ids, versioned commit); summary of the loaded tables."""
    return _loaded(spark, _processed(spark, sf_dir))


def _processed(spark, sf_dir) -> str:
    processed = scratch_path(spark, "processed")
    transform(spark, _raw_snapshots(spark, sf_dir), processed, AS_OF, "20240131_000000")
    return processed


def _loaded(spark, processed: str) -> DataFrame:
    wh_dir = scratch_path(spark, "warehouse")
    load(spark, processed, wh_dir, AS_OF)
    wh = warehouse(spark, wh_dir)
    vt = wh.videos.read()
    s = rollup.video_summary(vt).withColumn(
        "avg_engagement_rate", F.col("avg_engagement_rate").cast("double"))
    ids = vt.agg(F.count_distinct("id").alias("distinct_ids"))
    ch = wh.channels.read().agg(F.count(F.lit(1)).alias("channel_rows"))
    both = (s.unionByName(ids, allowMissingColumns=True)
            .unionByName(ch, allowMissingColumns=True))
    return present(both.agg(*[F.max(c).alias(c) for c in
                              ["total_videos", "total_views", "avg_views", "max_views",
                               "avg_engagement_rate", "distinct_ids", "channel_rows"]]))


_REPORT_SQL = f"""WITH {CHANNEL_CTE}, {video_cte()},
snap AS (SELECT * FROM ch ORDER BY captured_at DESC, channel_id LIMIT 1),
summ AS (SELECT count(*) AS n, sum(views) AS tv, avg(views) AS av, max(views) AS mv,
                avg(engagement_rate) AS er FROM v),
top AS (SELECT title, views, engagement_rate,
               row_number() OVER (ORDER BY views DESC, video_id) AS rn
        FROM v ORDER BY views DESC, video_id LIMIT 5)
SELECT 'channel' AS section, 1 AS ordinal, 'Channel: ' || channel_title AS line FROM snap
UNION ALL SELECT 'channel', 2, 'Subscribers: ' || format('{{:,}}', subscribers) FROM snap
UNION ALL SELECT 'channel', 3, 'Total Views: ' || format('{{:,}}', total_views) FROM snap
UNION ALL SELECT 'channel', 4, 'Video Count: ' || format('{{:,}}', video_count) FROM snap
UNION ALL SELECT 'channel', 5, 'Last Updated: ' || strftime(captured_at, '%Y-%m-%d %H:%M:%S')
    || CASE WHEN epoch_us(captured_at) % 1000000 <> 0 THEN strftime(captured_at, '.%f') ELSE '' END
    || '+00:00' FROM snap
UNION ALL SELECT 'videos', 1, 'Total Videos: ' || format('{{:,}}', n) FROM summ
UNION ALL SELECT 'videos', 2, 'Total Views: ' || format('{{:,}}', tv) FROM summ
UNION ALL SELECT 'videos', 3, 'Average Views: ' || format('{{:,.0f}}', av) FROM summ
UNION ALL SELECT 'videos', 4, 'Max Views: ' || format('{{:,}}', mv) FROM summ
UNION ALL SELECT 'videos', 5, 'Average Engagement Rate: ' || format('{{:,.4f}}', er) FROM summ
UNION ALL SELECT 'top', CAST(rn AS INTEGER), CAST(rn AS VARCHAR) || '. ' || substring(title, 1, 50)
    || '... - ' || format('{{:,}}', views) || ' views (ER: ' || format('{{:,.4f}}', engagement_rate)
    || ')' FROM top"""


@query("summary_report", _REPORT_SQL)
def summary_report_query(spark, sf_dir):
    """B4 with P16, P17, P19: report lines as (section, ordinal, line)."""
    chans = keep_last(proxies.channel_batch(proxies.table(spark, sf_dir, "orders")),
                      CHANNEL_KEYS, "seq").drop("seq")
    v = proxies.videos_events(spark, sf_dir, as_of_literal(EVENTS_AS_OF))
    return summary_report(chans, v)


RUN_AS_OF = dt.datetime(2001, 8, 2)


def _landed(spark, sf_dir) -> str:
    d = scratch_path(spark, "landed")
    ev = proxies.table(spark, sf_dir, "events")
    chans = keep_last(proxies.channel_batch(proxies.table(spark, sf_dir, "orders")),
                      CHANNEL_KEYS, "seq").drop("seq")
    for kind, df in (("channels", proxies.channel_replies(chans)),
                     ("videos", proxies.video_replies(ev)),
                     ("search", proxies.search_replies(ev))):
        schema = api_json.landed_schema(kind)["response"].dataType
        df.withColumn("response", F.from_json("response", schema)).write.json(f"{d}/{kind}")
    return d


@query("end_to_end_run", f"""WITH {video_cte()},
found AS (SELECT v.*, CASE WHEN title LIKE 'purchase-%' THEN 0 ELSE comments END AS comments2
          FROM v WHERE title NOT LIKE 'error-%')
SELECT CAST(video_id AS VARCHAR) AS video_id, title, publish_time, views, likes, comments2 AS comments,
       CAST(CASE WHEN views > 0 THEN CAST(likes + comments2 AS DOUBLE) / views ELSE 0.0 END
            AS DECIMAL(10,6)) AS engagement_rate,
       publish_day, publish_hour, publish_date, TIMESTAMP '2001-08-02 00:00:00' AS created_at
FROM found""")
def end_to_end_run(spark, sf_dir):
    """Landed replies -> all videos found -> raw CSV ->
    transform -> load -> freshness check -> report; returns the video table."""
    return _ran(spark, _landed(spark, sf_dir))


def _ran(spark, landed: str) -> DataFrame:
    res = run(spark, landed, scratch_path(spark, "run"), RUN_AS_OF)
    res.report.collect()
    wh = warehouse(spark, res.warehouse_dir)
    return present(wh.videos.read().select(
        "video_id", "title", "publish_time", "views", "likes", "comments", "engagement_rate",
        "publish_day", "publish_hour", "publish_date", "created_at"))


#: For the benchmark: what a job query sets up, and the job itself on that.
STAGED = {"transform_job": (_raw_snapshots, _transformed), "load_job": (_processed, _loaded),
          "end_to_end_run": (_landed, _ran)}
