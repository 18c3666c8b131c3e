"""Registered queries: loads into a warehouse with faults, repeats and second runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import as_of_literal
from ..operators import rollup, rules
from ..operators.upsert import keep_last
from ..schemas import CHANNEL_KEYS
from ..session import scratch_path
from ..sources import parquet, snapshots
from . import proxies
from .load import LoadResult, load, load_channels, load_videos, register_views, warehouse
from .quality import quality_check
from .registry import CHANNEL_CTE, present, query, video_cte, with_videos

AS_OF = dt.datetime(2024, 1, 31)
SMALL_BUCKETS = 4


def _videos(spark, sf_dir) -> DataFrame:
    return proxies.videos_events(spark, sf_dir, as_of_literal(AS_OF)) \
        .withColumn("video_id", F.col("video_id").cast("string"))


def _channels(spark, sf_dir) -> DataFrame:
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders")) \
        .withColumn("channel_id", F.col("channel_id").cast("string"))
    return keep_last(batch, CHANNEL_KEYS, "seq").drop("seq")


def _warehouse(spark):
    return warehouse(spark, scratch_path(spark, "warehouse"), SMALL_BUCKETS)


def _faulty_videos(spark, sf_dir) -> DataFrame:
    """Rates beyond DECIMAL(10,6), counters beyond 32 bits, a column missing."""
    v = _videos(spark, sf_dir)
    n = F.col("video_id").cast("bigint")
    return v.withColumns({
        "engagement_rate": F.when(n % 7 == 0, F.lit(12345.6)).otherwise(F.col("engagement_rate")),
        "likes": F.when(n % 11 == 0, F.lit(3_000_000_000)).otherwise(F.col("likes"))}) \
        .drop("publish_month")


def _faulty_channels(spark, sf_dir) -> DataFrame:
    return _channels(spark, sf_dir).withColumn(
        "video_count", F.when(F.col("video_count") > 90, F.lit(5_000_000_000))
        .otherwise(F.col("video_count").cast("bigint")))


@query("load_rule_violations", f"""WITH {CHANNEL_CTE}
SELECT 'videos' AS entity, 'fits_engagement_rate' AS rule,
       count(*) FILTER (WHERE event_id % 7 = 0) AS n FROM events
UNION ALL SELECT 'videos', 'int32_likes', count(*) FILTER (WHERE event_id % 11 = 0) FROM events
UNION ALL SELECT 'videos', 'not_null_publish_month', count(*) FROM events
UNION ALL SELECT 'channel_stats', 'int32_video_count', count(*) FILTER (WHERE video_count > 90) FROM ch""")
def load_rule_violations(spark, sf_dir):
    """C1, C6 through the load in ``fail`` mode: the rules a batch breaks, with
    their counts; a column that the batch lacks breaks its NOT NULL rule."""
    wh, now, found = _warehouse(spark), as_of_literal(AS_OF), []
    for entity, run in (("videos", lambda: load_videos(wh, _faulty_videos(spark, sf_dir), now)),
                        ("channel_stats", lambda: load_channels(wh, _faulty_channels(spark, sf_dir),
                                                                now))):
        try:
            run()
        except rules.RuleViolation as e:
            found += [(entity, k, n) for k, n in e.counts.items() if n]
    if wh.videos.read().count() or wh.channels.read().count():
        raise AssertionError("a batch that breaks rules was loaded")
    return spark.createDataFrame(found, "entity string, rule string, n long")


@query("load_quarantine", f"""WITH {CHANNEL_CTE},
q AS (SELECT CAST(event_id AS VARCHAR) AS id,
         concat_ws(',', CASE WHEN event_id % 7 = 0 THEN 'fits_engagement_rate' END,
                        CASE WHEN event_id % 11 = 0 THEN 'int32_likes' END) AS violations,
         CASE WHEN event_id % 7 = 0 THEN 12345.6 END AS kept_rate,
         CASE WHEN event_id % 11 = 0 THEN 3000000000 END AS kept_counter FROM events
  UNION ALL
  SELECT concat(CAST(channel_id AS VARCHAR), ' ', strftime(captured_at, '%Y-%m-%d %H:%M:%S')),
         CASE WHEN video_count > 90 THEN 'int32_video_count' ELSE '' END, NULL,
         CASE WHEN video_count > 90 THEN 5000000000 END FROM ch)
SELECT id, violations, CAST(kept_rate AS DOUBLE) AS kept_rate, CAST(kept_counter AS BIGINT) AS kept_counter
FROM q""")
def load_quarantine(spark, sf_dir):
    """C1, C6 through the load in ``quarantine`` mode: every row is loaded (no
    violation) or set aside with its original values."""
    wh, now, res = _warehouse(spark), as_of_literal(AS_OF), LoadResult()
    v = _faulty_videos(spark, sf_dir).withColumn("publish_month",
                                                 F.date_format("publish_time", "yyyy-MM"))
    load_videos(wh, v, now, mode="quarantine", result=res)
    load_channels(wh, _faulty_channels(spark, sf_dir), now, mode="quarantine", result=res)
    video_id = F.col("video_id")
    snapshot = F.concat(F.col("channel_id"), F.lit(" "),
                        F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss"))
    none = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    has = lambda rule, c: F.when(F.col("violations").contains(rule), F.col(c))
    bad_v, bad_c = res.quarantined["videos"], res.quarantined["channel_stats"]
    parts = [
        wh.videos.read().select(video_id, F.lit(""), *none),
        bad_v.select(video_id, "violations", has("engagement_rate", "engagement_rate"),
                     has("likes", "likes")),
        wh.channels.read().select(snapshot, F.lit(""), *none),
        bad_c.select(snapshot, "violations", none[0], has("video_count", "video_count"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.toDF("id", "violations", "kept_rate", "kept_counter")


_REPEATED_SQL = """f AS (
  SELECT CAST(event_id // (CASE WHEN event_id % 5 = 0 THEN 10 ELSE 1 END) AS VARCHAR) AS video_id,
         title, event_id % 7 = 0 AS bad FROM (
    SELECT event_id, concat(event_type, '-', CAST(user_id AS VARCHAR)) AS title FROM events)),
k AS (SELECT video_id, title, bad, NOT bad AND count(*) FILTER (WHERE NOT bad)
             OVER (PARTITION BY video_id) > 1 AS repeated FROM f)"""


@query("load_quarantine_repeats", f"""WITH {_REPEATED_SQL}
SELECT video_id, title, CASE WHEN bad THEN 'fits_engagement_rate' WHEN repeated THEN 'repeated_key'
       ELSE '' END AS violations FROM k""")
def load_quarantine_repeats(spark, sf_dir):
    """C2 through the load in ``quarantine`` mode: rows of repeated keys are set aside, all of
    them, and the rest are loaded; rows that break a rule don't count as repeats."""
    wh, res = _warehouse(spark), LoadResult()
    n = F.col("video_id").cast("bigint")
    v = _videos(spark, sf_dir).withColumns({
        "engagement_rate": F.when(n % 7 == 0, F.lit(12345.6)).otherwise(F.col("engagement_rate")),
        "video_id": F.when(n % 5 == 0, F.floor(n / 10)).otherwise(n).cast("string")})
    load_videos(wh, v, as_of_literal(AS_OF), mode="quarantine", result=res)
    return wh.videos.read().select("video_id", "title", F.lit("").alias("violations")).union(
        res.quarantined["videos"].select("video_id", "title", "violations"))


@query("quality_check", f"""WITH {CHANNEL_CTE}
SELECT (SELECT count(*) FROM ch WHERE captured_at >= TIMESTAMP '1998-07-01 00:00:00')
         AS recent_channels, (SELECT count(*) FROM events) AS recent_videos""")
def quality(spark, sf_dir):
    """B3 + C7 on a loaded warehouse: fresh channel snapshots (by capture time) and
    videos (created by this load)."""
    wh = _warehouse(spark)
    now = dt.datetime(1998, 7, 3)
    load_channels(wh, _channels(spark, sf_dir), as_of_literal(now))
    load_videos(wh, _videos(spark, sf_dir), as_of_literal(now))
    found = quality_check(wh, now)
    return spark.createDataFrame([(found["recent_channels"], found["recent_videos"])],
                                 "recent_channels long, recent_videos long")


_SECOND = """a AS (SELECT CAST(video_id AS VARCHAR) AS video_id, title, views + 1 AS views, likes FROM v
  WHERE video_id % 3 <> 0),
b AS (SELECT CAST(video_id AS VARCHAR) AS video_id, title, views, likes + 5 AS likes FROM v
  WHERE video_id % 3 <> 1)"""


@query("load_job_second_run", f"""WITH {video_cte()}, {_SECOND}
SELECT 'full' AS loader, coalesce(b.video_id, a.video_id) AS video_id,
       coalesce(b.views, a.views) AS views, coalesce(b.likes, a.likes) AS likes,
       CASE WHEN a.video_id IS NULL THEN TIMESTAMP '2024-01-31' ELSE TIMESTAMP '2024-01-30' END AS created_at
FROM a FULL OUTER JOIN b ON a.video_id = b.video_id
UNION ALL
SELECT 'narrow', coalesce(b.video_id, a.video_id), coalesce(b.views, a.views), coalesce(a.likes, b.likes),
       CASE WHEN a.video_id IS NULL THEN TIMESTAMP '2024-01-31' ELSE TIMESTAMP '2024-01-30' END
FROM a FULL OUTER JOIN b ON a.video_id = b.video_id""")
def load_job_second_run(spark, sf_dir):
    """B2 + U7 twice: a first batch of two thirds of the videos, a second of another
    two thirds, with the full and the deployed loader; rows and ids."""
    out = None
    for loader in ("full", "narrow"):
        wh = _warehouse(spark)
        v = _videos(spark, sf_dir)
        n = F.col("video_id").cast("bigint") % 3
        first = v.filter(n != 0).withColumn("views", F.col("views") + 1)
        second = v.filter(n != 1).withColumn("likes", F.col("likes") + 5)
        load_videos(wh, first, as_of_literal(dt.datetime(2024, 1, 30)), loader)
        load_videos(wh, second, as_of_literal(AS_OF), loader)
        t = wh.videos.read()
        ids = t.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"),
                    F.max("id").alias("m")).first()
        if not ids["n"] == ids["d"] == ids["m"]:
            raise AssertionError(f"ids are wrong: {ids}")
        t = t.select(F.lit(loader).alias("loader"), "video_id", "views", "likes", "created_at")
        out = t if out is None else out.union(t)
    return present(out)


@query("stored_rollup", f"""WITH {video_cte()},
f AS (SELECT *, CASE WHEN video_id % 3 = 1 THEN views + 1 ELSE views END AS seen FROM v)
SELECT 'day' AS kind, CAST(publish_date AS VARCHAR) AS key, count(*) AS video_count,
       CAST(sum(seen) AS BIGINT) AS total_views, round(avg(seen), 6) AS avg_views FROM f GROUP BY publish_date
UNION ALL SELECT 'hour', concat(publish_day_of_week, '-', publish_hour), count(*),
       CAST(sum(seen) AS BIGINT), round(avg(seen), 6) FROM f GROUP BY publish_day_of_week, publish_hour
UNION ALL SELECT 'month', publish_month, count(*), CAST(sum(seen) AS BIGINT), round(avg(seen), 6)
FROM f GROUP BY publish_month
UNION ALL SELECT 'all', CAST(max(seen) AS VARCHAR), count(*), CAST(sum(seen) AS BIGINT), round(avg(seen), 6)
FROM f""")
def stored_rollup(spark, sf_dir):
    """A6-A9 from the partial measures that two loads have stored: the second, a month later,
    changes videos of the first and adds others."""
    wh, v = _warehouse(spark), _videos(spark, sf_dir)
    n = F.col("video_id").cast("bigint") % 3
    load_videos(wh, v.filter(n != 0).withColumn("views", F.col("views") + 1), as_of_literal(AS_OF))
    load_videos(wh, v.filter(n != 1), as_of_literal(dt.datetime(2024, 2, 29)))
    src, cols = wh.rollup(), ["video_count", "total_views", "avg_views"]
    day, hour = rollup.daily_performance(src), rollup.hourly_heatmap(src)
    month, whole = rollup.monthly_trends_view(src), rollup.video_summary(src)
    parts = [
        day.select(F.lit("day").alias("kind"), F.col("publish_date").cast("string").alias("key"), *cols),
        hour.select(F.lit("hour"), F.concat_ws("-", "publish_day_of_week", "publish_hour"), *cols),
        month.select(F.lit("month"), "publish_month", *cols),
        whole.select(F.lit("all"), F.col("max_views").cast("string"), "total_videos", *cols[1:])]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return present(out)


@query("table_views", with_videos("""
SELECT 'top_videos' AS view, count(*) AS n, CAST(sum(views) AS BIGINT) AS total
  FROM (SELECT views FROM v ORDER BY views DESC, video_id LIMIT 100)
UNION ALL SELECT 'daily_performance', count(DISTINCT publish_date), CAST(sum(views) AS BIGINT) FROM v
UNION ALL SELECT 'hourly_heatmap', count(DISTINCT (publish_day, publish_hour)), CAST(count(*) AS BIGINT) FROM v
UNION ALL SELECT 'monthly_trends', count(DISTINCT publish_month), CAST(sum(views) AS BIGINT) FROM v
UNION ALL SELECT 'videos', count(*), CAST(sum(views) AS BIGINT) FROM v
UNION ALL SELECT 'channel_stats', (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)), NULL"""))
def table_views(spark, sf_dir):
    """The two tables and four views over a loaded warehouse, read by SQL."""
    wh, now = _warehouse(spark), as_of_literal(AS_OF)
    load_videos(wh, _videos(spark, sf_dir), now)
    load_channels(wh, _channels(spark, sf_dir), now)
    views = register_views(wh)
    measure = {"top_videos": "views", "daily_performance": "total_views",
               "hourly_heatmap": "video_count", "monthly_trends": "total_views", "videos": "views"}
    parts = [spark.sql(f"SELECT '{name}' AS view, count(*) AS n, "
                       f"CAST({'sum(' + measure[name] + ')' if name in measure else 'NULL'} AS BIGINT) "
                       f"AS total FROM {name}") for name in views]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("load_defaults", """
SELECT CAST(event_id AS VARCHAR) AS video_id, CAST(0 AS BIGINT) AS likes, CAST(0 AS BIGINT) AS comments,
       CAST(0 AS DOUBLE) AS engagement_rate, TIMESTAMP '2024-01-31' AS created_at,
       TIMESTAMP '2024-01-31' AS updated_at
FROM events""")
def load_defaults(spark, sf_dir):
    """P14 + U5: a batch without counters and rates; inserted rows take the defaults,
    the stamps take the run's time."""
    wh = _warehouse(spark)
    batch = _videos(spark, sf_dir).drop("likes", "comments", "engagement_rate")
    load_videos(wh, batch, as_of_literal(AS_OF))
    t = wh.videos.read().select("video_id", "likes", "comments",
                                F.col("engagement_rate").cast("double").alias("engagement_rate"),
                                "created_at", "updated_at")
    return present(t)


@query("empty_entities", f"""WITH {video_cte()}
SELECT 'no channels' AS run, count(*) AS videos, 0 AS channels FROM v
UNION ALL SELECT 'empty videos', 0, (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders))""")
def empty_entities(spark, sf_dir):
    """a load without one entity, and one whose videos are empty."""
    v, c = _videos(spark, sf_dir), _channels(spark, sf_dir)
    rows = []
    for name, frames in (("no channels", {"videos": v}),
                         ("empty videos", {"videos": v.limit(0), "channel_stats": c})):
        processed, wh_dir = scratch_path(spark, "processed"), scratch_path(spark, "warehouse")
        parquet.save_outputs(frames, processed, "20240131_000000")
        load(spark, processed, wh_dir, AS_OF, video_buckets=SMALL_BUCKETS)
        wh = warehouse(spark, wh_dir)
        rows.append((name, wh.videos.read().count(), wh.channels.read().count()))
    return spark.createDataFrame(rows, "run string, videos long, channels int")


@query("snapshot_choice", with_videos("""
SELECT 'name' AS policy, count(*) AS n, CAST(sum(views) AS BIGINT) AS views FROM v
UNION ALL SELECT 'missing', 0, NULL"""))
def snapshot_choice(spark, sf_dir):
    """The newest snapshot by name among older ones; a missing entity raises."""
    d, v = scratch_path(spark, "processed"), _videos(spark, sf_dir)
    parquet.save_outputs({"videos": v}, d, "20240131_000000")
    parquet.save_outputs({"videos": v.withColumn("views", F.col("views") + 1)}, d, "20240130_000000")
    path = snapshots.require_snapshot(spark, d, "videos", "parquet")
    found = spark.read.parquet(path).agg(F.count("*").alias("n"), F.sum("views").alias("views"))
    missing = 0
    try:
        snapshots.require_snapshot(spark, d, "channel_stats", "parquet")
        missing = 1
    except FileNotFoundError:
        pass
    none = spark.createDataFrame([("missing", missing, None)], "policy string, n long, views long")
    return found.select(F.lit("name").alias("policy"), "n", "views").union(none)
