"""Registered queries: derivations, grouped analytics, top lists, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import as_of_literal, narrow_to_table_types
from ..operators import filters, rollup, topk
from ..operators.upsert import keep_last
from ..schemas import CHANNEL_KEYS
from . import proxies
from .registry import (
    CHANNEL_CTE, EVENTS_AS_OF, LINEITEM_AS_OF, events_as_of, lineitem_as_of, present, query,
    with_channels, with_videos,
)

RATE_DIGITS = {"engagement_rate": 9, "likes_per_view": 9, "comments_per_view": 9}


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxies.videos_events(spark, sf_dir, events_as_of())


def videos_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxies.videos_lineitem(spark, sf_dir, lineitem_as_of())


def channel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel snapshots as the table holds them: one row per
    (channel_id, captured_at), the latest batch row winning."""
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    return keep_last(batch, CHANNEL_KEYS, "seq").drop("seq")


# ------------------------------------------------------------ derivations
@query("derive_videos", with_videos("""
SELECT video_id, title, publish_time, views, likes, comments,
       round(engagement_rate, 9) AS engagement_rate, publish_day, publish_hour,
       publish_date, publish_day_of_week, publish_month,
       round(likes_per_view, 9) AS likes_per_view,
       round(comments_per_view, 9) AS comments_per_view,
       round(views_per_day, 6) AS views_per_day
FROM v"""))
def derive_videos(spark, sf_dir):
    """Date parts, weekday name, hour, rates, views per day."""
    return present(videos(spark, sf_dir), per_column=RATE_DIGITS)


@query("table_decimals", with_videos("""
SELECT video_id,
       CAST(engagement_rate AS DECIMAL(10,6)) AS engagement_rate,
       CAST(likes_per_view AS DECIMAL(10,6)) AS likes_per_view,
       CAST(comments_per_view AS DECIMAL(10,6)) AS comments_per_view,
       CAST(views_per_day AS DECIMAL(15,2)) AS views_per_day
FROM v"""))
def table_decimals(spark, sf_dir):
    """Rates to DECIMAL(10,6), pace to DECIMAL(15,2)."""
    v = narrow_to_table_types(videos(spark, sf_dir))
    return v.select("video_id", "engagement_rate", "likes_per_view", "comments_per_view",
                    "views_per_day")


# ------------------------------------------------------- grouped analytics
_GROUP4 = """count(*) AS video_count, round(avg(views), 6) AS avg_views,
       round(avg(engagement_rate), 6) AS avg_engagement_rate,
       CAST(sum(views) AS BIGINT) AS total_views"""


@query("day_performance", with_videos(f"""
SELECT publish_day, publish_day_of_week, {_GROUP4}
FROM v GROUP BY publish_day, publish_day_of_week ORDER BY publish_day_of_week"""))
def day_performance(spark, sf_dir):
    """A1."""
    return present(rollup.day_performance(videos(spark, sf_dir)))


@query("hour_performance", with_videos(f"""
SELECT publish_hour, {_GROUP4}
FROM v GROUP BY publish_hour ORDER BY publish_hour"""))
def hour_performance(spark, sf_dir):
    """A2."""
    return present(rollup.hour_performance(videos(spark, sf_dir)))


_MONTHLY = f"""SELECT publish_month, {_GROUP4},
       CAST(sum(likes) AS BIGINT) AS total_likes, CAST(sum(comments) AS BIGINT) AS total_comments
FROM v GROUP BY publish_month ORDER BY publish_month"""


@query("monthly_trends", with_videos(_MONTHLY))
def monthly_trends(spark, sf_dir):
    """A3 (events: one month)."""
    return present(rollup.monthly_trends(videos(spark, sf_dir)))


@query("monthly_trends_lineitem", with_videos(_MONTHLY, "lineitem", LINEITEM_AS_OF))
def monthly_trends_lineitem(spark, sf_dir):
    """A3 on lineitem, where months really differ."""
    return present(rollup.monthly_trends(videos_li(spark, sf_dir)))


@query("engagement_stats", with_videos("""
SELECT round(avg(engagement_rate), 6) AS avg_engagement,
       round(max(engagement_rate), 6) AS max_engagement,
       round(min(engagement_rate), 6) AS min_engagement,
       round(avg(likes_per_view), 6) AS avg_likes_per_view,
       round(avg(comments_per_view), 6) AS avg_comments_per_view
FROM v"""))
def engagement_stats(spark, sf_dir):
    """A4."""
    return present(rollup.engagement_stats(videos(spark, sf_dir)))


@query("run_summary", with_videos("""
SELECT (SELECT count(*) FROM orders) AS channel_records, count(*) AS video_records,
       round(avg(engagement_rate), 6) AS avg_engagement, round(avg(views), 6) AS avg_views
FROM v"""))
def run_summary(spark, sf_dir):
    """A5: rows loaded per entity, average engagement and views."""
    ch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    return present(rollup.run_summary(videos(spark, sf_dir), ch))


@query("daily_performance", with_videos("""
SELECT publish_date, count(*) AS video_count, CAST(sum(views) AS BIGINT) AS total_views,
       round(avg(views), 6) AS avg_views, max(views) AS max_views,
       CAST(sum(likes) AS BIGINT) AS total_likes, CAST(sum(comments) AS BIGINT) AS total_comments,
       round(avg(engagement_rate), 6) AS avg_engagement_rate
FROM v GROUP BY publish_date ORDER BY publish_date DESC"""))
def daily_performance(spark, sf_dir):
    """A6 (table view)."""
    return present(rollup.daily_performance(videos(spark, sf_dir)))


@query("hourly_heatmap", with_videos(f"""
SELECT publish_day_of_week, publish_hour, {_GROUP4}
FROM v GROUP BY publish_day_of_week, publish_hour ORDER BY 1, 2"""))
def hourly_heatmap(spark, sf_dir):
    """A7 (table view)."""
    return present(rollup.hourly_heatmap(videos(spark, sf_dir)))


_MONTHLY_VIEW = """SELECT publish_month, count(*) AS video_count,
       CAST(sum(views) AS BIGINT) AS total_views, round(avg(views), 6) AS avg_views,
       CAST(sum(likes) AS BIGINT) AS total_likes, CAST(sum(comments) AS BIGINT) AS total_comments,
       round(avg(engagement_rate), 6) AS avg_engagement_rate
FROM v GROUP BY publish_month ORDER BY publish_month"""


@query("monthly_trends_view", with_videos(_MONTHLY_VIEW))
def monthly_trends_view(spark, sf_dir):
    """A8 (table view)."""
    return present(rollup.monthly_trends_view(videos(spark, sf_dir)))


@query("monthly_trends_view_lineitem", with_videos(_MONTHLY_VIEW, "lineitem", LINEITEM_AS_OF))
def monthly_trends_view_lineitem(spark, sf_dir):
    """A8 on lineitem."""
    return present(rollup.monthly_trends_view(videos_li(spark, sf_dir)))


@query("video_summary", with_videos("""
SELECT count(*) AS total_videos, CAST(sum(views) AS BIGINT) AS total_views,
       round(avg(views), 6) AS avg_views, max(views) AS max_views,
       round(avg(engagement_rate), 6) AS avg_engagement_rate
FROM v"""))
def video_summary(spark, sf_dir):
    """A9."""
    return present(rollup.video_summary(videos(spark, sf_dir)))


TREND_AS_OF = "2024-02-10 12:00:00"


@query("engagement_trend_30d", with_videos(f"""
SELECT publish_date AS time, round(avg(engagement_rate), 6) AS avg_engagement_rate
FROM v WHERE publish_date >= TIMESTAMP '{TREND_AS_OF}' - INTERVAL 30 DAY
GROUP BY publish_date ORDER BY publish_date"""))
def engagement_trend_30d(spark, sf_dir):
    """A11 with F3 and P18 (dashboard trend)."""
    return present(rollup.engagement_trend(videos(spark, sf_dir), as_of_literal(TREND_AS_OF)))


@query("heatmap_panel", with_videos("""
SELECT publish_day_of_week AS "Day of Week", publish_hour AS "Hour of Day",
       round(avg(views), 6) AS avg_views
FROM v GROUP BY publish_day_of_week, publish_hour ORDER BY 1, 2"""))
def heatmap_panel(spark, sf_dir):
    """A12."""
    return present(rollup.heatmap_panel(videos(spark, sf_dir)))


_MONTH_PANEL = """SELECT publish_month AS time,
       CAST(strptime(publish_month || '-01', '%Y-%m-%d') AS DATE) AS month_start,
       count(*) AS video_count, CAST(sum(views) AS BIGINT) AS total_views
FROM v GROUP BY publish_month ORDER BY publish_month"""


@query("monthly_panel", with_videos(_MONTH_PANEL))
def monthly_panel(spark, sf_dir):
    """A13."""
    return present(rollup.monthly_panel(videos(spark, sf_dir)))


@query("monthly_panel_lineitem", with_videos(_MONTH_PANEL, "lineitem", LINEITEM_AS_OF))
def monthly_panel_lineitem(spark, sf_dir):
    """A13 on lineitem."""
    return present(rollup.monthly_panel(videos_li(spark, sf_dir)))


@query("rollup_day_performance_lineitem", with_videos(f"""
SELECT publish_day, publish_day_of_week, {_GROUP4}
FROM v GROUP BY publish_day, publish_day_of_week""", "lineitem", LINEITEM_AS_OF))
def rollup_day_performance_lineitem(spark, sf_dir):
    """A1 through the shared base roll-up (date x hour partials) on lineitem."""
    base = rollup.BaseRollup.build(videos_li(spark, sf_dir), cache=False)
    return present(rollup.day_performance(base))


# -------------------------------------------------------------- top lists
_TOP_ALL = """SELECT video_id, title, publish_time, views, likes, comments,
       round(engagement_rate, 9) AS engagement_rate, publish_day, publish_hour, publish_date,
       publish_day_of_week, publish_month, round(likes_per_view, 9) AS likes_per_view,
       round(comments_per_view, 9) AS comments_per_view, round(views_per_day, 6) AS views_per_day
FROM v ORDER BY views DESC, video_id LIMIT 10"""


@query("top_videos_10", with_videos(_TOP_ALL))
def top_videos_10(spark, sf_dir):
    """L1: processed top list, all columns."""
    return present(topk.top_videos(videos(spark, sf_dir)), per_column=RATE_DIGITS)


@query("top_videos_100", with_videos("""
SELECT video_id, title, publish_time, views, likes, comments,
       round(engagement_rate, 9) AS engagement_rate, publish_day, publish_hour
FROM v ORDER BY views DESC, video_id LIMIT 100"""))
def top_videos_100(spark, sf_dir):
    """L2: table view, nine columns."""
    return present(topk.top_videos_view(videos(spark, sf_dir)), per_column=RATE_DIGITS)


@query("top_videos_5", with_videos("""
SELECT title, views, round(engagement_rate, 9) AS engagement_rate, publish_time
FROM v ORDER BY views DESC, video_id LIMIT 5"""))
def top_videos_5(spark, sf_dir):
    """L3: report list."""
    return present(topk.top_videos_report(videos(spark, sf_dir)), per_column=RATE_DIGITS)


@query("top_videos_panel", with_videos("""
SELECT title, views FROM v ORDER BY views DESC, video_id LIMIT 10"""))
def top_videos_panel(spark, sf_dir):
    """L4: dashboard list."""
    return present(topk.top_videos_panel(videos(spark, sf_dir)))


@query("latest_channel_snapshot", with_channels("""
SELECT channel_title, subscribers, total_views, video_count, captured_at
FROM ch ORDER BY captured_at DESC, channel_id LIMIT 1"""))
def latest_channel_snapshot(spark, sf_dir):
    """Newest snapshot across channels."""
    return present(topk.latest_snapshot(channel_table(spark, sf_dir)))


@query("latest_snapshot_per_channel", with_channels("""
SELECT channel_id, captured_at, channel_title, subscribers, total_views, video_count
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id
                                   ORDER BY captured_at DESC, channel_title DESC,
                                            subscribers DESC, total_views DESC,
                                            video_count DESC) AS rn
      FROM ch) WHERE rn = 1"""))
def latest_snapshot_per_channel(spark, sf_dir):
    """L5, per channel."""
    return present(topk.latest_per_channel(channel_table(spark, sf_dir)))


@query("subscribers_over_time", with_channels("""
SELECT captured_at AS time, subscribers FROM ch ORDER BY captured_at"""))
def subscribers_over_time(spark, sf_dir):
    """L6."""
    return present(topk.subscribers_over_time(channel_table(spark, sf_dir)))


@query("total_views_over_time", with_channels("""
SELECT captured_at AS time, total_views FROM ch ORDER BY captured_at"""))
def total_views_over_time(spark, sf_dir):
    """L7."""
    return present(topk.total_views_over_time(channel_table(spark, sf_dir)))


# ---------------------------------------------------------------- filters
F1_AS_OF = "2001-08-01 00:00:00"


@query("recent_channels_2d", with_channels(f"""
SELECT captured_at, channel_id, channel_title, subscribers, total_views, video_count
FROM ch WHERE captured_at >= TIMESTAMP '{F1_AS_OF}' - INTERVAL 2 DAY"""))
def recent_channels_2d(spark, sf_dir):
    """snapshots of the last two days."""
    return present(filters.recent_channels(channel_table(spark, sf_dir), as_of_literal(F1_AS_OF)))


@query("recent_videos_2d", with_videos(f"""
SELECT video_id, publish_time, views
FROM v WHERE publish_time >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 DAY"""))
def recent_videos_2d(spark, sf_dir):
    """F2 on the publish time of the stand-in (no load stamps in the tables)."""
    v = videos(spark, sf_dir)
    r = filters.recent_videos(v, events_as_of(), column="publish_time")
    return present(r.select("video_id", "publish_time", "views"))


@query("published_last_30d", with_videos(f"""
SELECT video_id, publish_date, views
FROM v WHERE publish_date >= TIMESTAMP '{TREND_AS_OF}' - INTERVAL 30 DAY"""))
def published_last_30d(spark, sf_dir):
    """F3 with P18."""
    v = filters.published_since(videos(spark, sf_dir), as_of_literal(TREND_AS_OF))
    return present(v.select("video_id", "publish_date", "views"))


@query("channel_time_range", with_channels("""
SELECT captured_at AS time, subscribers FROM ch
WHERE captured_at >= TIMESTAMP '1999-01-01 00:00:00'
  AND captured_at <= TIMESTAMP '1999-12-31 23:59:59'
ORDER BY captured_at"""))
def channel_time_range(spark, sf_dir):
    """dashboard series with a time range."""
    return present(topk.subscribers_over_time(channel_table(spark, sf_dir),
                                              "1999-01-01 00:00:00", "1999-12-31 23:59:59"))


@query("fresh_counts", f"""
WITH {CHANNEL_CTE}
SELECT (SELECT count(*) FROM ch WHERE captured_at >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 DAY)
         AS recent_channels,
       (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 DAY)
         AS recent_videos""")
def fresh_counts(spark, sf_dir):
    """A10: recent channel snapshots and recent videos in one row."""
    return filters.fresh_counts(channel_table(spark, sf_dir), videos(spark, sf_dir),
                                events_as_of(), video_column="publish_time")
