"""Schemas, column defaults and the fixed values the rules check against."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# --- fixed values (must equal the reference's for equal results) -------------
# Decimal shapes of the table columns: rates DECIMAL(10,6), pace DECIMAL(15,2).
RATE_DECIMAL = DecimalType(10, 6)
PACE_DECIMAL = DecimalType(15, 2)
# Text length limits: channel_id 50, video_id 50, channel_title 255,
# publish_day 20, publish_month 10.
TEXT_LIMITS = {"channel_id": 50, "video_id": 50, "channel_title": 255,
               "publish_day": 20, "publish_month": 10}
# Value ranges: publish_hour 0..23, publish_day_of_week 1..7 (1 = Sunday).
HOUR_RANGE = (0, 23)
WEEKDAY_RANGE = (1, 7)
# Freshness windows in days (channel snapshots, videos), trend window in days.
FRESH_DAYS = 2
TREND_DAYS = 30
# Top-k sizes: processed top list 10, table view 100, report 5, dashboard 10.
TOP_PROCESSED, TOP_VIEW, TOP_REPORT, TOP_PANEL = 10, 100, 5, 10
# Report title cut: 50 characters followed by "...".
REPORT_TITLE_CHARS = 50
# Ingest: 50 ids per search page, 100 videos collected per run.
PAGE_SIZE, MAX_VIDEOS = 50, 100
# Snapshot names: <entity>_<yyyyMMdd>_<HHmmss>.<ext> (the stamp in strftime form).
SNAPSHOT_STAMP_FORMAT = "%Y%m%d_%H%M%S"
# Weekday name: the full English name ("Saturday"); month key "2025-11" (Spark patterns).
WEEKDAY_NAME_PATTERN = "EEEE"
MONTH_KEY_PATTERN = "yyyy-MM"
# Report text, in report order.  Channel and video lines are "<label><value>";
# a top line is "<n>. <title cut>... - <views> views (ER: <rate>)", whose
# pattern stands below.
REPORT_CHANNEL_LABELS = ("Channel: ", "Subscribers: ", "Total Views: ", "Video Count: ",
                         "Last Updated: ")
REPORT_VIDEO_HEADING = "Video Statistics:"
REPORT_VIDEO_LABELS = ("Total Videos: ", "Total Views: ", "Average Views: ", "Max Views: ",
                       "Average Engagement Rate: ")
REPORT_TOP_HEADING = "Top 5 Videos:"
REPORT_TOP_LINE = "%d. %s - %s views (ER: %s)"
# ------------------------------------------------------------------------------

INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1

# Raw CSV snapshots.  Counters are 64-bit (a 32-bit read turns 3e9 into NULL).
RAW_CHANNEL = StructType([
    StructField("captured_at", StringType()),
    StructField("channel_id", StringType()),
    StructField("channel_title", StringType()),
    StructField("subscribers", LongType()),
    StructField("total_views", LongType()),
    StructField("video_count", LongType()),
])

RAW_VIDEOS = StructType([
    StructField("video_id", StringType()),
    StructField("title", StringType()),
    StructField("publish_time", StringType()),
    StructField("views", LongType()),
    StructField("likes", LongType()),
    StructField("comments", LongType()),
    StructField("engagement_rate", DoubleType()),
    StructField("publish_day", StringType()),
    StructField("publish_hour", IntegerType()),
])

CHANNEL_COLUMNS = [f.name for f in RAW_CHANNEL.fields]
RAW_VIDEO_COLUMNS = [f.name for f in RAW_VIDEOS.fields]
DERIVED_VIDEO_COLUMNS = ["publish_date", "publish_day_of_week", "publish_month",
                         "likes_per_view", "comments_per_view", "views_per_day"]
PROCESSED_VIDEO_COLUMNS = RAW_VIDEO_COLUMNS + DERIVED_VIDEO_COLUMNS

# Warehouse tables (typed like the SQL DDL; counters stay 64-bit, see rules).
CHANNEL_TABLE = StructType([
    StructField("id", LongType()),
    StructField("captured_at", TimestampType()),
    StructField("channel_id", StringType()),
    StructField("channel_title", StringType()),
    StructField("subscribers", LongType()),
    StructField("total_views", LongType()),
    StructField("video_count", IntegerType()),
    StructField("created_at", TimestampType()),
])
# The partition column of each table: the month of a time that a stored row never changes.
MONTHS = {"captured_at": "captured_month", "created_at": "created_month"}
CHANNEL_KEYS = ["channel_id", "captured_at"]
CHANNEL_UPDATE = ["channel_title", "subscribers", "total_views", "video_count"]

VIDEO_TABLE = StructType([
    StructField("id", LongType()),
    StructField("video_id", StringType()),
    StructField("title", StringType()),
    StructField("publish_time", TimestampType()),
    StructField("views", LongType()),
    StructField("likes", LongType()),
    StructField("comments", LongType()),
    StructField("engagement_rate", RATE_DECIMAL),
    StructField("publish_day", StringType()),
    StructField("publish_hour", IntegerType()),
    StructField("likes_per_view", RATE_DECIMAL),
    StructField("comments_per_view", RATE_DECIMAL),
    StructField("views_per_day", PACE_DECIMAL),
    StructField("publish_date", DateType()),
    StructField("publish_day_of_week", IntegerType()),
    StructField("publish_month", StringType()),
    StructField("created_at", TimestampType()),
    StructField("updated_at", TimestampType()),
])
VIDEO_KEYS = ["video_id"]
# Full upsert: every source column but publish_time; created_at kept.
VIDEO_UPDATE_FULL = ["title", "views", "likes", "comments", "engagement_rate",
                     "publish_day", "publish_hour", "likes_per_view",
                     "comments_per_view", "views_per_day", "publish_date",
                     "publish_day_of_week", "publish_month"]
# Narrow upsert (the deployed loader): title and views only.
VIDEO_UPDATE_NARROW = ["title", "views"]

# Column defaults applied when the source lacks the column (never over NULLs).
VIDEO_DEFAULTS = {"views": 0, "likes": 0, "comments": 0, "engagement_rate": 0.0,
                  "likes_per_view": 0.0, "comments_per_view": 0.0,
                  "views_per_day": 0.0}

# NOT NULL columns of each table (everything but the stamps with defaults).
CHANNEL_NOT_NULL = ["captured_at", "channel_id", "channel_title", "subscribers",
                    "total_views", "video_count"]
VIDEO_NOT_NULL = ["video_id", "title", "publish_time", "views", "likes",
                  "comments", "engagement_rate", "publish_day", "publish_hour",
                  "likes_per_view", "comments_per_view", "views_per_day",
                  "publish_date", "publish_day_of_week", "publish_month"]

# name stamp of the snapshot file that a stored row's values are of (streamed loads)
SOURCE_STAMP = "source_stamp"
