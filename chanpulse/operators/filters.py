"""Time filters.  All are plain predicates, so Catalyst pushes them into the
Parquet scan (row-group min/max skipping on the time column).  Where the frame has the
partition column of that time (the month it lies in), the bound is put on it as well, and the
scan reads the folders of those months only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import minus_days
from ..schemas import FRESH_DAYS, MONTHS, TREND_DAYS


def recent(df: DataFrame, column: str, as_of: Column, days: int = FRESH_DAYS) -> DataFrame:
    """Rows whose ``column`` is at or after ``as_of - days``."""
    return since(df, column, minus_days(as_of, days))


def since(df: DataFrame, column: str, bound: Column) -> DataFrame:
    """Rows whose ``column`` is at or after ``bound``."""
    kept = F.col(column) >= bound
    month = MONTHS.get(column)
    if month in df.columns:
        kept = kept & (F.col(month) >= F.trunc(bound, "month"))
    return df.filter(kept)


def recent_channels(channels: DataFrame, as_of: Column, days: int = FRESH_DAYS) -> DataFrame:
    return recent(channels, "captured_at", as_of, days)


def recent_videos(videos: DataFrame, as_of: Column, days: int = FRESH_DAYS,
                  column: str = "created_at") -> DataFrame:
    return recent(videos, column, as_of, days)


def published_since(videos: DataFrame, as_of: Column, days: int = TREND_DAYS) -> DataFrame:
    """``publish_date >= as_of - days``: a DATE against a timestamp, so the
    boundary day is kept only when ``as_of`` is at midnight."""
    return recent(videos, "publish_date", as_of, days)


def time_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Optional closed range on a time column; no bound given, no filter."""
    if start is not None:
        df = since(df, column, F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("timestamp"))
    return df


def fresh_counts(channels: DataFrame, videos: DataFrame, as_of: Column,
                 days: int = FRESH_DAYS, video_column: str = "created_at") -> DataFrame:
    """One row: recent channel snapshots and recent videos.  Each side is a
    pushed-down filter and a count (partial aggregate per task), so the scan
    skips the history; the two one-row results are stacked and folded, no
    cross join."""
    n = F.count(F.lit(1))
    c = recent(channels, "captured_at", as_of, days).agg(n.alias("recent_channels"))
    v = recent(videos, video_column, as_of, days).agg(n.alias("recent_videos"))
    both = c.unionByName(v, allowMissingColumns=True)
    return both.agg(F.max("recent_channels").alias("recent_channels"),
                    F.max("recent_videos").alias("recent_videos"))
