"""Top lists, latest snapshots and time series.

Top-k is ``orderBy(...).limit(k)``, which Catalyst plans as
``TakeOrderedAndProject``: every task keeps its own k best rows and one task
merges (#tasks x k) rows, so no global sort of the input.  Ties on views are
broken by ``video_id`` ascending so the list is deterministic.

On request (``prefilter``) the top list of a stored ``views`` column is taken
in two passes.  The first reads that column alone and finds the k-th largest
value t.  The second keeps ``views >= t``, a plain comparison that reaches the
Parquet scan, where the min/max statistics skip every row group whose largest
value is below t.  Every row of the true top list has views >= t, so the
result is the same rows, ties and NULLs included (with fewer than k non-NULL
views no filter is applied).  Where ``views`` is computed, the statistics know
nothing of it and one pass is better; that is the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import time_range
from .upsert import keep_last
from ..schemas import TOP_PANEL, TOP_PROCESSED, TOP_REPORT, TOP_VIEW

VIEW_COLUMNS = ["video_id", "title", "publish_time", "views", "likes", "comments",
                "engagement_rate", "publish_day", "publish_hour"]
REPORT_COLUMNS = ["title", "views", "engagement_rate", "publish_time"]
PANEL_COLUMNS = ["title", "views"]
SNAPSHOT_COLUMNS = ["channel_title", "subscribers", "total_views", "video_count",
                    "captured_at"]


def _by_views() -> list[Column]:
    return [F.col("views").desc_nulls_last(), F.col("video_id").asc_nulls_last()]



def kth_largest(df: DataFrame, column: str, k: int) -> Column | None:
    """The k-th largest non-NULL value of ``column`` as a literal (None when
    there are fewer than k); one narrow top-k job, k values reach the driver.
    A timestamp travels as epoch microseconds, never as a local-time Python
    datetime (exact in any driver time zone, daylight-saving hours included);
    ``timestamp_micros`` of a literal folds to a constant, so a comparison
    with it still reaches the Parquet scan."""
    c = F.col(column)
    is_ts = isinstance(df.schema[column].dataType, T.TimestampType)
    value = F.unix_micros(c) if is_ts else c
    rows = (df.filter(c.isNotNull()).select(value.alias("_v"))
            .orderBy(F.col("_v").desc()).limit(k).collect())
    if len(rows) < k:
        return None
    v = rows[-1][0]
    return F.timestamp_micros(F.lit(v)) if is_ts else F.lit(v)


def top_videos(videos: DataFrame, k: int = TOP_PROCESSED,
               columns: list[str] | None = None, prefilter: bool = False) -> DataFrame:
    """The ``k`` most viewed videos (all columns unless ``columns``).
    ``prefilter``: take the two-pass plan (module notes)."""
    src = videos
    if prefilter:
        t = kth_largest(videos, "views", k)
        if t is not None:
            src = videos.filter(F.col("views") >= t)
    top = src.orderBy(*_by_views()).limit(k)
    return top.select(*columns) if columns else top


def top_videos_view(videos: DataFrame) -> DataFrame:
    """Table view: top 100, nine columns."""
    return top_videos(videos, TOP_VIEW, VIEW_COLUMNS)


def top_videos_report(videos: DataFrame) -> DataFrame:
    """Report: top 5 with title, views, engagement and publish time."""
    return top_videos(videos, TOP_REPORT, REPORT_COLUMNS)


def top_videos_panel(videos: DataFrame) -> DataFrame:
    """Dashboard: top 10 titles and views."""
    return top_videos(videos, TOP_PANEL, PANEL_COLUMNS)


def latest_snapshot(channels: DataFrame, columns: list[str] | None = None,
                    prefilter: bool = False) -> DataFrame:
    """The newest channel snapshot across channels (one row); equal capture
    times are broken by channel_id.  With ``prefilter`` (as for the top
    lists) the newest capture time is found first from that column alone,
    and the scan then keeps only row groups that can hold it."""
    cols = columns or SNAPSHOT_COLUMNS
    src = channels
    if prefilter:
        t = kth_largest(channels, "captured_at", 1)
        if t is not None:
            src = channels.filter(F.col("captured_at") >= t)
    return (src.orderBy(F.col("captured_at").desc_nulls_last(),
                        F.col("channel_id").asc_nulls_last())
            .limit(1).select(*cols))


def latest_per_channel(channels: DataFrame) -> DataFrame:
    """The newest snapshot of every channel (see :func:`keep_last`); of equal
    capture times the one with the greatest remaining columns."""
    return keep_last(channels, ["channel_id"], "captured_at").select(
        "channel_id", "captured_at",
        *[c for c in channels.columns if c not in ("channel_id", "captured_at")])


def series(channels: DataFrame, measure: str, start=None, end=None) -> DataFrame:
    """Dashboard series: ``captured_at AS time`` and one measure, oldest
    first, optionally restricted to ``[start, end]`` (inactive by default)."""
    df = time_range(channels.select("captured_at", measure), "captured_at", start, end)
    return df.select(F.col("captured_at").alias("time"), measure).orderBy("time")


def subscribers_over_time(channels: DataFrame, start=None, end=None) -> DataFrame:
    return series(channels, "subscribers", start, end)


def total_views_over_time(channels: DataFrame, start=None, end=None) -> DataFrame:
    return series(channels, "total_views", start, end)
