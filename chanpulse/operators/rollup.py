"""Grouped analytics over videos (day, hour, month, heatmap, summaries).

Every grouped analytic is a roll-up of decomposable measures (count, sums,
non-null counts, max, min).  ``partials`` computes them at any set of keys;
``coarsen`` re-aggregates partials at coarser keys.  An analytic therefore
runs either straight from the video frame (one partial+final hash aggregate,
map-side combine before the shuffle) or from a :class:`BaseRollup` built once
per run at the finest grain the analytics need (date x hour), whose size is
bounded by days x 24 rows regardless of the number of videos.  Averages are
sum / non-null count, so both paths give the same numbers up to float sum
order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import minus_days, month_start

# Finest grain needed by any analytic.  The weekday name, weekday number and
# month are functions of the date, so they add no groups; they are kept as
# keys so that values read from a file are grouped as they are.
GRAIN = ["publish_date", "publish_hour", "publish_day", "publish_day_of_week",
         "publish_month"]

# partial measure -> (aggregate over videos, aggregate over partials); built
# lazily because Column objects need a running session.
_PARTIALS: dict[str, tuple] = {}


def _def(name: str, raw, merge) -> None:
    _PARTIALS[name] = (lambda: raw().alias(name), lambda: merge().alias(name))


_def("n", lambda: F.count(F.lit(1)), lambda: F.sum("n"))
_def("views_sum", lambda: F.sum("views"), lambda: F.sum("views_sum"))
_def("views_n", lambda: F.count("views"), lambda: F.sum("views_n"))
_def("views_max", lambda: F.max("views"), lambda: F.max("views_max"))
_def("likes_sum", lambda: F.sum("likes"), lambda: F.sum("likes_sum"))
_def("comments_sum", lambda: F.sum("comments"), lambda: F.sum("comments_sum"))
_def("er_sum", lambda: F.sum("engagement_rate"), lambda: F.sum("er_sum"))
_def("er_n", lambda: F.count("engagement_rate"), lambda: F.sum("er_n"))
_def("er_max", lambda: F.max("engagement_rate"), lambda: F.max("er_max"))
_def("er_min", lambda: F.min("engagement_rate"), lambda: F.min("er_min"))
_def("lpv_sum", lambda: F.sum("likes_per_view"), lambda: F.sum("lpv_sum"))
_def("lpv_n", lambda: F.count("likes_per_view"), lambda: F.sum("lpv_n"))
_def("cpv_sum", lambda: F.sum("comments_per_view"), lambda: F.sum("cpv_sum"))
_def("cpv_n", lambda: F.count("comments_per_view"), lambda: F.sum("cpv_n"))

# measures that need likes/comments-per-view only exist on processed frames
_OPTIONAL_INPUT = {"lpv_sum": "likes_per_view", "lpv_n": "likes_per_view",
                   "cpv_sum": "comments_per_view", "cpv_n": "comments_per_view"}


_FOUR = ["n", "views_sum", "views_n", "er_sum", "er_n"]
_ALL_VIEW = _FOUR + ["views_max", "likes_sum", "comments_sum"]


@dataclass(frozen=True)
class BaseRollup:
    """Partials at :data:`GRAIN`; build once, derive every grouped analytic."""
    df: DataFrame

    @staticmethod
    def build(videos: DataFrame, cache: bool = True) -> "BaseRollup":
        r = partials(videos, GRAIN)
        return BaseRollup(r.cache() if cache else r)


Source = DataFrame | BaseRollup


def partials(videos: DataFrame, keys: list[str], only: list[str] | None = None) -> DataFrame:
    """Partial measures of ``videos`` grouped by ``keys`` (no keys: one row);
    all of them, or ``only`` those named."""
    cols = set(videos.columns)
    skip = {m for m, c in _OPTIONAL_INPUT.items() if c not in cols}
    names = [n for n in (only or _PARTIALS) if n not in skip]
    return videos.groupBy(*keys).agg(*[_PARTIALS[n][0]() for n in names])


def coarsen(rollup: DataFrame, keys: list[str], only: list[str] | None = None) -> DataFrame:
    cols = set(rollup.columns)
    names = [n for n in (only or _PARTIALS) if n in cols]
    return rollup.groupBy(*keys).agg(*[_PARTIALS[n][1]() for n in names])


def grouped(src: Source, keys: list[str], where: Column | None = None,
            only: list[str] | None = None) -> DataFrame:
    """Partials at ``keys`` from either a video frame or a base roll-up.
    ``where`` may only reference grain columns (it is applied before grouping)."""
    if isinstance(src, BaseRollup):
        base = src.df if where is None else src.df.filter(where)
        return coarsen(base, keys, only)
    base = src if where is None else src.filter(where)
    return partials(base, keys, only)


def calendar_sorted(df: DataFrame, *order) -> DataFrame:
    """Order a finished result (weekdays, hours, days, months).  A plain sort: the
    keys come from files that no rule has seen yet, so nothing bounds their number,
    and adaptive execution puts the few rows of a clean file into one task anyway."""
    return df.orderBy(*order)


def _avg(s: str, n: str) -> Column:
    return F.try_divide(F.col(s), F.col(n))


# finished measures, by output name
def _video_count():
    return F.col("n").alias("video_count")


def _avg_views():
    return _avg("views_sum", "views_n").alias("avg_views")


def _total_views():
    return F.col("views_sum").alias("total_views")


def _avg_er(name: str = "avg_engagement_rate"):
    return _avg("er_sum", "er_n").alias(name)


def day_performance(src: Source) -> DataFrame:
    """(publish_day, publish_day_of_week) -> count, avg views, avg engagement,
    total views; ordered by day of week."""
    keys = ["publish_day", "publish_day_of_week"]
    return calendar_sorted(
        grouped(src, keys, only=_FOUR).select(*keys, _video_count(), _avg_views(), _avg_er(),
                                              _total_views()),
        "publish_day_of_week")


def hour_performance(src: Source) -> DataFrame:
    return calendar_sorted(
        grouped(src, ["publish_hour"], only=_FOUR)
        .select("publish_hour", _video_count(), _avg_views(), _avg_er(), _total_views()),
        "publish_hour")


def monthly_trends(src: Source) -> DataFrame:
    """Processed-output form: month -> count, avg views, avg engagement,
    total views, total likes, total comments."""
    return calendar_sorted(
        grouped(src, ["publish_month"], only=_FOUR + ["likes_sum", "comments_sum"])
        .select("publish_month", _video_count(), _avg_views(), _avg_er(), _total_views(),
                F.col("likes_sum").alias("total_likes"),
                F.col("comments_sum").alias("total_comments")),
        "publish_month")


def engagement_stats(src: Source) -> DataFrame:
    """One row: avg/max/min engagement, avg likes and comments per view."""
    g = grouped(src, [], only=["er_sum", "er_n", "er_max", "er_min", "lpv_sum", "lpv_n",
                               "cpv_sum", "cpv_n"])
    return g.select(
        _avg_er("avg_engagement"),
        F.col("er_max").alias("max_engagement"),
        F.col("er_min").alias("min_engagement"),
        _avg("lpv_sum", "lpv_n").alias("avg_likes_per_view"),
        _avg("cpv_sum", "cpv_n").alias("avg_comments_per_view"))


def run_summary(src: Source, channels: DataFrame) -> DataFrame:
    """One row: channel rows, video rows, average engagement, average views.

    The two one-row aggregates are stacked and folded by a global ``max``
    (no cross join)."""
    v = grouped(src, [], only=_FOUR).select(
        F.lit(None).cast("long").alias("channel_records"),
        F.col("n").alias("video_records"),
        _avg_er("avg_engagement"), _avg_views())
    c = channels.agg(F.count(F.lit(1)).alias("channel_records"))
    both = v.unionByName(c, allowMissingColumns=True)
    return both.agg(*[F.max(x).alias(x) for x in
                      ("channel_records", "video_records", "avg_engagement", "avg_views")])


def daily_performance(src: Source) -> DataFrame:
    """Table view: publish_date -> count, total/avg/max views, total likes,
    total comments, avg engagement; newest first."""
    return calendar_sorted(
        grouped(src, ["publish_date"], only=_ALL_VIEW)
        .select("publish_date", _video_count(), _total_views(), _avg_views(),
                F.col("views_max").alias("max_views"),
                F.col("likes_sum").alias("total_likes"),
                F.col("comments_sum").alias("total_comments"), _avg_er()),
        F.col("publish_date").desc())


def hourly_heatmap(src: Source) -> DataFrame:
    keys = ["publish_day_of_week", "publish_hour"]
    return calendar_sorted(
        grouped(src, keys, only=_FOUR).select(*keys, _video_count(), _avg_views(), _avg_er(),
                                              _total_views()),
        *keys)


def monthly_trends_view(src: Source) -> DataFrame:
    """Table view form of the monthly trends (column order of the view)."""
    return calendar_sorted(
        grouped(src, ["publish_month"], only=_FOUR + ["likes_sum", "comments_sum"])
        .select("publish_month", _video_count(), _total_views(), _avg_views(),
                F.col("likes_sum").alias("total_likes"),
                F.col("comments_sum").alias("total_comments"), _avg_er()),
        "publish_month")


def video_summary(src: Source) -> DataFrame:
    """One row: total videos, total/avg/max views, avg engagement."""
    return grouped(src, [], only=_FOUR + ["views_max"]).select(
        F.col("n").alias("total_videos"), _total_views(), _avg_views(),
        F.col("views_max").alias("max_views"), _avg_er())


def engagement_trend(src: Source, as_of: Column, days: int = 30) -> DataFrame:
    """Dashboard trend: videos published since ``as_of - days`` (a DATE
    compared with a timestamp, so the boundary day counts only at midnight),
    publish_date -> avg engagement, oldest first."""
    since = F.col("publish_date") >= minus_days(as_of, days)
    return calendar_sorted(
        grouped(src, ["publish_date"], where=since, only=["er_sum", "er_n"])
        .select(F.col("publish_date").alias("time"), _avg_er()),
        "time")


def heatmap_panel(src: Source) -> DataFrame:
    keys = ["publish_day_of_week", "publish_hour"]
    return calendar_sorted(
        grouped(src, keys, only=["views_sum", "views_n"]).select(
            F.col("publish_day_of_week").alias("Day of Week"),
                                  F.col("publish_hour").alias("Hour of Day"), _avg_views()),
        "Day of Week", "Hour of Day")


def monthly_panel(src: Source) -> DataFrame:
    """month -> count, total views; the ``yyyy-MM`` key is kept as ``time``
    and its first day is added as a DATE (``month_start``)."""
    return calendar_sorted(
        grouped(src, ["publish_month"], only=["n", "views_sum"]).select(
            F.col("publish_month").alias("time"),
            month_start("publish_month").alias("month_start"),
            _video_count(), _total_views()),
        "time")


ANALYTICS = {
    "day_performance": day_performance,
    "hour_performance": hour_performance,
    "monthly_trends": monthly_trends,
    "engagement_stats": engagement_stats,
}
