"""Summary report as a frame of ``(section, ordinal, line)``; printing it is
the caller's job.  Every section reads a bounded result (one snapshot row,
one summary row, five top rows), so the report costs three small jobs'
worth of scans however large the tables are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fixed4, short_title, stamp_text, thousands
from ..operators import rollup, topk
from .. import schemas as S


def _txt(c: Column) -> Column:
    """Missing values print as ``None``."""
    return F.coalesce(c, F.lit("None"))


def _lines(df: DataFrame, section: str, lines: list[Column]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), l.alias("line"))
                    for i, l in enumerate(lines)])
    return (df.select(F.inline(arr))
            .select(F.lit(section).alias("section"), "ordinal", "line"))


def _labelled(labels, values: list[Column]) -> list[Column]:
    return [F.concat(F.lit(label), _txt(v)) for label, v in zip(labels, values, strict=True)]


def channel_section(channels: DataFrame) -> DataFrame:
    snap = topk.latest_snapshot(channels)
    return _lines(snap, "channel", _labelled(S.REPORT_CHANNEL_LABELS, [
        F.col("channel_title"), thousands("subscribers"), thousands("total_views"),
        thousands("video_count"), stamp_text("captured_at")]))


def video_section(videos) -> DataFrame:
    s = rollup.video_summary(videos)
    return _lines(s, "videos", _labelled(S.REPORT_VIDEO_LABELS, [
        thousands("total_videos"), thousands("total_views"), thousands("avg_views"),
        thousands("max_views"), fixed4(F.col("avg_engagement_rate").cast("double"))]))


def top_section(videos: DataFrame, k: int = S.TOP_REPORT) -> DataFrame:
    top = topk.top_videos(videos, k, ["video_id", "title", "views", "engagement_rate"])
    w = Window.orderBy(F.col("views").desc_nulls_last(), F.col("video_id").asc_nulls_last())
    line = F.format_string(S.REPORT_TOP_LINE, F.row_number().over(w), _txt(short_title("title")),
                           _txt(thousands("views")),
                           _txt(fixed4(F.col("engagement_rate").cast("double"))))
    return top.select(F.lit("top").alias("section"),
                      F.row_number().over(w).alias("ordinal"), line.alias("line"))


def summary_report(channels: DataFrame, videos: DataFrame) -> DataFrame:
    return (channel_section(channels)
            .unionByName(video_section(videos))
            .unionByName(top_section(videos)))


def render(report: DataFrame) -> str:
    """Text of a (small, bounded) report frame."""
    order = {"channel": 0, "videos": 1, "top": 2}
    rows = sorted(report.collect(), key=lambda r: (order.get(r["section"], 9), r["ordinal"]))
    head = ["=" * 60, "CHANNEL ANALYTICS SUMMARY REPORT", "=" * 60]
    body = []
    for r in rows:
        if r["section"] == "videos" and r["ordinal"] == 1:
            body.append("\n" + S.REPORT_VIDEO_HEADING)
        if r["section"] == "top" and r["ordinal"] == 1:
            body.append("\n" + S.REPORT_TOP_HEADING)
        body.append(r["line"])
    return "\n".join(head + body + ["=" * 60])
