"""The whole daily run: tables -> extract -> transform -> load -> check -> report.

Extract reads landed API replies (``<landed>/channels``, ``/search``,
``/videos`` as JSON lines), collects the videos of all search pages (or, with
``max_videos``, of those read until so many were found), and writes the raw
CSV snapshots the transform step reads.  Replies that can't be used are
written to ``<raw>/rejects`` and counted, as are unusable CSV records.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.collect import collect_videos
from ..functions.derive import as_of_literal
from ..schemas import RAW_VIDEOS
from ..session import run_jobs
from ..sources import api_json, csv, parquet, snapshots
from .load import LoadResult, load, warehouse
from .quality import quality_check
from .report import summary_report
from .transform import TransformResult, transform


@dataclass
class RunResult:
    raw: tuple[str, str | None]
    reply_rejects: dict[str, int]
    transform: TransformResult
    load: LoadResult
    fresh: dict
    report: DataFrame
    warehouse_dir: str


def extract(spark: SparkSession, landed_dir: str, raw_dir: str, stamp: str,
            max_videos: int | None = None,
            captured_at: dt.datetime | None = None) -> tuple[tuple[str, str | None], dict[str, int]]:
    """Paths of the raw snapshots, and the numbers of rejected replies.  Replies are parsed
    once, into usable rows and rejects; everything after reads those.  Channel
    requests that landed without a capture time take ``captured_at``."""
    d = landed_dir.rstrip("/")
    land = lambda kind: api_json.read_landed(spark, f"{d}/{kind}", kind)
    channels, details = run_jobs([
        lambda: api_json.channel_replies(land("channels"), captured_at=as_of_literal(captured_at))
        .parted("channel-replies"),
        lambda: api_json.video_rows(land("videos")).parted("video-replies")])
    ids = api_json.search_ids(land("search"))
    videos = collect_videos(ids.select("page", "video_id"), details.rows, cap=max_videos)
    paths = csv.save_snapshots(channels.rows, one_row_per_id(videos), raw_dir, stamp)
    return paths, parquet.save_rejects({"channel_stats": channels.rejects,
                                        "videos": details.rejects}, f"{raw_dir}/rejects", stamp)


def one_row_per_id(videos: DataFrame) -> DataFrame:
    """An id listed on several pages is one video of the snapshot (its rows agree)."""
    return videos.select(*RAW_VIDEOS.fieldNames()).dropDuplicates(["video_id"])


def run(spark: SparkSession, landed_dir: str, work_dir: str, as_of: dt.datetime | None = None,
        loader: str = "full", max_videos: int | None = None, video_buckets: int = 16,
        on_duplicate: str = "error", database: str | None = None) -> RunResult:
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = as_of.strftime(snapshots.STAMP_FORMAT)
    w = work_dir.rstrip("/")
    wh = warehouse(spark, f"{w}/warehouse", video_buckets, database=database)
    raw, rejected = extract(spark, landed_dir, f"{w}/raw", stamp, max_videos, as_of)
    tr = transform(spark, f"{w}/raw", f"{w}/processed", as_of, stamp)
    ld = load(spark, f"{w}/processed", f"{w}/warehouse", as_of, loader,
              video_buckets=video_buckets, on_duplicate=on_duplicate, database=database)
    fresh = quality_check(wh, as_of)
    rep = summary_report(wh.channels.read(), wh.videos.read())
    return RunResult(raw, rejected, tr, ld, fresh, rep, f"{w}/warehouse")
