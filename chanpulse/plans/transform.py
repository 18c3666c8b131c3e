"""Transform job: newest raw snapshots -> processed entities + analytics.

Plan for scale: each CSV snapshot is parsed exactly once, into Parquet parted by whether
a record can be used; the processed dataset and the rejects are read back from their own
part.  Everything else reads the processed Parquet (columnar,
pruned to the columns each output needs): the top list is one
``TakeOrderedAndProject`` scan, and all grouped analytics derive from one base
roll-up (date x hour partials, days x 24 rows on clean input) built by one scan and
one shuffle and cached.  Writing the processed data first also cuts the
lineage: a lost executor re-reads Parquet, not the CSV.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..functions.derive import as_of_literal
from ..operators import rollup, topk
from ..session import run_jobs
from ..sources import csv, parquet, snapshots


@dataclass
class TransformResult:
    paths: dict[str, str]
    summary: dict = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)  # rows set aside, by entity


def _stamp(as_of) -> str:
    if isinstance(as_of, dt.datetime):
        return as_of.strftime(snapshots.STAMP_FORMAT)
    return dt.datetime.now().strftime(snapshots.STAMP_FORMAT)


def transform(spark: SparkSession, raw_dir: str, out_dir: str, as_of=None,
              stamp: str | None = None, policy: str = "name",
              rejects_dir: str | None = None, use_rollup: bool = True,
              multiline: bool = False) -> TransformResult:
    """Records that can't be used are written to ``rejects_dir`` (by default
    ``<out_dir>/rejects``), with the reason and their text, and counted."""
    ch_path = snapshots.require_snapshot(spark, raw_dir, "channel_stats", "csv", policy)
    v_path = snapshots.require_snapshot(spark, raw_dir, "videos", "csv", policy)
    now = as_of_literal(as_of)
    stamp = stamp or _stamp(as_of)

    channels, videos = run_jobs([
        lambda: csv.load_channels(spark, ch_path, multiline).parted("channel-records"),
        lambda: csv.load_videos(spark, v_path, now, multiline).parted("video-records")])
    paths = parquet.save_outputs({"channel_stats": channels.rows, "videos": videos.rows},
                                 out_dir, stamp, parallel=True)
    rejects = parquet.save_rejects({"channel_stats": channels.rejects, "videos": videos.rejects},
                                   rejects_dir or f"{out_dir.rstrip('/')}/rejects", stamp)

    processed = spark.read.parquet(paths["videos"])
    src = rollup.BaseRollup.build(processed) if use_rollup else processed
    analytics = {
        "top_videos": topk.top_videos(processed),
        "day_performance": rollup.day_performance(src),
        "hour_performance": rollup.hour_performance(src),
        "monthly_trends": rollup.monthly_trends(src),
        "engagement_stats": rollup.engagement_stats(src),
    }
    try:
        if isinstance(src, rollup.BaseRollup):
            src.df.count()  # fill the cache once, before the writes that share it
        paths.update(parquet.save_outputs(analytics, out_dir, stamp, parallel=True))
        ch = spark.read.parquet(paths["channel_stats"])
        summary = rollup.run_summary(src, ch).first().asDict()
    finally:
        if isinstance(src, rollup.BaseRollup):
            src.df.unpersist()
    return TransformResult(paths, summary, rejects)
