"""Processed Parquet datasets: stamped writes and reads that skip a missing
entity."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from ..session import run_jobs
from . import fs

log = logging.getLogger(__name__)


def dataset_path(directory: str, name: str, stamp: str) -> str:
    return f"{directory.rstrip('/')}/{name}_{stamp}.parquet"


def save_outputs(frames: dict[str, DataFrame], directory: str, stamp: str,
                 mode: str = "overwrite", parallel: bool = False) -> dict[str, str]:
    """Write each frame to ``<name>_<stamp>.parquet``; returns name -> path.

    ``parallel``: the writes are independent jobs, submitted together from
    driver threads so the scheduler runs their tasks side by side (small
    outputs then cost one job latency, not one each).  The first failure is
    raised after all writes end."""
    paths = {name: dataset_path(directory, name, stamp) for name in frames}

    def write(name: str):
        return lambda: frames[name].write.mode(mode).parquet(paths[name])

    thunks = [write(name) for name in frames]
    if parallel:
        run_jobs(thunks)
    else:
        for t in thunks:
            t()
    return paths


def save_rejects(frames: dict[str, DataFrame], directory: str, stamp: str) -> dict[str, int]:
    """Write the rejects of each entity to ``<entity>_rejects_<stamp>.parquet``;
    returns how many there are."""
    paths = save_outputs({f"{n}_rejects": df for n, df in frames.items()}, directory, stamp,
                         parallel=True)
    return {n: df.sparkSession.read.schema(df.schema).parquet(paths[f"{n}_rejects"]).count()
            for n, df in frames.items()}


def read_processed(spark: SparkSession, channel_path: str | None,
                   videos_path: str | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Both entities; a missing one is None with a warning (not an error)."""
    out = []
    for label, p in (("channel", channel_path), ("videos", videos_path)):
        if p and fs.exists(spark, p):
            out.append(spark.read.parquet(p))
        else:
            log.warning("%s dataset not found: %s", label, p)
            out.append(None)
    return out[0], out[1]
