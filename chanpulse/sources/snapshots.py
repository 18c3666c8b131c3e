"""Choosing the newest snapshot of an entity in a landing or output folder.

Names look like ``<entity>_<yyyyMMdd>_<HHmmss>.<ext>`` (a file, or a folder
of part files as Spark writes them).  The pattern is anchored, so
``top_videos_<stamp>.parquet`` is never taken for ``videos``.  "Newest" is the
name stamp (modification times of copied files all agree); the modification
time only breaks ties, or leads when ``policy="mtime"``.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from ..schemas import SNAPSHOT_STAMP_FORMAT
from . import fs

STAMP_FORMAT = SNAPSHOT_STAMP_FORMAT


def snapshot_regex(entity: str, ext: str) -> re.Pattern:
    return re.compile(rf"^{re.escape(entity)}_(\d{{8}}_\d{{6}})\.{re.escape(ext)}$")


def list_snapshots(spark: SparkSession, directory: str, entity: str,
                   ext: str = "csv") -> list[tuple[str, int, str]]:
    """(stamp, mtime_ms, path) of every snapshot of ``entity``."""
    rx = snapshot_regex(entity, ext)
    out = []
    for e in fs.list_dir(spark, directory):
        m = rx.match(e.name)
        if m:
            out.append((m.group(1), e.mtime_ms, e.path))
    return out


def latest_snapshot(spark: SparkSession, directory: str, entity: str, ext: str = "csv",
                    policy: str = "name") -> str | None:
    """Path of the newest snapshot, or None when there is none."""
    snaps = list_snapshots(spark, directory, entity, ext)
    if not snaps:
        return None
    if policy == "mtime":
        key = lambda s: (s[1], s[0])
    elif policy == "name":
        key = lambda s: (s[0], s[1])
    else:
        raise ValueError("policy must be 'name' or 'mtime'")
    return max(snaps, key=key)[2]


def require_snapshot(spark: SparkSession, directory: str, entity: str, ext: str = "csv",
                     policy: str = "name") -> str:
    path = latest_snapshot(spark, directory, entity, ext, policy)
    if path is None:
        raise FileNotFoundError(f"{directory} holds no snapshot of {entity}")
    return path


def latest_dataset(spark: SparkSession, directory: str, entity: str,
                   policy: str = "name") -> str | None:
    """Newest processed Parquet dataset of ``entity``."""
    return latest_snapshot(spark, directory, entity, "parquet", policy)
