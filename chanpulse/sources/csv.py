"""Raw CSV snapshots: readers with a fixed schema and the snapshot writer.

Reading: header row, explicit schema (no inference scan), ``escape='"'`` so a
doubled quote inside a quoted title is one quote.  Records are single lines by
default, which keeps large files splittable across tasks; ``multiline=True``
accepts quoted line breaks at the price of one task per file.  A record with
another number of fields or a counter that is no number, and a time that does
not parse, never fail the read and never turn into NULLs: the record is a
reject, with the reason and its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import parse_iso_timestamp, with_video_metrics
from ..schemas import RAW_CHANNEL, RAW_VIDEOS
from ..session import run_jobs
from . import fs
from .judged import Judged

# Written stamps keep microseconds and the offset (the default keeps ms only).
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


_TEXT = "_record"


def judging(reader, schema: T.StructType, multiline: bool = False):
    """``reader`` (batch or stream) set up so that :func:`judged` can tell what is wrong."""
    wide = T.StructType([*schema.fields, T.StructField(_TEXT, T.StringType())])
    # without pruning a record is judged by all its fields, whatever is selected
    return (reader.schema(wide).option("header", True).option("escape", '"')
            .option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _TEXT).option("columnPruning", False))


def _load(spark: SparkSession, path: str, schema: T.StructType, time: str,
          multiline: bool) -> Judged:
    return judged(judging(spark.read, schema, multiline).csv(path), schema, time)


def judged(df: DataFrame, schema: T.StructType, time: str, keep: tuple[str, ...] = ()) -> Judged:
    """Usable rows with ``time`` parsed, and the rejects; ``keep``: further columns of the rows."""
    raw = f"_{time}_text"
    df = df.withColumnRenamed(time, raw).withColumn(time, parse_iso_timestamp(raw))
    reason = F.when(F.col(_TEXT).isNotNull(), "malformed record") \
        .when(F.col(raw).isNotNull() & F.col(time).isNull(), "unreadable time")
    df = df.withColumn("reason", reason)
    df = df.withColumn(raw, F.when(F.col("reason").isNotNull(), F.col(raw)))  # rejects' alone
    names = schema.fieldNames()
    return Judged(df, lambda d: d.select(*names, *keep), lambda d: d.select(
        "reason", *[F.col(raw).alias(c) if c == time else F.col(c) for c in names],
        F.col(_TEXT).alias("record")))


def load_channels(spark: SparkSession, path: str, multiline: bool = False) -> Judged:
    """Channel snapshot CSV; ``captured_at`` text -> timestamp."""
    return _load(spark, path, RAW_CHANNEL, "captured_at", multiline)


def read_channel_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return load_channels(spark, path, multiline).rows


def load_videos(spark: SparkSession, path: str, as_of: Column, multiline: bool = False) -> Judged:
    """Video snapshot CSV -> processed frame (date parts, rates, pace)."""
    return _load(spark, path, RAW_VIDEOS, "publish_time", multiline).then(
        lambda rows: with_video_metrics(rows, as_of))


def read_videos_csv(spark: SparkSession, path: str, as_of: Column,
                    multiline: bool = False) -> DataFrame:
    return load_videos(spark, path, as_of, multiline).rows


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """CSV with header, doubled quotes, microsecond stamps with offset."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("timestampFormat", CSV_TIMESTAMP_FORMAT).csv(path))
    return path


def save_snapshots(channels: DataFrame, videos: DataFrame, directory: str,
                   stamp: str) -> tuple[str, str | None]:
    """Write ``channel_stats_<stamp>.csv`` and, when there are videos,
    ``videos_<stamp>.csv``; returns both paths (None for no videos).

    What is behind ``videos`` runs once: the write's own count of rows tells
    whether there are any, and a snapshot of none is taken back."""
    d = directory.rstrip("/")
    ch, vid = f"{d}/channel_stats_{stamp}.csv", f"{d}/videos_{stamp}.csv"
    seen = Observation()
    rows = videos.select(*RAW_VIDEOS.fieldNames()).observe(seen, F.count(F.lit(1)).alias("n"))
    run_jobs([  # two independent writes, run side by side
        lambda: write_csv(channels.select(*RAW_CHANNEL.fieldNames()), ch),
        lambda: write_csv(rows, vid)])
    if not seen.get.get("n"):
        fs.delete(videos.sparkSession, vid)
        vid = None
    return ch, vid
