"""Incremental load of landed snapshot files (Structured Streaming).

The reference runs its load once a day on the newest snapshot.  This module
is the same load (rules, keyed upsert, partition overwrite) driven by Spark's
file source instead of a directory scan: every new ``videos_<stamp>.csv`` /
``channel_stats_<stamp>.csv`` is read exactly once, tracked in the query's
checkpoint.  ``trigger(availableNow=True)`` processes what has landed and
stops, so it fits a daily schedule; without it the query keeps running.

Files that arrive in one micro-batch are merged by name stamp: a key seen
in several files keeps the row of the newest file (``on_duplicate="last"``),
which is what loading the files one after the other in name order gives for
the data columns.  A batch replayed after a failure re-applies the same
upsert, which is idempotent for the data.

Every stored row keeps the stamp of the file its values are of, and a row of an
older file leaves it alone: a snapshot that lands late inserts the keys that are
new and changes nothing else.  So the order in which files land doesn't matter, nor
does the file source's order (by modification time).  The daily load has no stamp:
it always wins, and leaves the stored one.
Records that can't be used are written to
``<warehouse>/rejects/<entity>``, as the transform job does with its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import as_of_literal, with_video_metrics
from ..schemas import RAW_CHANNEL, RAW_VIDEOS, SOURCE_STAMP
from ..sources import csv
from ..plans.load import Warehouse, load_channels, load_videos, warehouse

_STAMP = r"_(\d{8}_\d{6})\.csv"


def snapshot_stream(spark: SparkSession, raw_dir: str, entity: str) -> DataFrame:
    """Streaming frame of every row of every ``<entity>_<stamp>.csv`` file,
    with the file's name stamp in ``source_stamp``."""
    schema = RAW_VIDEOS if entity == "videos" else RAW_CHANNEL
    df = (csv.judging(spark.readStream, schema)
          .option("pathGlobFilter", f"{entity}_*.csv").csv(raw_dir))
    return df.withColumn(SOURCE_STAMP, F.regexp_extract(F.input_file_name(), _STAMP, 1))


def _batch_loader(wh: Warehouse, entity: str, loader: str, now, rejects_dir: str):
    def apply(batch: DataFrame, batch_id: int) -> None:
        as_of = as_of_literal(now() if callable(now) else now)
        videos = entity == "videos"
        loaded = csv.judged(batch, RAW_VIDEOS if videos else RAW_CHANNEL,
                            "publish_time" if videos else "captured_at", keep=(SOURCE_STAMP,)) \
            .parted("stream-records")
        # overwritten when a failed batch is replayed
        loaded.rejects.write.mode("overwrite").parquet(f"{rejects_dir}/{entity}/batch={batch_id}")
        if videos:
            load_videos(wh, with_video_metrics(loaded.rows, as_of), as_of, loader,
                        on_duplicate="last", order_by=SOURCE_STAMP)
        else:
            load_channels(wh, loaded.rows, as_of, on_duplicate="last", order_by=SOURCE_STAMP)
    return apply


def start_incremental_load(spark: SparkSession, raw_dir: str, warehouse_dir: str,
                           checkpoint_dir: str, entity: str = "videos", loader: str = "full",
                           as_of=None, available_now: bool = True):
    """Start the streaming load of one entity; returns the StreamingQuery."""
    wh = warehouse(spark, warehouse_dir)
    now = as_of if as_of is not None else (
        lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    w = (snapshot_stream(spark, raw_dir, entity).writeStream
         .foreachBatch(_batch_loader(wh, entity, loader, now,
                                     f"{warehouse_dir.rstrip('/')}/rejects"))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
