"""Stand-ins built from the driver's generated tables.

The generated tables hold no channels or videos, so they are mapped onto the
two entities with plain projections (every row of the source table is used):

* videos  <- ``events``: id = event_id, title = event_type-user_id,
  publish_time = ts, views = floor(value * 10), likes = user_id % 40,
  comments = event_id % 7;
* videos  <- ``lineitem`` (months that really differ): id = l_orderkey,
  title = returnflag+linestatus-partkey, publish_time = l_shipdate,
  views = floor(l_extendedprice), likes = l_partkey % 40, comments = l_suppkey % 7;
* channel snapshots <- ``orders``: channel_id = o_custkey, captured_at =
  o_orderdate, title = "channel-" || custkey, subscribers = floor(totalprice),
  total_views = subscribers * 16, video_count = o_orderkey % 100; the batch
  order is o_orderkey.

The generated times are wall-clock values without zone (``timestamp_ntz``);
they are read as UTC instants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import with_ingest_fields, with_video_metrics


# Declared schemas of the generated tables the stand-ins read (times are
# wall-clock values without zone).  A declared schema spares the footer read
# that schema inference costs on every plan; scans still read only the
# columns a plan uses.
INPUT_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in INPUT_SCHEMAS:
        reader = reader.schema(INPUT_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_videos_from_events(events: DataFrame) -> DataFrame:
    """Rows as the ingest step lands them: id, title, time, three counters."""
    return events.selectExpr(
        "event_id AS video_id",
        "concat(event_type, '-', CAST(user_id AS STRING)) AS title",
        "CAST(ts AS TIMESTAMP) AS publish_time",
        "CAST(floor(value * 10) AS BIGINT) AS views",
        "user_id % 40 AS likes",
        "event_id % 7 AS comments")


def raw_videos_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey AS video_id",
        "concat(l_returnflag, l_linestatus, '-', CAST(l_partkey AS STRING)) AS title",
        "CAST(l_shipdate AS TIMESTAMP) AS publish_time",
        "CAST(floor(l_extendedprice) AS BIGINT) AS views",
        "l_partkey % 40 AS likes",
        "l_suppkey % 7 AS comments")


def ingested(raw: DataFrame) -> DataFrame:
    """Ingest-side fields: engagement rate, weekday name, hour."""
    return with_ingest_fields(raw)


def processed(raw: DataFrame, as_of: Column) -> DataFrame:
    """The processed video frame (ingest fields + date parts + rates + pace)."""
    return with_video_metrics(with_ingest_fields(raw), as_of)


def videos_events(spark: SparkSession, sf_dir: str, as_of: Column) -> DataFrame:
    return processed(raw_videos_from_events(table(spark, sf_dir, "events")), as_of)


def videos_lineitem(spark: SparkSession, sf_dir: str, as_of: Column) -> DataFrame:
    return processed(raw_videos_from_lineitem(table(spark, sf_dir, "lineitem")), as_of)


def channel_batch(orders: DataFrame) -> DataFrame:
    """Channel snapshot rows plus their batch order column ``seq``."""
    return orders.selectExpr(
        "CAST(o_orderdate AS TIMESTAMP) AS captured_at",
        "o_custkey AS channel_id",
        "concat('channel-', CAST(o_custkey AS STRING)) AS channel_title",
        "CAST(floor(o_totalprice) AS BIGINT) AS subscribers",
        "CAST(floor(o_totalprice) AS BIGINT) * 16 AS total_views",
        "CAST(o_orderkey % 100 AS INT) AS video_count",
        "o_orderkey AS seq")


# ------------------------------------------------------------------ replies
def channel_replies(channels: DataFrame, keep: str | None = None) -> DataFrame:
    """Landed channel replies (request context + reply text) from channel
    rows; the video counter is absent when it is 0.  ``keep``: one more column."""
    stats = F.struct(F.col("subscribers").cast("string").alias("subscriberCount"),
                     F.col("total_views").cast("string").alias("viewCount"),
                     F.when(F.col("video_count") != 0, F.col("video_count").cast("string"))
                     .alias("videoCount"))
    item = F.struct(F.col("channel_id").cast("string").alias("id"),
                    F.struct(F.col("channel_title").alias("title")).alias("snippet"),
                    stats.alias("statistics"))
    return channels.select(
        F.col("channel_id").cast("string").alias("channel_id"),
        F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("captured_at"),
        F.to_json(F.struct(F.array(item).alias("items"))).alias("response"),
        *([F.col(keep)] if keep else []))


def video_replies(events: DataFrame) -> DataFrame:
    """One reply per event: no item for errors (video not found), no comment
    counter for purchases (absent -> 0), publish time in UTC with ``Z``."""
    raw = raw_videos_from_events(events)
    et = F.split(F.col("title"), "-").getItem(0)
    stats = F.struct(F.col("views").cast("string").alias("viewCount"),
                     F.col("likes").cast("string").alias("likeCount"),
                     F.when(et != "purchase", F.col("comments").cast("string"))
                     .alias("commentCount"))
    item = F.struct(F.col("video_id").cast("string").alias("id"),
                    F.struct("title", F.date_format("publish_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
                             .alias("publishedAt")).alias("snippet"),
                    stats.alias("statistics"))
    items = F.filter(F.array(item), lambda _: et != "error")
    return raw.select(F.col("video_id").cast("string").alias("video_id"),
                      F.to_json(F.struct(items.alias("items"))).alias("response"))


def search_replies(events: DataFrame, page_size: int = 50) -> DataFrame:
    """Search pages of ``page_size`` ids (by event_id), ids in page order."""
    ids = events.select(F.floor(F.col("event_id") / page_size).alias("page"),
                        F.col("event_id").alias("vid"))
    pages = ids.groupBy("page").agg(F.sort_array(F.collect_list("vid")).alias("vids"))
    items = F.transform("vids", lambda x: F.struct(
        F.struct(x.cast("string").alias("videoId")).alias("id")))
    return pages.select("page", F.to_json(F.struct(items.alias("items"))).alias("response"))
