"""Landed API replies (JSON lines) -> channel rows, video rows, search ids.

The HTTP client is not part of the library; replies are landed as JSON lines,
one reply per line, with the request context next to it:

* channels: ``{"channel_id", "captured_at", "response": {items: [...]}}``
* videos:   ``{"video_id", "response": {items: [...]}}``, and ``landed_at`` if ids are
  looked up more than once (ISO text; the newest reply counts)
* search:   ``{"page", "response": {items: [{id: {videoId}}], nextPageToken}}``

``response`` may be an object or its JSON text.  Counters arrive as text; an
absent one is 0.  A reply with an empty item list is a channel error (or
dropped) and a dropped video.  What can't be used is a reject with its reason,
never a NULL or a 0: broken text, a counter that is no number, a missing
title, a time that doesn't parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import bad_counter, counter, parse_iso_timestamp, with_ingest_fields
from .judged import Judged

_S = T.StringType()

CHANNEL_RESPONSE = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    T.StructField("id", _S),
    T.StructField("snippet", T.StructType([T.StructField("title", _S)])),
    T.StructField("statistics", T.StructType([
        T.StructField("subscriberCount", _S), T.StructField("viewCount", _S),
        T.StructField("videoCount", _S)])),
])))])

VIDEO_RESPONSE = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    T.StructField("id", _S),
    T.StructField("snippet", T.StructType([
        T.StructField("title", _S), T.StructField("publishedAt", _S)])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", _S), T.StructField("likeCount", _S),
        T.StructField("commentCount", _S)])),
])))])

SEARCH_RESPONSE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StructType([T.StructField("videoId", _S)]))]))),
    T.StructField("nextPageToken", _S),
])


def landed_schema(kind: str) -> T.StructType:
    ctx = {"channels": [T.StructField("channel_id", _S), T.StructField("captured_at", _S)],
           "videos": [T.StructField("video_id", _S), T.StructField("landed_at", _S)],
           "search": [T.StructField("page", T.LongType())]}[kind]
    resp = {"channels": CHANNEL_RESPONSE, "videos": VIDEO_RESPONSE,
            "search": SEARCH_RESPONSE}[kind]
    return T.StructType(ctx + [T.StructField("response", resp),
                               T.StructField("_corrupt_record", _S)])


def read_landed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """JSON lines with a fixed schema; unparsable lines keep their text in
    ``_corrupt_record``."""
    return (spark.read.schema(landed_schema(kind)).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def _response(df: DataFrame, schema: T.StructType) -> DataFrame:
    f = df.schema["response"].dataType
    if isinstance(f, T.StringType):
        return df.withColumn("response", F.from_json("response", schema))
    return df


def _first_item(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``_item``, the first item of the reply (NULL when
    there is none).  Taken by a generator over a one-element slice: filters on
    the item then stay above it, so the reply is parsed once per row instead
    of once per predicate that Catalyst would push below a projection."""
    return df.select(*keep, F.explode_outer(F.slice("response.items", 1, 1)).alias("_item"))


def _reasons(record: Column | None, title: Column, time: Column, counters: list[str]) -> Column:
    """Why a reply can't be used, NULL if it can."""
    bad = bad_counter(counters[0])
    for c in counters[1:]:
        bad = bad | bad_counter(c)
    broken = F.col("_broken") if record is None else F.col("_broken") | record.isNotNull()
    return (F.when(broken, "broken reply").when(title.isNull(), "no title")
            .when(bad, "bad counter").when(time.isNull(), "unreadable time"))


def _opened(landed: DataFrame, schema: T.StructType, keep: list[str]) -> DataFrame:
    """``keep``, the reply's first item, whether the reply is broken (no item list at
    all), and the landed record as text."""
    text = F.to_json(F.struct(*[F.col(c) for c in landed.columns]))
    df = _response(landed.withColumn("_text", text), schema)
    keep = keep + [c for c in ("_corrupt_record",) if c in landed.columns]
    broken = F.col("response.items").isNull().alias("_broken")
    return _first_item(df.select(*keep, "_text", broken, "response"), [*keep, "_text", "_broken"])


def channel_replies(landed: DataFrame, on_missing: str = "error",
                    captured_at: Column | None = None) -> Judged:
    """First item of each channel reply -> snapshot row.  The channel id comes from
    the request, and so does the capture time; a request that landed without one is
    stamped with ``captured_at`` (the run's time).  A reply without an item raises in
    the plan (``on_missing="error"``) or is dropped (``"drop"``)."""
    if on_missing not in ("error", "drop"):
        raise ValueError("on_missing must be 'error' or 'drop'")
    df = _opened(landed, CHANNEL_RESPONSE, ["channel_id", "captured_at"])
    missing = F.col("_item").isNull() & ~F.col("_broken")
    record = F.col("_corrupt_record") if "_corrupt_record" in df.columns else None
    if record is not None:
        missing = missing & record.isNull()
    if on_missing == "error":
        df = df.filter(F.when(missing, F.raise_error(F.concat(
            F.lit("no channel for id "), F.col("channel_id")))).otherwise(F.lit(True)))
    else:
        df = df.filter(~missing)
    stats = "_item.statistics."
    counters = [stats + c for c in ("subscriberCount", "viewCount", "videoCount")]
    time = parse_iso_timestamp("captured_at")
    if captured_at is not None:
        time = F.when(F.col("captured_at").isNull(), captured_at).otherwise(time)
    df = df.withColumn("_time", time)
    df = df.withColumn("reason", _reasons(record, F.col("_item.snippet.title"),
                                          F.col("_time"), counters))
    return _judged(df, "channel_id", record, [
        F.col("_time").alias("captured_at"), F.col("channel_id"),
        F.col("_item.snippet.title").alias("channel_title"),
        counter(counters[0]).alias("subscribers"), counter(counters[1]).alias("total_views"),
        counter(counters[2]).alias("video_count")])


def _judged(df: DataFrame, key: str, record: Column | None, rows: list[Column]) -> Judged:
    """The columns of the rows, and reason and text of the rejects, of every reply."""
    text = F.col("_text") if record is None else F.coalesce(record, F.col("_text"))
    frame = df.select(*rows, "reason",
                      F.when(F.col("reason").isNotNull(), text).alias("record"))
    names = [c for c in frame.columns if c not in ("reason", "record")]
    return Judged(frame, lambda d: d.select(*names), lambda d: d.select("reason", key, "record"))


def channel_rows(landed: DataFrame, on_missing: str = "error",
                 captured_at: Column | None = None) -> DataFrame:
    return channel_replies(landed, on_missing, captured_at).rows


def video_rows(landed: DataFrame) -> Judged:
    """First item of each video reply -> raw video row with engagement rate,
    weekday name and hour, and the request's ``landed_at`` if there is one.  No
    item: dropped."""
    extra = [c for c in ("landed_at",) if c in landed.columns]
    df = _opened(landed, VIDEO_RESPONSE, ["video_id", *extra])
    record = F.col("_corrupt_record") if "_corrupt_record" in df.columns else None
    found = F.col("_item").isNotNull() | F.col("_broken")
    if record is not None:
        found = found | record.isNotNull()
    stats = "_item.statistics."
    counters = [stats + c for c in ("viewCount", "likeCount", "commentCount")]
    df = df.filter(found).withColumn("_time", parse_iso_timestamp("_item.snippet.publishedAt"))
    df = df.withColumn("reason", _reasons(
        record, F.col("_item.snippet.title"), F.col("_time"), counters))
    cols = ["video_id", "title", "publish_time", "views", "likes", "comments",
            "engagement_rate", "publish_day", "publish_hour", *extra]
    return _judged(df, "video_id", record, [
        F.col("video_id"), F.col("_item.snippet.title").alias("title"),
        F.col("_time").alias("publish_time"),
        counter(counters[0]).alias("views"), counter(counters[1]).alias("likes"),
        counter(counters[2]).alias("comments"), *map(F.col, extra)]) \
        .then(lambda rows: with_ingest_fields(rows).select(*cols))


def search_ids(landed: DataFrame) -> DataFrame:
    """Every listed id with its page and position on the page."""
    df = _response(landed, SEARCH_RESPONSE)
    return (df.select("page", F.posexplode("response.items").alias("position", "item"))
            .select("page", "position", F.col("item.id.videoId").alias("video_id")))
