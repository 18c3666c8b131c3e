import datetime as dt

from pyspark.sql import types as T

VIDEO_RAW = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("comments", T.LongType()),
])


def ts(*a):
    return dt.datetime(*a)


def raw_videos(spark, rows):
    return spark.createDataFrame(rows, VIDEO_RAW)
