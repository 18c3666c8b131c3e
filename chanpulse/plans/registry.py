"""Registered queries: each operator on the generated tables, with the SQL
an independent engine runs on the same tables to check it.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Doubles are rounded in both (averages 6 digits, per-view rates 9) because
float sums in another order differ in the last bits; times are returned
without zone, as the generated tables hold them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import as_of_literal
from ..session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def present(df: DataFrame, digits: int = 6, per_column: dict[str, int] | None = None) -> DataFrame:
    """Round doubles, return instants as zone-less times (UTC wall clock)."""
    per_column = per_column or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, per_column.get(f.name, digits))
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Fixed "now" of the proxies: events span 2024-01-01..30, lineitem to 2001-11.
EVENTS_AS_OF = "2024-01-31 00:00:00"
LINEITEM_AS_OF = "2002-01-01 00:00:00"


def events_as_of():
    return as_of_literal(EVENTS_AS_OF)


def lineitem_as_of():
    return as_of_literal(LINEITEM_AS_OF)


# ---------------------------------------------------------------- SQL pieces
def video_cte(source: str = "events", as_of: str = EVENTS_AS_OF) -> str:
    """The processed-video stand-in in DuckDB SQL (``v``)."""
    if source == "events":
        v0 = """SELECT event_id AS video_id,
         concat(event_type, '-', CAST(user_id AS VARCHAR)) AS title,
         ts AS publish_time, CAST(floor(value * 10) AS BIGINT) AS views,
         user_id % 40 AS likes, event_id % 7 AS comments
  FROM events"""
    else:
        v0 = """SELECT l_orderkey AS video_id,
         concat(l_returnflag, l_linestatus, '-', CAST(l_partkey AS VARCHAR)) AS title,
         l_shipdate AS publish_time, CAST(floor(l_extendedprice) AS BIGINT) AS views,
         l_partkey % 40 AS likes, l_suppkey % 7 AS comments
  FROM lineitem"""
    return f"""v0 AS (
  {v0}),
v AS (
  SELECT *,
    CASE WHEN views > 0 THEN CAST(likes + comments AS DOUBLE) / views ELSE 0.0 END AS engagement_rate,
    dayname(publish_time) AS publish_day,
    CAST(hour(publish_time) AS INTEGER) AS publish_hour,
    CAST(publish_time AS DATE) AS publish_date,
    CAST(dayofweek(publish_time) + 1 AS INTEGER) AS publish_day_of_week,
    strftime(publish_time, '%Y-%m') AS publish_month,
    CASE WHEN views > 0 THEN CAST(likes AS DOUBLE) / views ELSE 0.0 END AS likes_per_view,
    CASE WHEN views > 0 THEN CAST(comments AS DOUBLE) / views ELSE 0.0 END AS comments_per_view,
    CASE WHEN publish_time IS NULL THEN 0.0
         ELSE views / nullif((epoch(TIMESTAMP '{as_of}') - floor(epoch(publish_time))) / 86400.0, 0)
    END AS views_per_day
  FROM v0)"""


def with_videos(select: str, source: str = "events", as_of: str = EVENTS_AS_OF) -> str:
    return f"WITH {video_cte(source, as_of)}\n{select}"


CHANNEL_CTE = """cb AS (
  SELECT o_orderdate AS captured_at, o_custkey AS channel_id,
         concat('channel-', CAST(o_custkey AS VARCHAR)) AS channel_title,
         CAST(floor(o_totalprice) AS BIGINT) AS subscribers,
         CAST(floor(o_totalprice) AS BIGINT) * 16 AS total_views,
         CAST(o_orderkey % 100 AS INTEGER) AS video_count, o_orderkey AS seq
  FROM orders),
ch AS (
  SELECT captured_at, channel_id, channel_title, subscribers, total_views, video_count
  FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, captured_at ORDER BY seq DESC) AS rn
        FROM cb)
  WHERE rn = 1)"""


def with_channels(select: str) -> str:
    return f"WITH {CHANNEL_CTE}\n{select}"
