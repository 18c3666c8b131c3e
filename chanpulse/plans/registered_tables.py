"""Registered queries: upserts, ids, rules, collection, report text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import as_of_literal
from ..functions.text import fixed4, short_title, thousands
from ..operators import collect, rules, topk
from ..operators.upsert import assign_ids, duplicate_keys, keep_last, upsert
from ..schemas import (CHANNEL_KEYS, CHANNEL_UPDATE, MAX_VIDEOS, VIDEO_UPDATE_FULL,
                       VIDEO_UPDATE_NARROW)
from . import proxies
from .registry import EVENTS_AS_OF, present, query, video_cte, with_videos

# ---------------------------------------------------------------- upserts
# Table state: videos published before 2024-01-20, stamped 2024-01-01.  Batch:
# videos published from 2024-01-10 on, re-observed with 1000 more views, one
# more like and a changed title.  The run's now is 2024-01-31.
TABLE_STAMP = "2024-01-01 00:00:00"
SPLIT_OLD, SPLIT_NEW = "2024-01-20 00:00:00", "2024-01-10 00:00:00"


def _video_table(spark, sf_dir) -> DataFrame:
    raw = proxies.raw_videos_from_events(proxies.table(spark, sf_dir, "events"))
    old = raw.filter(F.col("publish_time") < F.lit(SPLIT_OLD).cast("timestamp"))
    stamp = as_of_literal(TABLE_STAMP)
    return (proxies.processed(old, as_of_literal(TABLE_STAMP))
            .withColumns({"created_at": stamp, "updated_at": stamp}))


def _video_batch(spark, sf_dir) -> DataFrame:
    raw = proxies.raw_videos_from_events(proxies.table(spark, sf_dir, "events"))
    new = (raw.filter(F.col("publish_time") >= F.lit(SPLIT_NEW).cast("timestamp"))
           .withColumns({"views": F.col("views") + 1000, "likes": F.col("likes") + 1,
                         "title": F.concat(F.col("title"), F.lit("!"))}))
    return proxies.processed(new, as_of_literal(EVENTS_AS_OF))


UPSERT_COLUMNS = ["video_id", "title", "views", "likes", "publish_time", "created_at",
                  "updated_at"]


def _upsert_sql(narrow: bool) -> str:
    likes = "t.video_id IS NULL" if narrow else "s.video_id IS NOT NULL"
    return f"""WITH {video_cte()},
t AS (SELECT video_id, title, views, likes, publish_time,
             TIMESTAMP '{TABLE_STAMP}' AS created_at, TIMESTAMP '{TABLE_STAMP}' AS updated_at
      FROM v WHERE publish_time < TIMESTAMP '{SPLIT_OLD}'),
s AS (SELECT video_id, title || '!' AS title, views + 1000 AS views, likes + 1 AS likes,
             publish_time
      FROM v WHERE publish_time >= TIMESTAMP '{SPLIT_NEW}')
SELECT coalesce(t.video_id, s.video_id) AS video_id,
  CASE WHEN s.video_id IS NOT NULL THEN s.title ELSE t.title END AS title,
  CASE WHEN s.video_id IS NOT NULL THEN s.views ELSE t.views END AS views,
  CASE WHEN {likes} THEN s.likes ELSE t.likes END AS likes,
  CASE WHEN t.video_id IS NOT NULL THEN t.publish_time ELSE s.publish_time END AS publish_time,
  CASE WHEN t.video_id IS NOT NULL THEN t.created_at ELSE TIMESTAMP '{EVENTS_AS_OF}' END AS created_at,
  CASE WHEN s.video_id IS NOT NULL THEN TIMESTAMP '{EVENTS_AS_OF}' ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN s ON t.video_id = s.video_id"""


def _upsert_videos(spark, sf_dir, update, strategy="auto") -> DataFrame:
    merged = upsert(_video_table(spark, sf_dir), _video_batch(spark, sf_dir), ["video_id"],
                    update, as_of_literal(EVENTS_AS_OF), created="created_at",
                    updated="updated_at", strategy=strategy)
    return present(merged.select(*UPSERT_COLUMNS))


@query("upsert_videos_full", _upsert_sql(narrow=False))
def upsert_videos_full(spark, sf_dir):
    """U2 + U4 + J2: full upsert, publish_time and created_at kept,
    updated_at = now (size-checked broadcast of the batch)."""
    return _upsert_videos(spark, sf_dir, VIDEO_UPDATE_FULL)


@query("upsert_videos_full_shuffled", _upsert_sql(narrow=False))
def upsert_videos_full_shuffled(spark, sf_dir):
    """U2 with both sides hash-partitioned (the plan above the broadcast bound)."""
    return _upsert_videos(spark, sf_dir, VIDEO_UPDATE_FULL, strategy="shuffle")


@query("upsert_videos_narrow", _upsert_sql(narrow=True))
def upsert_videos_narrow(spark, sf_dir):
    """The deployed loader's upsert (title and views only)."""
    return _upsert_videos(spark, sf_dir, VIDEO_UPDATE_NARROW)


CH_SPLIT_OLD, CH_SPLIT_NEW = "1997-01-01 00:00:00", "1996-01-01 00:00:00"


@query("upsert_channels", f"""
WITH cb AS (
  SELECT o_orderdate AS captured_at, o_custkey AS channel_id,
         concat('channel-', CAST(o_custkey AS VARCHAR)) AS channel_title,
         CAST(floor(o_totalprice) AS BIGINT) AS subscribers,
         CAST(floor(o_totalprice) AS BIGINT) * 16 AS total_views,
         CAST(o_orderkey % 100 AS INTEGER) AS video_count, o_orderkey AS seq
  FROM orders),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, captured_at
                                                  ORDER BY seq DESC) AS rn
                     FROM cb WHERE captured_at < TIMESTAMP '{CH_SPLIT_OLD}') WHERE rn = 1),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel_id, captured_at
                                                  ORDER BY seq DESC) AS rn
                     FROM cb WHERE captured_at >= TIMESTAMP '{CH_SPLIT_NEW}') WHERE rn = 1)
SELECT coalesce(t.channel_id, s.channel_id) AS channel_id,
  coalesce(t.captured_at, s.captured_at) AS captured_at,
  CASE WHEN s.channel_id IS NOT NULL THEN s.channel_title ELSE t.channel_title END AS channel_title,
  CASE WHEN s.channel_id IS NOT NULL THEN s.subscribers + 1 ELSE t.subscribers END AS subscribers,
  CASE WHEN s.channel_id IS NOT NULL THEN s.total_views + 1 ELSE t.total_views END AS total_views,
  CASE WHEN s.channel_id IS NOT NULL THEN s.video_count + 1 ELSE t.video_count END AS video_count,
  CASE WHEN s.channel_id IS NOT NULL THEN TIMESTAMP '{EVENTS_AS_OF}'
       ELSE TIMESTAMP '{TABLE_STAMP}' END AS created_at
FROM t FULL OUTER JOIN s ON t.channel_id = s.channel_id AND t.captured_at = s.captured_at""")
def upsert_channels(spark, sf_dir):
    """Snapshots on (channel_id, captured_at); a key repeated in the batch
    keeps its last row (by o_orderkey); created_at refreshed on conflict."""
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    ts = F.col("captured_at")
    target = (keep_last(batch.filter(ts < F.lit(CH_SPLIT_OLD).cast("timestamp")),
                        CHANNEL_KEYS, "seq").drop("seq")
              .withColumn("created_at", as_of_literal(TABLE_STAMP)))
    source = (batch.filter(ts >= F.lit(CH_SPLIT_NEW).cast("timestamp"))
              .withColumns({"subscribers": F.col("subscribers") + 1,
                            "total_views": F.col("total_views") + 1,
                            "video_count": F.col("video_count") + 1}))
    merged = upsert(target, source, CHANNEL_KEYS, CHANNEL_UPDATE, as_of_literal(EVENTS_AS_OF),
                    created="created_at", refresh_created=True,
                    on_duplicate="last", order_by="seq")
    return present(merged.select("channel_id", "captured_at", "channel_title", "subscribers",
                                 "total_views", "video_count", "created_at"))


@query("surrogate_ids", """
SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS min_id,
       count(*) AS max_id
FROM events""")
def surrogate_ids(spark, sf_dir):
    """Ids of the table rows (1..n), kept on update, new ones for the
    inserted rows continue after the largest id; dense and unique."""
    table = assign_ids(_video_table(spark, sf_dir).withColumn("id", F.lit(None).cast("long")),
                       "id", 0)
    merged = upsert(table, _video_batch(spark, sf_dir), ["video_id"], VIDEO_UPDATE_FULL,
                    as_of_literal(EVENTS_AS_OF), created="created_at", updated="updated_at",
                    id_col="id")
    return merged.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_distinct("id").alias("n_ids"),
                      F.min("id").alias("min_id"), F.max("id").alias("max_id"))


# ------------------------------------------------------------------ rules
def _faulty(spark, sf_dir) -> DataFrame:
    """Stand-in videos with injected faults: no title where views = 0, hour
    shifted by one, weekday shifted back by one."""
    v = proxies.videos_events(spark, sf_dir, as_of_literal(EVENTS_AS_OF))
    return v.withColumns({
        "title": F.when(F.col("views") == 0, F.lit(None)).otherwise(F.col("title")),
        "publish_hour": F.col("publish_hour") + 1,
        "publish_day_of_week": F.col("publish_day_of_week") - 1})


def _fault_rules():
    return [*rules.not_null(["title"]), rules.in_range("publish_hour", 0, 23),
            rules.in_range("publish_day_of_week", 1, 7), rules.max_length("title", 10)]


_FAULTY_SQL = f"""WITH {video_cte()},
f AS (SELECT video_id, CASE WHEN views = 0 THEN NULL ELSE title END AS title,
             publish_hour + 1 AS publish_hour, publish_day_of_week - 1 AS publish_day_of_week
      FROM v)"""


@query("rule_violations", f"""{_FAULTY_SQL}
SELECT count(*) FILTER (WHERE title IS NULL) AS not_null_title,
       count(*) FILTER (WHERE publish_hour < 0 OR publish_hour > 23) AS range_publish_hour,
       count(*) FILTER (WHERE publish_day_of_week < 1 OR publish_day_of_week > 7)
         AS range_publish_day_of_week,
       count(*) FILTER (WHERE length(title) > 10) AS length_title
FROM f""")
def rule_violations(spark, sf_dir):
    """Violations per rule, one pass."""
    return rules.violation_counts(_faulty(spark, sf_dir), _fault_rules())


@query("rule_quarantine", f"""{_FAULTY_SQL}
SELECT violations, count(*) AS n FROM (
  SELECT concat_ws(',',
    CASE WHEN title IS NULL THEN 'not_null_title' END,
    CASE WHEN publish_hour < 0 OR publish_hour > 23 THEN 'range_publish_hour' END,
    CASE WHEN publish_day_of_week < 1 OR publish_day_of_week > 7
         THEN 'range_publish_day_of_week' END,
    CASE WHEN length(title) > 10 THEN 'length_title' END) AS violations
  FROM f)
GROUP BY violations""")
def rule_quarantine(spark, sf_dir):
    """Quarantine mode: rows per set of broken rules ("" = good rows)."""
    flagged = rules.flag(_faulty(spark, sf_dir), _fault_rules())
    return flagged.groupBy("violations").agg(F.count(F.lit(1)).alias("n"))


@query("duplicate_snapshot_keys", """
SELECT o_orderdate AS captured_at, o_custkey AS channel_id, count(*) AS n
FROM orders GROUP BY o_orderdate, o_custkey HAVING count(*) > 1""")
def duplicate_snapshot_keys(spark, sf_dir):
    """(channel_id, captured_at) keys held more than once by a batch."""
    batch = proxies.channel_batch(proxies.table(spark, sf_dir, "orders"))
    return present(duplicate_keys(batch, CHANNEL_KEYS))


@query("range_overflow", with_videos("""
SELECT count(*) FILTER (WHERE TRY_CAST(views * 10 AS DECIMAL(10,6)) IS NULL) AS fits_views_x10,
       count(*) FILTER (WHERE views * 1000000 > 2147483647) AS int32_views_x1e6
FROM v"""))
def range_overflow(spark, sf_dir):
    """Decimal fit (views x 10 as DECIMAL(10,6)) and 32-bit range."""
    v = proxies.videos_events(spark, sf_dir, as_of_literal(EVENTS_AS_OF)).withColumns({
        "views_x10": F.col("views") * 10, "views_x1e6": F.col("views") * 1000000})
    rs = [rules.fits("views_x10", "decimal(10,6)", "fits_views_x10"),
          rules.Rule("int32_views_x1e6", rules.int32("views_x1e6").violated)]
    return rules.violation_counts(v, rs)


# ------------------------------------------------------------- collection
_FOUND_SQL = """found AS (
  SELECT e.event_id AS video_id, CAST(e.event_id // 50 AS BIGINT) AS page,
         concat(e.event_type, '-', CAST(e.user_id AS VARCHAR)) AS title,
         CAST(floor(e.value * 10) AS BIGINT) AS views
  FROM events e WHERE e.event_type <> 'error')"""


def _search_and_details(spark, sf_dir):
    ev = proxies.table(spark, sf_dir, "events")
    ids = ev.select(F.col("event_id").alias("video_id"),
                    F.floor(F.col("event_id") / 50).alias("page"))
    details = proxies.raw_videos_from_events(ev.filter(F.col("event_type") != "error"))
    return ids, details.select("video_id", "title", "views")


@query("search_details_join", f"WITH {_FOUND_SQL} SELECT * FROM found")
def search_details_join(spark, sf_dir):
    """Listed ids joined to their details; missing ids dropped."""
    ids, details = _search_and_details(spark, sf_dir)
    return collect.lookup_details(ids, details).select("video_id", "page", "title", "views")


@query("search_details_join_repeats", """
WITH ids AS (SELECT event_id % 5000 AS video_id, event_id AS page FROM events),
r AS (SELECT event_id % 5000 AS video_id, event_id AS landed_at,
             concat(event_type, '-', CAST(user_id AS VARCHAR)) AS title,
             CAST(floor(value * 10) AS BIGINT) AS views FROM events WHERE event_type <> 'error'),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY landed_at DESC) AS rn
                     FROM r) WHERE rn = 1)
SELECT video_id, page, title, views FROM ids JOIN d USING (video_id)""")
def search_details_join_repeats(spark, sf_dir):
    """J1 with ids listed on several pages and looked up several times: one row
    per listing, with the newest reply."""
    ev = proxies.table(spark, sf_dir, "events")
    one = (F.col("event_id") % 5000).alias("video_id")
    replies = proxies.raw_videos_from_events(ev.filter(F.col("event_type") != "error")) \
        .select((F.col("video_id") % 5000).alias("video_id"), "title", "views",
                F.col("video_id").alias("landed_at"))
    return collect.lookup_details(ev.select(one, F.col("event_id").alias("page")), replies) \
        .select("video_id", "page", "title", "views")


@query("capped_collection", f"""WITH {_FOUND_SQL},
pc AS (SELECT page, count(*) AS n FROM found GROUP BY page),
pr AS (SELECT page, coalesce(sum(n) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND 1 PRECEDING), 0) AS before FROM pc)
SELECT f.video_id, f.page, f.title, f.views FROM found f JOIN pr USING (page)
WHERE pr.before < 100""")
def capped_collection(spark, sf_dir):
    """Videos of the pages read until 100 were found (page-granular)."""
    ids, details = _search_and_details(spark, sf_dir)
    out = collect.collect_videos(ids, details, cap=MAX_VIDEOS)
    return out.select("video_id", "page", "title", "views")


# ------------------------------------------------------------ report text
@query("short_titles", with_videos("""
SELECT video_id, concat(substring(title, 1, 5), '...') AS short_title FROM v"""))
def short_titles(spark, sf_dir):
    """P16 (cut at 5 characters here so that every title is cut)."""
    v = proxies.videos_events(spark, sf_dir, as_of_literal(EVENTS_AS_OF))
    return v.select("video_id", short_title("title", 5).alias("short_title"))


@query("number_text", with_videos("""
SELECT video_id, format('{:,}', views * 1000 + likes) AS views_text,
       format('{:,.4f}', engagement_rate) AS rate_text
FROM v"""))
def number_text(spark, sf_dir):
    """Thousands separators and four decimals."""
    v = proxies.videos_events(spark, sf_dir, as_of_literal(EVENTS_AS_OF))
    return v.select("video_id", thousands(F.col("views") * 1000 + F.col("likes")).alias("views_text"),
                    fixed4("engagement_rate").alias("rate_text"))


@query("report_top5_ordinal", with_videos("""
SELECT row_number() OVER (ORDER BY views DESC, video_id) AS ordinal, title, views
FROM v ORDER BY views DESC, video_id LIMIT 5"""))
def report_top5_ordinal(spark, sf_dir):
    """Ordinal numbers given after the top-5 limit (a window over 5 rows)."""
    v = proxies.videos_events(spark, sf_dir, as_of_literal(EVENTS_AS_OF))
    top = topk.top_videos(v, 5, ["video_id", "title", "views"])
    w = Window.orderBy(F.col("views").desc(), F.col("video_id"))
    return top.select(F.row_number().over(w).alias("ordinal"), "title", "views")
