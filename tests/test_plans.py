"""Plan shape checks: pushdown, pruning, no Python in the hot path, the
physical operators each design choice relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

from chanpulse.functions.derive import as_of_literal
from chanpulse.operators import filters, rollup, topk
from chanpulse.operators.upsert import upsert
from chanpulse.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PLAIN = ["derive_videos", "day_performance", "hour_performance", "monthly_trends_lineitem",
         "engagement_stats", "daily_performance", "hourly_heatmap", "video_summary",
         "engagement_trend_30d", "top_videos_10", "latest_snapshot_per_channel",
         "subscribers_over_time", "search_details_join", "capped_collection", "rule_violations",
         "duplicate_snapshot_keys", "short_titles", "number_text", "video_replies",
         "summary_report"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_registered_plans(spark):
    for name in PLAIN:
        p = plan(QUERIES[name](spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
            assert node not in p, (name, node)


def test_pruned_scan_and_partial_aggregate(spark):
    df = QUERIES["day_performance"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text or "HashAggregate" in text
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert "props" not in schema and "event_type" not in schema  # unused columns never read
    assert "SinglePartition" not in text  # nothing bounds the keys of an unchecked file


def test_filter_reaches_parquet_scan(spark, tmp_dir):
    rows = [(dt.datetime(2024, 1, d), f"c{d}", d) for d in range(1, 31)]
    spark.createDataFrame(rows, "captured_at timestamp, channel_id string, subscribers long") \
        .write.parquet(f"{tmp_dir}/ch")
    ch = spark.read.parquet(f"{tmp_dir}/ch")
    df = filters.recent_channels(ch, as_of_literal(dt.datetime(2024, 1, 31)))
    p = plan(df)
    assert "PushedFilters: [IsNotNull(captured_at), GreaterThanOrEqual(captured_at" in p
    assert df.count() == 2


def test_series_use_global_range_sort(spark):
    p = plan(QUERIES["subscribers_over_time"](spark, SF))
    assert "rangepartitioning" in p  # grows with the data: distributed sort


def test_newest_row_per_key_is_one_pass(spark):
    """One scan; the rank's limit is applied within each task, before the exchange."""
    p = plan(QUERIES["latest_snapshot_per_channel"](spark, SF))
    assert p.count("Scan parquet") == 1 and "Join" not in p
    limits = re.findall(r"WindowGroupLimit .*(Partial|Final)", p)
    assert limits == ["Final", "Partial"] * 2  # repeated snapshots, then the newest
    # a lookup of ids reads each reply once
    p = plan(QUERIES["search_details_join"](spark, SF))
    assert p.count("Scan parquet") == 2 and "Partial" in p


def test_shared_rollup_is_cached(spark):
    v = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_id AS video_id", "CAST(ts AS TIMESTAMP) AS publish_time", "1L AS views",
        "0L AS likes", "0L AS comments")
    from chanpulse.functions.derive import with_ingest_fields, with_video_metrics
    v = with_video_metrics(with_ingest_fields(v), as_of_literal(dt.datetime(2024, 2, 1)))
    base = rollup.BaseRollup.build(v)
    for fn in (rollup.day_performance, rollup.hour_performance, rollup.monthly_trends):
        assert "InMemoryTableScan" in plan(fn(base))
    base.df.unpersist()


def test_upsert_small_batch_is_broadcast(spark):
    t = spark.range(0, 5000).selectExpr("CAST(id AS STRING) AS video_id", "id AS views",
                                         "CAST(NULL AS TIMESTAMP) AS updated_at")
    s = spark.range(0, 10).selectExpr("CAST(id AS STRING) AS video_id", "id + 1 AS views")
    p = plan(upsert(t, s, ["video_id"], ["views"], as_of_literal(dt.datetime(2024, 1, 1)),
                    created=None, updated="updated_at"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    p2 = plan(upsert(t, s, ["video_id"], ["views"], as_of_literal(dt.datetime(2024, 1, 1)),
                     created=None, updated="updated_at", strategy="shuffle"))
    assert "SortMergeJoin" in p2 and "BroadcastHashJoin" not in p2


def test_large_upsert_is_one_join(spark):
    t = spark.range(0, 5000).selectExpr("CAST(id AS STRING) AS video_id", "id AS views",
                                         "CAST(NULL AS TIMESTAMP) AS updated_at")
    s = spark.range(0, 10).selectExpr("CAST(id AS STRING) AS video_id", "id + 1 AS views")
    p = plan(upsert(t, s, ["video_id"], ["views"], as_of_literal(dt.datetime(2024, 1, 1)),
                    created=None, updated="updated_at", strategy="shuffle"))
    assert p.count("SortMergeJoin") == 1 and "FullOuter" in p and p.count("Exchange hash") == 2


def test_fresh_counts_prune_both_scans(spark, tmp_dir):
    day = dt.datetime(2024, 1, 31)
    spark.createDataFrame([(day,)], "captured_at timestamp").write.parquet(f"{tmp_dir}/c")
    spark.createDataFrame([(day,)], "created_at timestamp").write.parquet(f"{tmp_dir}/v")
    p = plan(filters.fresh_counts(spark.read.parquet(f"{tmp_dir}/c"), spark.read.parquet(f"{tmp_dir}/v"),
                                  as_of_literal(day)))
    for column in ("captured_at", "created_at"):
        assert f"GreaterThanOrEqual({column}" in p


def test_top_lists_list_no_files(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "inputFiles", lambda self: 1 / 0)
    for name in ("top_videos_10", "latest_channel_snapshot", "subscribers_over_time"):
        p = plan(QUERIES[name](spark, SF))
        assert "Scan parquet" in p


def test_series_shuffles_no_unused_columns(spark):
    p = plan(QUERIES["subscribers_over_time"](spark, SF).select("time"))
    assert "channel_title" not in p.split("Exchange rangepartitioning")[0]


def test_top_k_plan(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_videos_100"](spark, SF))
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS video_id", "id % 7 AS views")
    assert "TakeOrderedAndProject" in plan(topk.top_videos(df, 5).select(F.col("video_id")))


def test_capped_collection_reads_details_of_kept_pages_only(spark):
    """Replies of other ids are dropped before the newest one of an id is sought."""
    df = QUERIES["capped_collection"](spark, SF)
    rows = df.count()
    p = plan(df)
    ranks = p.index("WindowGroupLimit")
    assert "LeftSemi" in p[ranks:]  # below the rank
    from chanpulse.operators import collect
    seen = []
    whole = collect.lookup_details

    def spy(ids, details, *a, **kw):
        seen.append((ids.count(), details.count()))
        return whole(ids, details, *a, **kw)
    collect.lookup_details = spy
    try:
        QUERIES["capped_collection"](spark, SF)
    finally:
        collect.lookup_details = whole
    assert seen == [(rows, rows)]
