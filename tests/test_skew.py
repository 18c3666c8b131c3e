"""One key holding a third of all rows: results stay whole and exact, and the
plans reduce the hot key before any shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from chanpulse.functions.derive import as_of_literal
from chanpulse.operators import collect, topk
from chanpulse.operators.upsert import duplicate_keys, keep_last, upsert

N = 30000


def snapshots(spark):
    # channel "hot" holds a third of all snapshots
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string"))).alias("channel_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(secs=F.col("id"))).alias("captured_at"),
        F.col("id").alias("subscribers"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_channel_hot_key(spark):
    df = snapshots(spark)
    out = {r.channel_id: r.subscribers for r in topk.latest_per_channel(df).collect()}
    assert out["hot"] == N - (N % 3 or 3)  # largest id divisible by 3
    assert len(out) == 1 + 997
    p = plan(topk.latest_per_channel(df))
    below = p[p.index("Exchange"):]  # reduced to a row per key in each task before that
    assert "WindowGroupLimit" in below and "Partial" in below


def test_keep_last_and_duplicates_hot_key(spark):
    df = snapshots(spark).withColumn("captured_at", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))
    last = {r.channel_id: r.subscribers for r in keep_last(df, ["channel_id"], "subscribers").collect()}
    assert last["hot"] == max(i for i in range(N) if i % 3 == 0)
    dups = {r.channel_id: r.n for r in duplicate_keys(df, ["channel_id", "captured_at"]).collect()}
    assert dups["hot"] == N // 3
    assert "partial_count" in plan(duplicate_keys(df, ["channel_id"]))


def test_hot_id_in_lookup_is_kept_whole(spark):
    ids = spark.range(N).select((F.col("id") % 50).alias("page"),
                                F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                .otherwise(F.col("id").cast("string")).alias("video_id"))
    details = spark.range(N).select(F.when(F.col("id") == 0, F.lit("hot"))
                                    .otherwise(F.col("id").cast("string")).alias("video_id"),
                                    F.col("id").alias("views"))
    assert collect.lookup_details(ids, details).count() == N  # repeats kept, none dropped
    # with thresholds scaled to the fixture, the hot id is found and split off
    assert collect.hot_keys(ids, "video_id", sample=0.2, hot_rows=1000) == ["hot"]
    split = collect.lookup_details(ids, details, sample=0.2, hot_rows=1000)
    assert split.count() == N
    assert split.filter(F.col("video_id") == "hot").count() == N // 3
    assert "BroadcastHashJoin" in plan(split)
    same = split.exceptAll(collect.lookup_details(ids, details, hot=[]))
    assert same.count() == 0


def test_upsert_batch_with_hot_key_last_wins(spark):
    target = spark.createDataFrame([("hot", 1, None)], "k string, v long, updated_at timestamp")
    batch = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                  .otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").alias("v"), F.col("id").alias("seq"))
    out = upsert(target, batch, ["k"], ["v"], as_of_literal(dt.datetime(2024, 1, 1)),
                 created=None, updated="updated_at", on_duplicate="last", order_by="seq")
    got = {r.k: r.v for r in out.collect()}
    assert got["hot"] == max(i for i in range(N) if i % 3 == 0)
    assert len(got) == 1 + (N - N // 3)


def test_repeated_replies_give_one_row_per_listing(spark):
    ids = spark.range(N).select(F.col("id").alias("page"),
                                F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                .otherwise(F.col("id").cast("string")).alias("video_id"))
    details = spark.range(3 * N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % N).cast("string"))
        .alias("video_id"), F.col("id").alias("views"), F.col("id").alias("landed_at"))
    for args in ({"hot": []}, {"sample": 0.2, "hot_rows": 1000}):
        out = collect.lookup_details(ids, details, **args)
        assert out.columns == ["video_id", "page", "views"] and out.count() == N
        hot = out.filter(F.col("video_id") == "hot").select("views").distinct().collect()
        assert [r.views for r in hot] == [3 * N - 3]


def test_cap_reads_no_page_beyond_its_range(spark):
    ids = spark.range(5000).select(F.floor(F.col("id") / 50).alias("page"),
                                   F.col("id").cast("string").alias("video_id"))
    details = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("video_id"),
                                             F.col("id").alias("views"))
    assert collect.first_pages(ids, details, 100) == 4
    assert collect.first_pages(ids, details, 10_000) is None
    out = collect.collect_videos(ids, details, cap=100)
    assert sorted({r.page for r in out.collect()}) == [0, 1, 2, 3] and out.count() == 100
    assert collect.collect_videos(ids, details).count() == 2500  # no cap: everything
    assert collect.collect_videos(ids.limit(0), details, cap=5).count() == 0


def test_hot_id_edges(spark):
    uniform = spark.range(N).select(F.col("id").cast("string").alias("video_id"))
    assert collect.hot_keys(uniform, "video_id", sample=0.2, hot_rows=1000) == []
    ids = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit("gone"))
                                .otherwise(F.col("id").cast("string")).alias("video_id"))
    details = spark.range(N).select(F.col("id").cast("string").alias("video_id"))
    # a hot id without details is dropped, as by the plain inner join
    out = collect.lookup_details(ids, details, sample=0.2, hot_rows=1000)
    assert out.count() == N - (N + 2) // 3
    assert out.filter(F.col("video_id") == "gone").count() == 0
