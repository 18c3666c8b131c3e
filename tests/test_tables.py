"""The warehouse tables: found by name, typed, pruned by month, merged in place."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from chanpulse import schemas as S
from chanpulse.functions.derive import as_of_literal
from chanpulse.operators import filters
from chanpulse.operators.upsert import matched_keys, merge, prepared
from chanpulse.plans.load import load_channels, load_videos, warehouse
from chanpulse.plans.quality import quality_check
from test_plans import plan

NOW = dt.datetime(2024, 3, 20)


def videos(spark, first, last, views=1):
    return spark.range(first, last).select(
        F.format_string("v%05d", "id").alias("video_id"), F.lit("T").alias("title"),
        F.lit(dt.datetime(2024, 1, 5)).alias("publish_time"), F.lit(views).cast("long").alias("views"),
        F.lit(1).cast("long").alias("likes"), F.lit(1).cast("long").alias("comments"),
        F.lit(0.5).alias("engagement_rate"), F.lit("Friday").alias("publish_day"),
        F.lit(0).alias("publish_hour"), F.lit(0.1).alias("likes_per_view"),
        F.lit(0.1).alias("comments_per_view"), F.lit(1.0).alias("views_per_day"),
        F.lit(dt.date(2024, 1, 5)).alias("publish_date"), F.lit(6).alias("publish_day_of_week"),
        F.lit("2024-01").alias("publish_month"))


def channels(spark, months, per_month=3):
    return spark.range(months * per_month).select(
        F.add_months(F.lit(dt.date(2023, 1, 1)), F.floor(F.col("id") / per_month).cast("int"))
        .cast("timestamp").alias("captured_at"),
        F.concat(F.lit("c"), F.col("id") % per_month).alias("channel_id"),
        F.lit("T").alias("channel_title"), F.col("id").alias("subscribers"),
        F.col("id").alias("total_views"), F.lit(1).alias("video_count"))


@pytest.fixture()
def wh(spark, tmp_dir):
    return warehouse(spark, f"{tmp_dir}/wh", video_buckets=3, channel_buckets=2)


def test_another_session_finds_typed_tables(spark, wh):
    load_channels(wh, channels(spark, 2), as_of_literal(NOW))
    load_videos(wh, videos(spark, 0, 20), as_of_literal(NOW))
    other = spark.newSession()
    for table, schema in (("channel_stats", S.CHANNEL_TABLE), ("videos", S.VIDEO_TABLE)):
        found = {f.name: f.dataType for f in other.table(f"{wh.database}.{table}").schema.fields}
        assert {f.name: f.dataType for f in schema.fields}.items() <= found.items()
    assert other.sql(f"SELECT count(*), max(id) FROM {wh.database}.videos").first()[:] == (20, 20)


def test_a_named_database(spark, tmp_dir):
    wh = warehouse(spark, f"{tmp_dir}/wh", database="chanpulse_named")
    load_videos(wh, videos(spark, 0, 5), as_of_literal(NOW))
    assert spark.table("chanpulse_named.videos").count() == 5


@pytest.mark.parametrize("share", [1, 60])
def test_the_table_is_not_moved(spark, wh, share):
    """No exchange between the join and the table's buckets, for small and large batches."""
    load_videos(wh, videos(spark, 0, 100), as_of_literal(NOW))
    table, keys = wh.videos, S.VIDEO_KEYS
    b = prepared(videos(spark, 100 - share, 130, 2), keys, [c for c in table.read().columns
                                                             if c in videos(spark, 0, 1).columns])
    found = matched_keys(table.stored(), b, keys, [table.month], table.buckets)
    assert found.count() == share
    p = plan(merge(table.read(), b, keys, S.VIDEO_UPDATE_FULL, as_of_literal(NOW), id_col="id",
                   id_start=100, updated="updated_at", matched=found, buckets=table.buckets))
    join = p[p.index("SortMergeJoin"):]
    target = join[:join.index("Exchange")]
    assert "FullOuter" in target and "Bucketed: true" in target and ".videos[" in target


def test_a_load_replaces_the_months_it_touches(spark, wh):
    load_channels(wh, channels(spark, 6), as_of_literal(NOW))
    files = lambda: {f for f in wh.channels.stored().inputFiles()}
    before = files()
    batch = channels(spark, 6).filter("captured_at >= '2023-06-01'").withColumn(
        "subscribers", F.lit(99).cast("long"))
    load_channels(wh, batch, as_of_literal(NOW))
    gone = {f.split("captured_month=")[1].split("/")[0] for f in before - files()}
    assert gone == {"2023-06-01"}
    rows = wh.channels.read().collect()
    assert len(rows) == 18 and sum(r.subscribers == 99 for r in rows) == 3
    assert sorted(r.id for r in rows) == list(range(1, 19))


def test_a_backfill_writes_one_file_a_month_and_bucket(spark, wh):
    """However many partitions the merge has, and again when the rows are merged anew."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    try:
        for k in range(2):
            batch = channels(spark, 60).withColumn("total_views", F.lit(k).cast("long"))
            load_channels(wh, batch.repartition(17), as_of_literal(NOW))
            files = wh.channels.stored().inputFiles()
            months = wh.channels.stored().select(wh.channels.month).distinct().count()
            assert months > 3 and len(files) <= months * wh.channels.buckets
            rows = wh.channels.read()
            assert rows.count() == batch.count() and rows.filter(F.col("total_views") != k).isEmpty()
            assert rows.select("id").distinct().count() == rows.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_videos_stay_in_the_month_they_came(spark, wh):
    for k, (first, last) in enumerate(((0, 30), (20, 50), (10, 25))):
        load_videos(wh, videos(spark, first, last, views=k), as_of_literal(dt.datetime(2024, 1 + k, 9)))
    got = {r.video_id: (r.id, r.views, r.created_at.month, r.updated_at.month)
           for r in wh.videos.read().collect()}
    assert len(got) == 50 and len({v[0] for v in got.values()}) == 50
    assert got["v00005"][1:] == (0, 1, 1) and got["v00012"][1:] == (2, 1, 3)
    assert got["v00022"][1:] == (2, 1, 3) and got["v00040"][1:] == (1, 2, 2)
    assert {v[0] for k, v in got.items() if k >= "v00030"} == set(range(31, 51))
    months = {str(r[0]) for r in wh.videos.stored().select("created_month").distinct().collect()}
    assert months == {"2024-01-01", "2024-02-01"}


def test_a_failed_merge_leaves_the_table(spark, wh, monkeypatch):
    from chanpulse.sources.tables import Table
    load_videos(wh, videos(spark, 0, 10), as_of_literal(NOW))
    whole = Table.overwrite

    def broken(self, df):
        whole(self, df.withColumn("title", F.when(F.col("video_id") == "v00011", F.raise_error(
            F.lit("lost"))).otherwise(F.col("title"))))
    monkeypatch.setattr(Table, "overwrite", broken)
    with pytest.raises(Exception, match="lost"):
        load_videos(wh, videos(spark, 5, 15, views=7), as_of_literal(NOW))
    monkeypatch.undo()
    assert wh.videos.read().agg(F.count("*"), F.sum("views")).first()[:] == (10, 10)


def test_freshness_reads_the_months_it_needs(spark, wh):
    load_channels(wh, channels(spark, 15), as_of_literal(NOW))
    load_videos(wh, videos(spark, 0, 20), as_of_literal(dt.datetime(2023, 1, 9)))
    load_videos(wh, videos(spark, 20, 25), as_of_literal(NOW))
    as_of = as_of_literal(dt.datetime(2024, 3, 2))
    p = plan(filters.fresh_counts(wh.channels.stored(), wh.videos.stored(), as_of))
    assert "isnotnull(captured_month" in p and "isnotnull(created_month" in p
    assert p.count("PartitionFilters: [isnotnull(") == 2
    recent = filters.recent_channels(wh.channels.stored(), as_of)
    assert {r.captured_month for r in recent.collect()} == {dt.date(2024, 3, 1)}
    read = {f.split("captured_month=")[1].split("/")[0] for f in recent.inputFiles()}
    assert read == {"2024-02-01", "2024-03-01"}  # two folders, however many there are
    assert quality_check(wh, dt.datetime(2024, 3, 2)) == {"recent_channels": 3, "recent_videos": 5}
    with pytest.raises(ValueError, match="channel"):
        quality_check(wh, dt.datetime(2025, 1, 1))


def test_empty_tables_read_empty(spark, wh):
    assert wh.videos.read().count() == 0 and wh.channels.read().count() == 0
    load_videos(wh, videos(spark, 0, 0), as_of_literal(NOW))
    assert wh.videos.read().count() == 0


def plain(df):
    """Values of a small frame; averages of decimals have another scale over partials."""
    number = lambda x: isinstance(x, (int, float, decimal.Decimal))
    return [[round(float(x), 6) if number(x) else x for x in r] for r in df.collect()]


def test_stored_partials_follow_the_loads(spark, wh):
    """A second load renews the partitions it touched and no other; the analytics agree."""
    from chanpulse.operators import rollup
    files = lambda: {f for f in spark.table(wh.video_rollup.name).inputFiles()}
    load_videos(wh, videos(spark, 0, 30, views=9), as_of_literal(dt.datetime(2024, 1, 9)))
    load_videos(wh, videos(spark, 30, 50, views=5), as_of_literal(dt.datetime(2024, 2, 9)))
    before = files()
    load_videos(wh, videos(spark, 30, 60, views=2), as_of_literal(dt.datetime(2024, 2, 20)))
    kept = {f for f in before & files()}
    assert kept and all("created_month=2024-01-01" in f for f in kept)
    assert {f for f in before if "2024-02-01" in f}.isdisjoint(files())
    for analytic in (rollup.daily_performance, rollup.hourly_heatmap, rollup.monthly_trends_view,
                     rollup.video_summary, rollup.engagement_stats, rollup.day_performance):
        direct, stored = plain(analytic(wh.videos.read())), plain(analytic(wh.rollup()))
        assert stored == direct
    # the largest value was lowered by no load, the smallest changed: both are the rows' own
    assert rollup.video_summary(wh.rollup()).first()["max_views"] == 9
    load_videos(wh, videos(spark, 0, 30, views=1), as_of_literal(dt.datetime(2024, 3, 1)))
    assert rollup.video_summary(wh.rollup()).first()["max_views"] == 2


def test_a_table_that_outgrew_its_buckets(spark, wh, monkeypatch):
    """A bucket that is too much for a task is merged in parts, files of one bucket each; a
    later load that fits reads them as the bucket that they are."""
    from pyspark.sql.types import IntegerType

    from chanpulse.operators import upsert
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for k, (first, last, task) in enumerate(((0, 300, 300), (200, 500, 300), (100, 250, 1 << 30))):
            monkeypatch.setattr(upsert, "TASK_BYTES", task, raising=False)
            load_videos(wh, videos(spark, first, last, views=k), as_of_literal(NOW))
            path = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1).cast(IntegerType())
            rows = wh.videos.stored().select(
                path.alias("file"), F.input_file_name().alias("name"),
                F.pmod(F.hash("video_id"), F.lit(wh.videos.buckets)).alias("bucket"))
            assert rows.filter("file <> bucket").isEmpty()
            largest = rows.groupBy("name").count().agg(F.max("count")).first()[0]
            assert largest < 20 if task == 300 else largest > 100
            got = wh.videos.read().select("video_id", "views", "id").collect()
            assert sorted(r.id for r in got) == list(range(1, len(got) + 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.video_id: r.views for r in got} == {
        f"v{i:05d}": 2 if 100 <= i < 250 else int(i >= 200) for i in range(500)}
