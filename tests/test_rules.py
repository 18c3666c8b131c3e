import datetime as dt

import pytest

from pyspark.sql import functions as F

from chanpulse.functions.derive import as_of_literal
from chanpulse.operators import rules

NOW = dt.datetime(2024, 1, 31)


def test_ranges_lengths_decimals(spark):
    df = spark.createDataFrame(
        [("a", 24, 0, 12345.6, "x" * 21), ("b", 23, 7, 0.5, "Monday"), ("c", None, 1, None, None)],
        "video_id string, publish_hour int, publish_day_of_week int, engagement_rate double, "
        "publish_day string")
    rs = [rules.in_range("publish_hour", 0, 23), rules.in_range("publish_day_of_week", 1, 7),
          rules.fits("engagement_rate", "decimal(10,6)"), rules.max_length("publish_day", 20),
          *rules.not_null(["publish_hour"])]
    c = rules.violation_counts(df, rs).first().asDict()
    assert c == {"range_publish_hour": 1, "range_publish_day_of_week": 1,
                 "fits_engagement_rate": 1, "length_publish_day": 1, "not_null_publish_hour": 1}
    good, bad = rules.quarantine(df, rs)
    assert [r.video_id for r in good.collect()] == ["b"]
    assert {r.video_id: r.violations for r in bad.collect()}["c"] == "not_null_publish_hour"


def test_absent_columns(spark):
    df = spark.createDataFrame([("a",), ("b",)], "video_id string")
    rs = rules.applicable(df, [*rules.not_null(["video_id", "title"]), rules.in_range("publish_hour", 0, 23)])
    assert [r.name for r in rs] == ["not_null_video_id", "not_null_title"]
    assert rules.violation_counts(df, rs).first().asDict() == {"not_null_video_id": 0,
                                                               "not_null_title": 2}


def test_video_rule_set_applies_to_table_frames(spark):
    from chanpulse.schemas import VIDEO_TABLE
    df = spark.createDataFrame([], VIDEO_TABLE)
    rs = rules.applicable(df, rules.video_rules())
    assert len(rs) == len(rules.video_rules())
    assert all(v == 0 for v in rules.violation_counts(df, rs).first().asDict().values())


def test_freshness_channel_first(spark):
    old = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "captured_at timestamp")
    new = spark.createDataFrame([(dt.datetime(2024, 1, 30),)], "captured_at timestamp")
    v_old = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "created_at timestamp")
    v_new = spark.createDataFrame([(dt.datetime(2024, 1, 30),)], "created_at timestamp")
    with pytest.raises(ValueError, match="No recent channel data found"):
        rules.check_freshness(old, v_old, as_of_literal(NOW))
    with pytest.raises(ValueError, match="No recent video data found"):
        rules.check_freshness(new, v_old, as_of_literal(NOW))
    assert rules.check_freshness(new, v_new, as_of_literal(NOW)) == {
        "recent_channels": 1, "recent_videos": 1}


def test_profile_counts_rules_and_partitions_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("b", 30, 5), ("c", None, 7), ("d", 25, None)],
        "k string, publish_hour int, bucket int")
    rs = [rules.in_range("publish_hour", 0, 23)] + rules.not_null(["publish_hour"])
    p = rules.profile(df, rs, F.col("bucket"))
    assert p.rows == 4
    assert p.counts == {"range_publish_hour": 2, "not_null_publish_hour": 1}
    assert sorted(p.parts, key=lambda v: (v is None, v)) == [5, 7, None]
    empty = rules.profile(df.filter(F.lit(False)), rs, F.col("bucket"))
    assert empty.rows == 0 and empty.parts == [] and not any(empty.counts.values())


def test_quarantine_reads_its_source_once(spark, tmp_dir):
    """Both halves come from the flagged rows as they were written, not from the source again;
    a column without a type is kept."""
    spark.range(20).selectExpr("id AS n", "id % 24 AS publish_hour").write.parquet(f"{tmp_dir}/src")
    df = spark.read.parquet(f"{tmp_dir}/src").withColumns(
        {"nothing": F.lit(None), "publish_hour": F.col("publish_hour") * 2})
    good, bad = rules.quarantine(df, [rules.in_range("publish_hour", 0, 23)])
    for half in (good, bad):
        assert half.inputFiles() and not any("/src/" in f for f in half.inputFiles())
    assert good.columns == df.columns and bad.columns == [*df.columns, "violations"]
    assert sorted(r.n for r in good.collect()) == list(range(12))
    assert {(r.n, r.nothing, r.violations) for r in bad.collect()} == {
        (n, None, "range_publish_hour") for n in range(12, 20)}
