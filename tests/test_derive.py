import datetime as dt

from pyspark.sql import functions as F

from chanpulse.functions import derive
from chanpulse.functions.text import fixed4, short_title, stamp_text, thousands
from helpers import raw_videos, ts

AS_OF = dt.datetime(2024, 1, 31)


def processed(spark, rows):
    return derive.with_video_metrics(derive.with_ingest_fields(raw_videos(spark, rows)),
                                     derive.as_of_literal(AS_OF))


def test_rates_zero_when_views_zero_or_null(spark):
    rows = processed(spark, [("a", "t", ts(2024, 1, 1), 0, 5, 5),
                             ("b", "t", ts(2024, 1, 1), None, 5, 5),
                             ("c", "t", ts(2024, 1, 1), 10, 2, 3)]).orderBy("video_id").collect()
    assert [r.engagement_rate for r in rows] == [0.0, 0.0, 0.5]
    assert [r.likes_per_view for r in rows] == [0.0, 0.0, 0.2]
    assert [r.comments_per_view for r in rows] == [0.0, 0.0, 0.3]


def test_views_per_day_edges(spark):
    rows = processed(spark, [("a", "t", None, 100, 0, 0),
                             ("b", "t", AS_OF, 100, 0, 0),
                             ("c", "t", ts(2024, 1, 21), 100, 0, 0),
                             ("d", "t", ts(2024, 2, 10), 100, 0, 0)]).orderBy("video_id").collect()
    a, b, c, d = rows
    assert a.views_per_day == 0.0 and a.publish_date is None and a.publish_month is None
    assert b.views_per_day is None  # zero age: no division error
    assert c.views_per_day == 10.0
    assert d.views_per_day == -10.0  # future time keeps its sign


def test_date_parts_weekday_sunday_is_one(spark):
    r = processed(spark, [("a", "t", ts(2022, 9, 24, 0, 14, 15), 1, 0, 0),
                          ("b", "t", ts(2022, 9, 25, 23, 0, 0), 1, 0, 0)]).orderBy("video_id").collect()
    assert (r[0].publish_day, r[0].publish_day_of_week, r[0].publish_hour) == ("Saturday", 7, 0)
    assert (r[1].publish_day, r[1].publish_day_of_week, r[1].publish_hour) == ("Sunday", 1, 23)
    assert r[0].publish_month == "2022-09" and r[0].publish_date == dt.date(2022, 9, 24)


def test_offset_uses_utc_date_and_hour(spark):
    df = spark.createDataFrame([("2024-03-10T23:30:00+02:00",), ("2021-03-14T05:07:09Z",),
                                ("garbage",)], "s string")
    out = df.select(derive.parse_iso_timestamp("s").alias("t")).select(
        "t", F.hour("t").alias("h"), F.to_date("t").alias("d")).collect()
    assert out[0].h == 21 and out[0].d == dt.date(2024, 3, 10)
    assert out[1].t == dt.datetime(2021, 3, 14, 5, 7, 9)
    assert out[2].t is None  # malformed: NULL, no exception


def test_counter_defaults(spark):
    df = spark.createDataFrame([("12",), (None,), ("12x",), ("3000000000",), ("",)], "s string")
    got = df.select(derive.counter("s"), derive.bad_counter("s")).collect()
    # only an absent counter is 0
    assert [r[0] for r in got] == [12, 0, None, 3000000000, None]
    assert [r[1] for r in got] == [False, False, True, False, True]


def test_table_decimals_round_half_away(spark):
    df = spark.createDataFrame([(0.0000005, 2.675), (-0.0000005, 12345.6)],
                               "engagement_rate double, views_per_day double")
    out = derive.narrow_to_table_types(df.withColumn("likes_per_view", F.lit(12345.6))).collect()
    assert str(out[0].engagement_rate) == "0.000001"
    assert str(out[1].engagement_rate) == "-0.000001"
    assert str(out[0].views_per_day) == "2.68"
    assert out[0].likes_per_view is None  # out of DECIMAL(10,6) range -> rule, not error


def test_defaults_only_for_missing_columns(spark):
    df = spark.createDataFrame([("a", None)], "video_id string, views bigint")
    out = derive.with_defaults(df, {"views": 0, "likes": 0}).collect()[0]
    assert out.views is None and out.likes == 0


def test_report_text(spark):
    df = spark.createDataFrame([("x" * 60, 1234567, 0.0374632835, dt.datetime(2025, 11, 5, 19, 58, 4, 790258)),
                                ("short", 12, 0.5, dt.datetime(2025, 1, 1))],
                               "title string, views bigint, er double, t timestamp")
    r = df.select(short_title("title").alias("s"), thousands("views").alias("v"),
                  fixed4("er").alias("e"), stamp_text("t").alias("t")).collect()
    assert r[0].s == "x" * 50 + "..." and r[1].s == "short..."
    assert r[0].v == "1,234,567" and r[0].e == "0.0375"
    assert r[0].t == "2025-11-05 19:58:04.790258+00:00" and r[1].t == "2025-01-01 00:00:00+00:00"
