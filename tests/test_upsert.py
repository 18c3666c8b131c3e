import datetime as dt

import pytest
from pyspark.sql import functions as F

from chanpulse.functions.derive import as_of_literal
from chanpulse.operators.upsert import (
    DuplicateKeyError, assign_ids, batch_stats, duplicate_keys, keep_last, upsert,
)

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 1, 31)
SCHEMA = ("id long, video_id string, title string, publish_time timestamp, views long, "
          "likes long, created_at timestamp, updated_at timestamp")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batch(spark, rows):
    return spark.createDataFrame(rows, "video_id string, title string, publish_time timestamp, "
                                       "views long, likes long")


def run(target, source, update, strategy="auto", **kw):
    out = upsert(target, source, ["video_id"], update, as_of_literal(NOW), created="created_at",
                 updated="updated_at", id_col="id", strategy=strategy, **kw)
    return {r.video_id: r for r in out.collect()}


@pytest.fixture()
def base(spark):
    t = table(spark, [(1, "a", "A", T0, 10, 1, T0, T0), (2, "b", "B", T0, 20, 2, T0, T0)])
    s = batch(spark, [("b", "B2", dt.datetime(2023, 5, 5), 25, 3), ("c", "C", T0, 5, 0)])
    return t, s


@pytest.mark.parametrize("strategy", ["shuffle", "auto"])
def test_full_upsert(spark, base, strategy):
    t, s = base
    out = run(t, s, ["title", "views", "likes"], strategy)
    assert set(out) == {"a", "b", "c"}
    a, b, c = out["a"], out["b"], out["c"]
    assert (a.title, a.views, a.updated_at) == ("A", 10, T0)           # untouched
    assert (b.title, b.views, b.likes) == ("B2", 25, 3)                 # updated from batch
    assert b.publish_time == T0 and b.created_at == T0                   # kept
    assert b.updated_at == NOW and b.id == 2                             # trigger, id kept
    assert (c.created_at, c.updated_at, c.id) == (NOW, NOW, 3)           # insert, next id


def test_unchecked_broadcast_is_no_strategy(spark, base):
    with pytest.raises(ValueError, match="strategy"):
        run(*base, ["title"], "broadcast")


@pytest.mark.parametrize("strategy", ["shuffle", "auto"])
def test_inserted_rows_take_defaults(spark, base, strategy):
    t, s = base
    out = run(t, s.drop("likes"), ["title", "views"], strategy, defaults={"likes": 0})
    assert out["c"].likes == 0 and out["b"].likes == 2


def test_narrow_upsert_keeps_likes(spark, base):
    t, s = base
    out = run(t, s, ["title", "views"])
    assert out["b"].likes == 2 and out["b"].views == 25 and out["c"].likes == 0


def test_duplicate_key_in_batch(spark, base):
    t, _ = base
    s = batch(spark, [("b", "x", T0, 1, 1), ("b", "y", T0, 2, 2)])
    with pytest.raises(DuplicateKeyError):
        run(t, s, ["title"])
    s2 = s.withColumn("seq", F.col("views"))
    out = upsert(t, s2, ["video_id"], ["title"], as_of_literal(NOW), updated="updated_at",
                 on_duplicate="last", order_by="seq")
    assert {r.video_id: r.title for r in out.collect()}["b"] == "y"


def test_upsert_twice_is_once_and_halves_union(spark, base):
    t, s = base
    once = upsert(t, s, ["video_id"], ["title", "views"], as_of_literal(NOW), updated="updated_at")
    twice = upsert(once, s, ["video_id"], ["title", "views"], as_of_literal(NOW),
                   updated="updated_at")
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert key(once) == key(twice)
    h1, h2 = s.filter("video_id = 'b'"), s.filter("video_id = 'c'")
    step = upsert(upsert(t, h1, ["video_id"], ["title", "views"], as_of_literal(NOW),
                         updated="updated_at"),
                  h2, ["video_id"], ["title", "views"], as_of_literal(NOW), updated="updated_at")
    assert key(step) == key(once)


def test_empty_batch_leaves_table(spark, base):
    t, s = base
    out = upsert(t, s.limit(0), ["video_id"], ["title"], as_of_literal(NOW))
    assert out.count() == 2


def test_channel_created_at_refreshed(spark):
    t = spark.createDataFrame([("c", T0, 5, T0)], "channel_id string, captured_at timestamp, "
                                                   "subscribers long, created_at timestamp")
    s = spark.createDataFrame([("c", T0, 6)], "channel_id string, captured_at timestamp, "
                                               "subscribers long")
    r = upsert(t, s, ["channel_id", "captured_at"], ["subscribers"], as_of_literal(NOW),
               created="created_at", refresh_created=True).first()
    assert r.subscribers == 6 and r.created_at == NOW


def test_dense_ids(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("id2", F.lit(None).cast("long"))
    out = assign_ids(df, "id2", 41).collect()
    ids = sorted(r.id2 for r in out)
    assert ids == list(range(42, 1042))


def test_keep_last_and_duplicates(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("j", 1, "z")],
                               "key string, seq int, v string")
    got = {r.key: r.v for r in keep_last(df, ["key"], "seq").collect()}
    assert got == {"k": "c", "j": "z"}
    odd = spark.createDataFrame([(None, None, "a"), (None, None, "b"), ("k", None, "c"), ("k", 1, "d"),
                                 ("k", 1, "d")], "key string, seq int, v string")
    assert sorted((r.key or "", r.v) for r in keep_last(odd, ["key"], "seq").collect()) == [
        ("", "b"), ("k", "d")]
    assert [(r.key, r.n) for r in duplicate_keys(df, ["key"]).collect()] == [("k", 3)]


def test_batch_stats(spark):
    df = spark.createDataFrame([("ab", 1), ("cd", 2), ("cd", 3)], "k string, v long")
    st = batch_stats(df, ["k"])
    assert st.rows == 3 and st.max_repeat == 2 and st.bytes == 3 * (2 + 8 + 8)
