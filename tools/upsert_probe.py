"""Upsert of 1 % and of 50 % of a table's keys (lineitem x k rows): into a plain frame by both
plans, and into a table that is bucketed by the key, with and without ids and the write.

    python tools/upsert_probe.py [sf_dir] [k]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    from pyspark.sql import functions as F
    from chanpulse.functions.derive import as_of_literal
    from chanpulse.operators.upsert import upsert
    from chanpulse.plans import proxies
    from chanpulse.session import build_session, materialise
    spark = build_session("local[8]", "upsert-probe", 8, {"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    now = as_of_literal("2002-01-01 00:00:00")
    raw = proxies.raw_videos_from_lineitem(proxies.table(spark, sf_dir, "lineitem"))
    raw = raw.drop("video_id").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(k))))
    raw = raw.withColumn("video_id", F.monotonically_increasing_id().cast("string")).drop("copy")
    table = materialise(proxies.processed(raw, now).withColumns(
        {"created_at": now, "updated_at": now}), "probe-table")
    n = table.count()
    for share in (0.01, 0.5):
        picked = F.pmod(F.xxhash64("video_id"), F.lit(1000)) < int(1000 * share)
        batch = materialise(table.filter(picked).drop("created_at", "updated_at")
                            .withColumn("views", F.col("views") + 1), "probe-batch")
        for strategy in ("auto", "shuffle"):
            t0, info = time.perf_counter(), {}
            upsert(table, batch, ["video_id"], ["views", "likes", "title"], now,
                   created="created_at", updated="updated_at", strategy=strategy, info=info) \
                .write.format("noop").mode("overwrite").save()
            print(f"{share:.0%} of {n} keys, {strategy}: {time.perf_counter() - t0:.2f} s "
                  f"(batch {info['bytes'] / 1e6:.1f} MB, broadcast {info['broadcast']})")
    from chanpulse import schemas as S
    from chanpulse.operators.upsert import matched_keys, merge, prepared
    from chanpulse.plans.load import merge_into, warehouse
    from chanpulse.session import scratch_path
    wh = warehouse(spark, scratch_path(spark, "probe-warehouse"), video_buckets=16)
    rows = table.withColumn("id", F.monotonically_increasing_id())
    types = {f.name: f.dataType for f in S.VIDEO_TABLE.fields}
    wh.videos.overwrite(rows.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])
                        .repartition(16, "video_id"))
    update, keys = ["views", "likes", "title"], S.VIDEO_KEYS
    for share in (0.01, 0.5):
        picked = F.pmod(F.xxhash64("video_id"), F.lit(1000)) < int(1000 * share)
        batch = materialise(wh.videos.read().filter(picked).drop("created_at", "updated_at", "id")
                            .withColumn("views", F.col("views") + 1), "probe-batch")
        t0 = time.perf_counter()
        b = prepared(batch, keys, batch.columns)
        found = matched_keys(wh.videos.stored(), b, keys, [wh.videos.month], wh.videos.buckets)
        merge(wh.videos.read(), b, keys, update, now, updated="updated_at", matched=found,
              buckets=wh.videos.buckets).write.format("noop").mode("overwrite").save()
        t1 = time.perf_counter()
        merge_into(wh.videos, batch, update, now, created="created_at", updated="updated_at")
        print(f"{share:.0%} of {n} keys, buckets in place: {t1 - t0:.2f} s merged, "
              f"{time.perf_counter() - t1:.2f} s loaded with ids and written")
    spark.stop()


if __name__ == "__main__":
    main()
