"""Grouped analytics at larger scale: direct aggregates vs the shared base
roll-up, on videos derived from lineitem replicated ``k`` times in Spark
(every row of the table, ``k`` copies with distinct ids).

    python tools/scale_probe.py /root/testdata/sf0.1 16
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    from chanpulse.functions.derive import as_of_literal
    from chanpulse.operators import rollup, topk
    from chanpulse.plans import proxies
    from chanpulse.session import build_session, scratch_path
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    li = proxies.table(spark, sf_dir, "lineitem")
    rep = (li.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
           .withColumn("l_orderkey", F.col("l_orderkey") * k + F.col("_copy")))
    v = proxies.processed(proxies.raw_videos_from_lineitem(rep), as_of_literal("2002-01-01 00:00:00"))
    path = scratch_path(spark, "scale_videos")
    v.repartition(64).write.parquet(path)  # a table of many files, as at scale
    videos = spark.read.parquet(path)
    n = videos.count()
    outputs = [rollup.day_performance, rollup.hour_performance, rollup.monthly_trends,
               rollup.engagement_stats, rollup.daily_performance, rollup.hourly_heatmap,
               rollup.monthly_trends_view, rollup.video_summary]

    def run_all(src):
        for fn in outputs:
            fn(src).write.format("noop").mode("overwrite").save()
        topk.top_videos(videos).write.format("noop").mode("overwrite").save()

    run_all(videos)  # warm-up
    t0 = time.perf_counter()
    run_all(videos)
    direct = time.perf_counter() - t0
    t0 = time.perf_counter()
    base = rollup.BaseRollup.build(videos)
    run_all(base)
    shared = time.perf_counter() - t0
    timings = {}
    for label, pre in (("top10_one_pass_sec", False), ("top10_two_pass_sec", True)):
        topk.top_videos(videos, prefilter=pre).write.format("noop").mode("overwrite").save()
        t0 = time.perf_counter()
        topk.top_videos(videos, prefilter=pre).write.format("noop").mode("overwrite").save()
        timings[label] = round(time.perf_counter() - t0, 2)
    same = (topk.top_videos(videos, prefilter=False).collect()
            == topk.top_videos(videos, prefilter=True).collect())
    print({"rows": n, "outputs": len(outputs) + 1, "direct_sec": round(direct, 2),
           "shared_rollup_sec": round(shared, 2), "rollup_rows": base.df.count(),
           **timings, "top10_equal": same})
    spark.stop()


if __name__ == "__main__":
    main()
