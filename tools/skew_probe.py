"""Details lookup with one id listed on about a third of all rows: the plain
shuffle join (sort-merge, AQE skew splitting on) against the hot-id split
(hot ids joined through a bounded broadcast, the rest through the shuffle).

Ids come from lineitem replicated ``k`` times in Spark; a row is given the
hot id when a hash of its key falls in one third.  Details hold one row per
id, and automatic broadcasting is off, as it would be for tables far above
any broadcast threshold.

    python tools/skew_probe.py /root/testdata/sf0.1 16
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
    from chanpulse.operators import collect
    from chanpulse.plans import proxies
    from chanpulse.session import build_session, scratch_path
    spark = build_session("local[8]", shuffle_partitions=64, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"})
    spark.sparkContext.setLogLevel("ERROR")
    li = proxies.table(spark, sf_dir, "lineitem")
    rep = li.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "_copy"), F.lit(3)) == 0
    root = scratch_path(spark, "skew_probe")
    # a written base fixes one unique id per row (ids start at 1; 0 is the hot id)
    (rep.select((F.monotonically_increasing_id() + 1).alias("uid"), hot.alias("hot"),
                F.col("l_extendedprice").alias("views"))
        .write.parquet(f"{root}/base"))
    base = spark.read.parquet(f"{root}/base")
    ids = base.select(F.when(F.col("hot"), F.lit(0)).otherwise(F.col("uid")).alias("video_id"),
                      F.floor(F.col("uid") / 50).alias("page"))
    details = (base.select(F.col("uid").alias("video_id"), "views")
               .unionByName(base.limit(1).select(F.lit(0).cast("long").alias("video_id"),
                                                 "views")))
    n = ids.count()

    def timed(fn):
        fn().write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 2)

    plain = timed(lambda: collect.lookup_details(ids, details, hot=[]))
    t0 = time.perf_counter()
    found = collect.hot_keys(ids, "video_id", hot_rows=n // 100)
    detect = round(time.perf_counter() - t0, 2)
    split = timed(lambda: collect.lookup_details(ids, details, hot=found))
    rows_split = collect.lookup_details(ids, details, hot=found).count()
    rows_plain = collect.lookup_details(ids, details, hot=[]).count()
    print({"rows": n, "hot_ids": found, "plain_shuffle_sec": plain,
           "hot_detect_sec": detect, "hot_split_sec": split,
           "rows_out_split": rows_split, "rows_out_plain": rows_plain})
    spark.stop()


if __name__ == "__main__":
    main()
