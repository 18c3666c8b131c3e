"""Load job: newest processed datasets -> typed warehouse tables.

Steps: create the tables if needed (Spark's catalog DDL), pick the newest
``channel_stats_*`` and ``videos_*`` datasets (anchored names, so the top list
is never taken for the videos), skip a missing or empty entity with a
warning, check the integrity rules of the batch (one job; ``fail`` or
``quarantine``), upsert by key with new ids for inserted rows, and replace the
partitions that the merge touched (one write per table).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.derive import as_of_literal, narrow_to_table_types, with_defaults
from ..operators import rollup, rules, topk
from ..operators.upsert import carried_columns, matched_keys, merge, merge_parts, prepared
from ..sources import parquet, snapshots, tables
from ..sources.tables import Partials, Table

log = logging.getLogger(__name__)


@dataclass
class Warehouse:
    channels: Table
    videos: Table
    video_rollup: Partials
    database: str

    def rollup(self) -> rollup.BaseRollup:
        """The videos' partial measures as they were stored by the loads: every grouped
        analytic can be derived from them without reading the videos."""
        return rollup.BaseRollup(self.video_rollup.read())


def warehouse(spark: SparkSession, root: str, video_buckets: int = 16, channel_buckets: int = 4,
              database: str | None = None) -> Warehouse:
    """Idempotent table creation (the DDL step): ``channel_stats`` and ``videos`` in
    ``database`` (by default one named after ``root``), with their files below ``root``.

    Channel snapshots are partitioned by the month of their capture, which is part of the
    key, so a daily load touches one partition.  Videos are partitioned by the month they
    were first loaded in, which no load changes.  Both are bucketed by their key; the bucket
    counts are fixed when the tables are created: size a bucket of a month to around a
    gigabyte (the defaults are for tests).  ``video_rollup`` keeps the videos' partial measures
    by date and hour for each of their partitions; a load renews those it touched."""
    database = database or tables.database_of(spark, root)
    make = lambda name, schema, keys, time, n: tables.create(
        spark, root, database, name, schema, keys, time, S.MONTHS[time], n,
        S.SOURCE_STAMP)
    channels = make("channel_stats", S.CHANNEL_TABLE, S.CHANNEL_KEYS, "captured_at", channel_buckets)
    videos = make("videos", S.VIDEO_TABLE, S.VIDEO_KEYS, "created_at", video_buckets)
    measures = rollup.partials(videos.read(), rollup.GRAIN).schema
    return Warehouse(channels, videos, tables.create_partials(
        spark, root, database, "video_rollup", measures, videos.month), database)


def renew_rollup(wh: Warehouse, months: list) -> None:
    """Partial measures of the named partitions of the videos, from their rows as they are
    now (so a maximum that a load has lowered is right, too); others stay.  All partitions:
    ``renew_rollup(wh, months=...)`` with every month, to mend what a killed load left."""
    rows = wh.videos.of_months(months)
    wh.video_rollup.overwrite(rollup.partials(rows, [wh.videos.month, *rollup.GRAIN]))


@dataclass
class LoadResult:
    merged: dict[str, int] = field(default_factory=dict)  # rows merged, by table
    quarantined: dict[str, DataFrame] = field(default_factory=dict)
    summary: dict | None = None


def _narrowed(df: DataFrame, schema) -> DataFrame:
    """Table columns at the table's types; only for rows that passed the rules."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def _months(table: Table, df: DataFrame, time=None) -> list:
    """Months of a narrow frame: at most one row per partition of the table."""
    return [r[0] for r in df.select(table.month_of(time)).distinct().collect()]


def merge_into(table: Table, batch: DataFrame, update: list[str], as_of,
               on_duplicate: str = "error", order_by: str | None = None,
               months: list | None = None, **stamps) -> tuple[int, list]:
    """Upsert ``batch`` and replace the partitions it touches; others are neither read nor
    written.  Returns the rows merged and the partitions touched.

    Where a row's key tells its month, a batch of several months is a backfill: a join by
    bucket would have as many tasks as buckets, each with files in every month, so the merged
    rows are dealt by month and bucket before they are written.  A batch of one month, and a
    table whose rows keep the month they first came in, are written as they are joined.

    The keys of the batch that the table has are found first, on the key columns alone, with
    the partitions they lie in (``months`` where the batch's own keys tell them).  The merge
    then reads those partitions, bucket by bucket, and the one that takes the inserted rows.
    Rows that are too many for a task per bucket meet in several parts of each bucket, which
    are files of their own.

    A batch with the table's stamp column leaves a stored row of a later stamp as it is."""
    keys, stored = list(table.keys), table.stored()
    whole = stored.select(*table.columns)
    stamped = table.stamp if table.stamp in batch.columns else None
    b = prepared(batch, keys, carried_columns(whole, batch, stamps.get("created"),
                                              stamps.get("updated"), table.id_col),
                 on_duplicate, order_by)
    if b.stats.rows == 0:
        return 0, []
    given = len(whole.columns) - len(b.rows.columns)  # stamps and ids

    def parts(rows: DataFrame, width: float) -> int:
        return merge_parts(table.spark, table.buckets, b.stats.rows + rows.count(), width)

    def matched_in(rows: DataFrame, also: list[str], in_place: bool = True) -> DataFrame:
        if b.small or not in_place:
            return matched_keys(rows, b, keys, also)
        return matched_keys(rows, b, keys, also, table.buckets,
                            parts(rows, b.stats.key_bytes / b.stats.rows + 8 * len(also)))
    if table.by_key():
        touched = months if months is not None else _months(table, b.rows)
        backfill = len(touched) > 1
        matched = matched_in(table.of_months(touched), [], not backfill)
    else:
        backfill = False
        matched = matched_in(stored, [table.month])
        touched = [r[0] for r in matched.select(table.month).distinct().collect()]
        if matched.count() < b.stats.rows:  # inserted rows take the run's month
            touched = list({*touched, *_months(table, table.spark.range(1), as_of)})
    target = table.of_months(touched).select(*table.columns)
    last = stored.agg(F.max(table.id_col)).first()[0] or 0
    update = [*update, stamped] if stamped else update
    merged = merge(target, b, keys, update, as_of, newer_by=stamped, id_col=table.id_col, id_start=last,
                   matched=matched, buckets=None if backfill else table.buckets,
                   parts=None if backfill else parts(target, b.stats.bytes / b.stats.rows + 8 * given),
                   **stamps)
    table.overwrite(table.dealt(merged) if backfill else merged)
    return b.stats.rows, touched


def _check(table: Table, batch: DataFrame, rule_list, mode: str, name: str, on_duplicate: str,
           result: LoadResult) -> tuple[DataFrame, rules.Profile]:
    """The batch to merge and its profile.  One job gives the row count, the violations per
    rule and the months of a key that tells them; ``fail`` raises on any violation, ``quarantine`` sets the breaking rows aside,
    and of the rest those whose key is repeated (unless ``on_duplicate`` picks one)."""
    rs = rules.applicable(batch, rule_list)
    if mode == "quarantine":
        batch, bad = rules.quarantine(batch, rs)
        if on_duplicate == "error":
            batch, repeated = rules.set_aside_repeats(batch, list(table.keys))
            bad = bad.unionByName(repeated)
        result.quarantined[name] = bad
        rs = []
    elif mode != "fail":
        raise ValueError("mode must be 'fail' or 'quarantine'")
    prof = rules.profile(batch, rs, table.month_of() if table.by_key() else None)
    if any(prof.counts.values()):
        raise rules.RuleViolation(prof.counts)
    return batch, prof


def load_channels(wh: Warehouse, batch: DataFrame, as_of, mode="fail",
                  on_duplicate="error", order_by=None, result=None) -> int | None:
    result = result if result is not None else LoadResult()
    b, prof = _check(wh.channels, batch, rules.channel_rules(), mode, "channel_stats",
                     on_duplicate, result)
    if prof.rows == 0:
        log.warning("channel snapshots: the batch is empty, nothing to merge")
        return None
    # key repeats are detected by the upsert, in the same job as its size check
    n, _ = merge_into(wh.channels, _narrowed(b, S.CHANNEL_TABLE), S.CHANNEL_UPDATE, as_of,
                      on_duplicate, order_by, prof.parts, created="created_at",
                      refresh_created=True)
    result.merged["channel_stats"] = n
    return n


def load_videos(wh: Warehouse, batch: DataFrame, as_of, loader: str = "full", mode="fail",
                on_duplicate="error", order_by=None, result=None) -> int | None:
    """``loader="full"``: every column from the batch but publish_time and
    created_at; ``"narrow"`` (the deployed loader): title and views only.

    The rules see the batch's own wide values, so a rate that DECIMAL(10,6)
    can't hold or a counter over 32 bits is reported as such, and quarantined
    rows keep them; good rows are narrowed to the table's types afterwards."""
    result = result if result is not None else LoadResult()
    update = S.VIDEO_UPDATE_FULL if loader == "full" else S.VIDEO_UPDATE_NARROW
    b = with_defaults(batch, S.VIDEO_DEFAULTS)
    b, prof = _check(wh.videos, b, rules.video_rules(), mode, "videos", on_duplicate, result)
    if prof.rows == 0:
        log.warning("videos: the batch is empty, nothing to merge")
        return None
    n, months = merge_into(
        wh.videos, _narrowed(narrow_to_table_types(b), S.VIDEO_TABLE), update, as_of,
        on_duplicate, order_by, created="created_at", updated="updated_at")
    renew_rollup(wh, months)
    result.merged["videos"] = n
    return n


def summary(wh: Warehouse) -> dict:
    """Newest channel snapshot and the video summary (one job each)."""
    ch = topk.latest_snapshot(wh.channels.read()).collect()
    v = rollup.video_summary(wh.videos.read()).first()
    return {"channel": ch[0].asDict() if ch else None, "videos": v.asDict() if v else None}


def load(spark: SparkSession, processed_dir: str, warehouse_dir: str, as_of=None,
         loader: str = "full", policy: str = "name", mode: str = "fail",
         video_buckets: int = 16, on_duplicate: str = "error",
         order_by: str | None = None, database: str | None = None) -> LoadResult:
    """``video_buckets`` applies only when the videos table is created.
    ``on_duplicate="last"`` keeps, of rows with the same key, the one with the
    greatest ``order_by`` (by default the entity's first counter) instead of failing."""
    wh = warehouse(spark, warehouse_dir, video_buckets, database=database)
    now = as_of_literal(as_of)
    ch_path = snapshots.latest_dataset(spark, processed_dir, "channel_stats", policy)
    v_path = snapshots.latest_dataset(spark, processed_dir, "videos", policy)
    result = LoadResult()
    if not ch_path and not v_path:
        log.error("neither entity has a processed dataset in %s", processed_dir)
        return result
    ch, v = parquet.read_processed(spark, ch_path, v_path)
    if ch is not None:
        load_channels(wh, ch, now, mode, on_duplicate, order_by or "subscribers", result)
    if v is not None:
        load_videos(wh, v, now, loader, mode, on_duplicate, order_by or "views", result)
    result.summary = summary(wh)
    return result


def register_views(wh: Warehouse) -> dict[str, DataFrame]:
    """Temp views over the tables: the two tables and the four table views (top 100, daily
    performance, hourly heatmap, monthly trends).  Views are plans, not copies."""
    channels, videos = wh.channels.read(), wh.videos.read()
    views = {
        "channel_stats": channels,
        "videos": videos,
        "top_videos": topk.top_videos_view(videos),
        "daily_performance": rollup.daily_performance(videos),
        "hourly_heatmap": rollup.hourly_heatmap(videos),
        "monthly_trends": rollup.monthly_trends_view(videos),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
