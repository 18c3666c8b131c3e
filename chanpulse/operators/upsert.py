"""Keyed upsert of a batch into a table frame, and surrogate ids.

Semantics (one statement ``INSERT ... ON CONFLICT (keys) DO UPDATE``):

* a target row whose key is in the batch takes ``update`` columns from the
  batch, keeps the others; ``created_at`` is kept or refreshed
  (``refresh_created``); ``updated_at`` becomes ``as_of`` (the update trigger);
* a batch row whose key is not in the target is inserted: columns it lacks
  take defaults, the stamps take ``as_of``, the id column a new id;
* a target row not in the batch is unchanged.

Plan: the batch is written once to the shared checkpoint folder and measured
there (rows, key repeats and exact byte size in one aggregate).  When its size
is under the broadcast bound the batch is broadcast: the target is joined
map-side (no shuffle of the target), and the keys it matched (at most the
batch's size) are broadcast again to find the inserts with an anti join.  Above
the bound one full outer join merges both sides, each hash-partitioned on the
keys once.  Into a table that is bucketed by the keys (``buckets``) only the batch
moves: it is dealt into as many partitions as the table has buckets, and the
table's side of the join is its buckets as they lie.  Where that would be more than
``TASK_BYTES`` for a task, both sides are dealt into a multiple of the buckets
(``merge_parts``): a task's share stays bounded however much the table has outgrown its
buckets, and still holds rows of one bucket alone.  Keys are unique on both sides
after the duplicate rule, so no key can skew the join.

Ids are given before the merge: the batch's keys that the target lacks (a join of the
key columns alone) are numbered, and the numbers go along with the batch.  The merged
rows are written by whoever asked for them, and nowhere before.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root, materialise

_HIT, _THERE = "_s_hit", "_t_there"
TASK_BYTES = 128 << 20  # rows of both sides that a task of a bucketed merge takes, about


class DuplicateKeyError(ValueError):
    """The batch holds a key more than once (ON CONFLICT cannot touch a row twice)."""


def _p(c: str) -> str:
    return f"_s_{c}"


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregate
    per task before the shuffle, so a hot key costs one row per task)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def keep_last(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` (ties broken by
    the remaining columns).

    One pass: a rank whose limit Spark applies within each task before the shuffle
    (WindowGroupLimit), so a key repeated in a third of all rows costs one row per
    task.  Keys and ``order_by`` may be NULL (a NULL ``order_by`` is the smallest)."""
    rest = [c for c in df.columns if c not in keys and c != order_by]
    order = [F.col(c).desc_nulls_last() for c in [order_by, *(rest or keys)]]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    place = "_place"
    while place in df.columns:
        place += "_"
    return df.withColumn(place, first).filter(F.col(place) == 1).drop(place)


@dataclass(frozen=True)
class BatchStats:
    rows: int
    max_repeat: int
    bytes: int
    key_bytes: int = 0


def _width(dt: T.DataType) -> int:
    if isinstance(dt, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, T.DecimalType):
        return 16
    return 8


def batch_stats(df: DataFrame, keys: list[str]) -> BatchStats:
    """Rows, largest key repeat and exact size in bytes (all columns, keys), in one job."""
    def size(columns: list[str]) -> Column:
        total = F.lit(0).cast("long")
        for f in df.select(*columns).schema.fields:
            if isinstance(f.dataType, (T.StringType, T.BinaryType)):
                total = total + F.coalesce(F.octet_length(f.name), F.lit(0)) + F.lit(8)
            else:
                total = total + F.lit(_width(f.dataType))
        return total
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(size(df.columns)).alias("b"))
    r = per_key.agg(F.sum("n").alias("rows"), F.max("n").alias("rep"), F.sum("b").alias("bytes"),
                    F.sum(F.col("n") * size(keys)).alias("keys")).first()
    return BatchStats(*[int(r[c] or 0) for c in ("rows", "rep", "bytes", "keys")])


def merge_parts(spark, buckets: int, rows: int, width: float) -> int:
    """Partitions in which ``rows`` of both sides (of ``width`` bytes) meet in a table of
    ``buckets``: as many, or a multiple that keeps a task to ``TASK_BYTES``.  A partition of
    a multiple holds rows of one bucket, since both are remainders of the keys' hash.  It is
    no less than ``spark.sql.shuffle.partitions``, to which Spark would raise a join whose
    sides are both dealt, whether that is a multiple or not."""
    need = math.ceil(rows * width / TASK_BYTES)
    if need <= buckets:
        return buckets
    return buckets * math.ceil(max(need, int(spark.conf.get("spark.sql.shuffle.partitions"))) / buckets)


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (-1 disables)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    for u in sorted(units, key=len, reverse=True):
        if raw.endswith(u):
            return int(float(raw[: -len(u)]) * units[u])
    return int(raw)


@dataclass(frozen=True)
class Batch:
    """A batch with one row per key, written once, and its measures."""
    rows: DataFrame
    stats: BatchStats
    small: bool  # under the session's broadcast bound


def prepared(source: DataFrame, keys: list[str], columns: list[str], on_duplicate: str = "error",
             order_by: str | None = None) -> Batch:
    """``columns`` of the batch after the duplicate rule (``error``, or ``last`` by
    ``order_by``)."""
    missing = [k for k in keys if k not in columns]
    if missing:
        raise ValueError(f"source lacks key columns {missing}")
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        source = keep_last(source.select(*dict.fromkeys([*columns, order_by])), keys, order_by)
    elif on_duplicate != "error":
        raise ValueError("on_duplicate must be 'error' or 'last'")
    # the batch feeds the size check, the search for its keys and the merge
    rows = materialise(source.select(*columns), "batch")
    stats = batch_stats(rows, keys)
    if stats.max_repeat > 1:
        raise DuplicateKeyError(f"batch holds a key {stats.max_repeat} times")
    limit = broadcast_limit(rows.sparkSession)
    return Batch(rows, stats, limit > 0 and stats.bytes <= limit)


def matched_keys(target: DataFrame, batch: Batch, keys: list[str], also: list[str] | None = None,
                 buckets: int | None = None, parts: int | None = None) -> DataFrame:
    """The keys of ``batch`` that ``target`` has (and ``also`` columns of those rows): a join
    of narrow columns, at most a row per row of the batch.  Written once.  ``buckets`` and
    ``parts`` as in :func:`merge`."""
    there, mine = target.select(*keys, *(also or [])), batch.rows.select(*keys)
    if batch.small:
        found = there.join(F.broadcast(mine), keys, "left_semi")
    else:
        if buckets:
            parts = parts or buckets
            mine = mine.repartition(parts, *keys)
            there = there if parts == buckets else there.repartition(parts, *keys)
        found = there.join(mine.hint("merge"), keys, "left_semi")
    return materialise(found, "matched")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str],
           as_of: Column, *, created: str | None = "created_at", refresh_created: bool = False,
           updated: str | None = None, id_col: str | None = None,
           on_duplicate: str = "error", order_by: str | None = None,
           strategy: str = "auto", id_start: int | None = None,
           info: dict | None = None, defaults: dict | None = None) -> DataFrame:
    """Merge ``source`` into ``target`` by ``keys``; returns the new table
    frame with ``target``'s columns.  ``strategy``: ``auto`` (size check) or
    ``shuffle``.  ``defaults``: values that inserted rows take for columns the
    source lacks.  ``on_duplicate``: ``error`` or ``last``
    (needs ``order_by``).  ``id_start``: the table's largest id when
    ``target`` holds only part of the table (else it is computed).  ``info``
    (optional dict) receives ``rows``, ``bytes``, ``broadcast`` and, with ids,
    ``max_id``: the largest id after the merge."""
    if strategy not in ("auto", "shuffle"):
        raise ValueError("strategy must be 'auto' or 'shuffle'")
    batch = prepared(source, keys, carried_columns(target, source, created, updated, id_col),
                     on_duplicate, order_by)
    if strategy == "shuffle":
        batch = Batch(batch.rows, batch.stats, False)
    return merge(target, batch, keys, update, as_of, created=created,
                 refresh_created=refresh_created, updated=updated, id_col=id_col,
                 id_start=id_start, info=info, defaults=defaults)


def carried_columns(target: DataFrame, source: DataFrame, created: str | None,
                    updated: str | None, id_col: str | None) -> list[str]:
    """The target's columns that the batch brings; stamps and ids are given here."""
    return [c for c in target.columns if c in source.columns and c not in (created, updated, id_col)]


def merge(target: DataFrame, batch: Batch, keys: list[str], update: list[str], as_of: Column, *,
          created: str | None = "created_at", refresh_created: bool = False,
          updated: str | None = None, id_col: str | None = None, id_start: int | None = None,
          info: dict | None = None, defaults: dict | None = None,
          matched: DataFrame | None = None, buckets: int | None = None,
          newer_by: str | None = None, parts: int | None = None) -> DataFrame:
    """:func:`upsert` of a prepared batch.  ``matched``: the batch's keys in the table, if
    they are known.  ``buckets``: ``target`` is bucketed by ``keys`` into so many, and isn't
    moved, unless ``parts`` is a multiple of them that both sides are dealt into.  ``newer_by``: a column of both; a target row whose value is greater than the
    batch's stays unchanged (either may be NULL: then the batch wins)."""
    src, tcols = batch.rows, target.columns
    carried = src.columns
    info = info if info is not None else {}
    info.update(rows=batch.stats.rows, bytes=batch.stats.bytes)
    if batch.stats.rows == 0:
        info.update(broadcast=False, max_id=id_start)
        return target
    use_bc = batch.small and not buckets
    info["broadcast"] = use_bc

    non_key = [c for c in carried if c not in keys]
    types = {f.name: f.dataType for f in target.schema.fields}
    defaults = defaults or {}
    hit, there = F.col(_HIT).isNotNull(), F.col(_THERE).isNotNull()
    if newer_by:
        hit = hit & ~F.coalesce(F.col(newer_by) > F.col(_p(newer_by)), F.lit(False))

    def existing_col(c: str) -> Column:
        if c in update and c in non_key:
            return F.when(hit, F.col(_p(c)).cast(types[c])).otherwise(F.col(c))
        if c == updated or (c == created and refresh_created):
            return F.when(hit, as_of.cast(types[c])).otherwise(F.col(c))
        return F.col(c)

    def insert_col(c: str) -> Column:
        if c in carried or c == id_col:
            return F.col(_p(c)).cast(types[c])
        if c in (created, updated):
            return as_of.cast(types[c])
        return F.lit(defaults.get(c)).cast(types[c])

    numbered = None
    if id_col:
        if matched is None:
            matched = matched_keys(target, batch, keys, buckets=buckets, parts=parts)
        if id_start is None:
            id_start = target.agg(F.max(id_col)).first()[0] or 0
        fresh = src.select(*keys).join(matched.select(*keys), keys, "left_anti")
        numbered = assign_ids(fresh, id_col, int(id_start), info)

    s = src.select(*[F.col(c).alias(_p(c)) for c in carried], F.lit(True).alias(_HIT))
    t = target.withColumn(_THERE, F.lit(True))
    on = [F.col(k) == F.col(_p(k)) for k in keys]
    if use_bc:
        existing = t.join(F.broadcast(s), on, "left").select(
            *[existing_col(c).alias(c) for c in tcols])
        if numbered is not None:
            new = src.join(numbered, keys)
        else:
            found = target.select(*keys).join(F.broadcast(src.select(*keys)), keys, "left_semi")
            new = src.join(F.broadcast(found), keys, "left_anti")
        new = new.select(*[F.col(c).alias(_p(c)) for c in new.columns])
        return existing.unionByName(new.select(*[insert_col(c).alias(c) for c in tcols]))
    # one full outer join; the hint keeps Catalyst from guessing a broadcast
    by = [_p(k) for k in keys]
    split = bool(buckets) and (parts or buckets) != buckets
    if split:  # ids are joined where the batch's rows meet the table's
        s, t = s.repartition(parts, *by), t.repartition(parts, *keys)
    if numbered is not None:
        numbered = numbered.select(*[F.col(c).alias(_p(c)) for c in numbered.columns])
        s = s.join(numbered.repartition(parts, *by) if split else numbered, by, "left")
    if buckets and not split:
        s = s.repartition(buckets, *by)
    both = t.join(s.hint("merge"), on, "full_outer")
    return both.select(*[F.when(there, existing_col(c)).otherwise(insert_col(c)).alias(c)
                         for c in tcols])


def assign_ids(df: DataFrame, id_col: str = "id", start: int = 0,
               info: dict | None = None) -> DataFrame:
    """Dense ids ``start+1 .. start+n`` without a global window.

    The frame is checkpointed to the shared checkpoint folder (reliable, cuts
    lineage, fixes partition contents); per-partition row counts (one row per
    partition) give each partition its offset; every row adds its position
    inside the partition.  Ids are not ordered by any column (SERIAL-like)."""
    spark = df.sparkSession
    checkpoint_root(spark)
    ck = df.checkpoint(eager=True)
    counts = (ck.groupBy(F.spark_partition_id().alias("_pid"))
              .agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, run = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((int(r["_pid"]), run))
        run += int(r["_n"])
    if info is not None:
        info["max_id"] = start + run
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    tagged = ck.withColumns({"_pid": F.spark_partition_id(),
                             "_mid": F.monotonically_increasing_id()})
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(off), "_pid")
            .withColumn(id_col, F.lit(start) + F.col("_off") + pos + F.lit(1))
            .drop("_pid", "_mid", "_off"))
