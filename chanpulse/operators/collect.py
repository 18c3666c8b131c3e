"""Collecting videos from search pages: id lookup and the page-granular cap.

The ingest loop walks search pages in order, looks every id up, keeps the
found ones, and stops after the page on which the running count of found
videos reaches the cap.  On landed pages that is: join ids to details, count
found videos per page, and keep the pages whose *preceding* running count is
below the cap.  Counting needs the ids alone; which page is kept is settled before
any reply is looked at, so only the kept pages' ids meet their details.

The running count is a prefix sum over pages.  An unpartitioned window would
put every page into one task, so the sum is taken in two levels: pages are cut
into blocks of ``block`` consecutive page numbers; a window partitioned by
block gives the running sum inside each block (bounded task size), a window
over the per-block totals gives each block's offset (one row per block), and
the two are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PAGE_SIZE
from ..session import materialise
from .upsert import keep_last

DEFAULT_BLOCK = 1 << 16
# Hot ids: an id listed on more than HOT_ROWS rows (estimated from a
# HOT_SAMPLE share of the rows) is joined through a broadcast of its details.
# At most MAX_HOT ids are taken that way, so the broadcast holds at most
# MAX_HOT detail rows (one reply per id is left before the join).
HOT_SAMPLE = 0.01
HOT_ROWS = 1_000_000
MAX_HOT = 1000
# The kept pages of a capped collection number at most ``cap`` (every kept page
# holds a found video and starts below the cap); broadcast them up to this cap.
BROADCAST_PAGES = 1_000_000


def hot_keys(df: DataFrame, key: str, sample: float = HOT_SAMPLE, hot_rows: int = HOT_ROWS,
             max_hot: int = MAX_HOT, seed: int = 17) -> list:
    """Ids estimated to hold more than ``hot_rows`` rows, most frequent first,
    at most ``max_hot``.  Found on a Bernoulli sample of the key column (one
    partial + final aggregate, at most ``max_hot`` rows reach the driver).  The
    list only chooses a plan: a hot id that the sample misses still joins
    exactly, through the shuffle."""
    n = F.count(F.lit(1))
    counts = (df.select(key).sample(fraction=sample, seed=seed)
              .filter(F.col(key).isNotNull()).groupBy(key).agg(n.alias("_n")))
    rows = (counts.filter(F.col("_n") > F.lit(hot_rows * sample))
            .orderBy(F.desc("_n"), key).limit(max_hot).collect())
    return [r[key] for r in rows]


def one_reply(details: DataFrame, key: str = "video_id", newest: str = "landed_at") -> DataFrame:
    """The newest of an id's replies (of equal ones, or without ``newest``, the one
    with the greatest values); ``newest`` is not kept."""
    rest = [c for c in details.columns if c != key]
    if not rest:
        return details.distinct()
    order = newest if newest in rest else rest[0]
    out = keep_last(details, [key], order)
    return out.drop(newest) if newest in details.columns else out


def lookup_details(ids: DataFrame, details: DataFrame, key: str = "video_id",
                   hot: list | None = None, newest: str = "landed_at", **hot_args) -> DataFrame:
    """Each listed id with its details: one row per listing.  Ids without
    details are dropped, repeated ids stay repeated (inner equi-join).

    An id may have been looked up more than once; the newest reply (greatest
    ``newest``, ties by the other columns) counts, so details have one row per
    id before the join.  Hot ids are split off first: their rows join a
    broadcast of their detail rows, at most ``MAX_HOT`` of them, inside each
    map task.  The other ids take the ordinary shuffle join, where adaptive
    execution splits what is still uneven.  ``hot`` may be given; else it is
    found by :func:`hot_keys`."""
    details = one_reply(details, key, newest)
    if hot is None:
        hot = hot_keys(ids, key, **hot_args)
    if not hot:
        return ids.join(details, key, "inner")
    in_hot = F.col(key).isin(hot)
    hot_part = ids.filter(in_hot).join(F.broadcast(details.filter(in_hot)), key, "inner")
    cold_part = ids.filter(~in_hot).join(details.filter(~in_hot), key, "inner")
    return hot_part.unionByName(cold_part)


def running_before(counts: DataFrame, order: str, value: str,
                   block: int = DEFAULT_BLOCK, materialize: bool = True) -> DataFrame:
    """Add ``before`` = sum of ``value`` over all rows with a smaller ``order``
    (``order`` unique, integral).

    One window partitioned by block gives both the running sum inside the
    block and the block's total.  The block offsets (one row per block) and
    the join back both read the counts; column pruning makes the two reads
    differ, so Spark would compute everything behind ``counts`` twice.  With
    ``materialize`` the counts are written to the shared checkpoint folder
    first, and the work behind them runs once."""
    if materialize:
        counts = materialise(counts, "counts")
    c = counts.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    in_block = Window.partitionBy("_block")
    w = c.withColumns({
        "_run": F.sum(value).over(in_block.orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)),
        "_btotal": F.sum(value).over(in_block)})
    # one row per block: the window below is over #pages / block rows
    totals = w.groupBy("_block").agg(F.max("_btotal").alias("_total"))
    offsets = totals.withColumn(
        "_offset",
        F.coalesce(F.sum("_total").over(Window.orderBy("_block").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return (w.join(offsets.select("_block", "_offset"), "_block")
            .withColumn("before", F.col("_offset") + F.col("_run") - F.col(value))
            .drop("_block", "_run", "_btotal", "_offset"))


def kept_pages(found: DataFrame, cap: int, page: str = "page",
               block: int = DEFAULT_BLOCK) -> DataFrame:
    """Pages (of listings that were found) read before the cap was reached."""
    per_page = found.groupBy(page).agg(F.count(F.lit(1)).alias("_found"))
    kept = running_before(per_page, page, "_found", block).filter(F.col("before") < cap)
    kept = kept.select(page)
    # at most ``cap`` rows, see BROADCAST_PAGES
    return F.broadcast(kept) if cap <= BROADCAST_PAGES else kept


def capped_collection(found: DataFrame, cap: int, page: str = "page",
                      block: int = DEFAULT_BLOCK) -> DataFrame:
    """Found videos of the pages read before the cap was reached.  The last
    page read is kept whole, so the result may exceed ``cap`` by up to one
    page, as the loop does."""
    return found.join(kept_pages(found, cap, page, block), page, "left_semi")


def first_pages(search_items: DataFrame, details: DataFrame, cap: int, key: str = "video_id",
                page: str = "page") -> int | None:
    """A page below which at least ``cap`` videos are found (None: all pages).

    Only the pages before the cap matter, so found ids are counted on a range of
    first pages that doubles until it holds enough; the range is a filter on
    ``page`` that reaches the scan."""
    ends = search_items.agg(F.min(page).alias("lo"), F.max(page).alias("hi")).first()
    if ends["lo"] is None:
        return None
    known = details.select(key)
    lo, width = int(ends["lo"]), max(1, -(-cap // PAGE_SIZE))
    while lo + width <= int(ends["hi"]):
        some = search_items.filter(F.col(page) < lo + width).select(key)
        if some.join(known, key, "left_semi").count() >= cap:
            return lo + width
        width *= 2
    return None


def collect_videos(search_items: DataFrame, details: DataFrame, key: str = "video_id",
                   page: str = "page", cap: int | None = None, newest: str = "landed_at",
                   **hot_args) -> DataFrame:
    """Search items (page, video_id) -> details of the collected videos: of all pages,
    or of those read until ``cap`` videos were found.  With a cap, replies of other ids are
    dropped by a semi-join before the newest one of an id is sought."""
    if cap is None:
        return lookup_details(search_items, details, key, newest=newest, **hot_args)
    stop = first_pages(search_items, details, cap, key, page)
    if stop is not None:
        search_items = search_items.filter(F.col(page) < stop)
    found = search_items.join(details.select(key), key, "left_semi")
    kept = materialise(found.join(kept_pages(found, cap, page), page, "left_semi"), "kept-items")
    wanted = kept.select(key).distinct()
    # one listing a row, and all but the last page's count towards the cap
    wanted = F.broadcast(wanted) if cap <= BROADCAST_PAGES and kept.count() <= BROADCAST_PAGES \
        else wanted
    return lookup_details(kept, details.join(wanted, key, "left_semi"), key, newest=newest,
                          **hot_args)
