"""Sharding by a Hilbert curve, with DataFrame functions alone.

Several metadata dimensions are quantised to a few bits each.  A row's place on
the Hilbert curve through that grid is its sort key, so rows that are close in
all dimensions come to lie close together, and the minima and maxima of the
files prune on each of the dimensions.  Runs of the sorted order are the shards.

Law ``rows``: shard s holds the ranks r with floor(r * shards / rows) = s, so
the shards' row counts are at most one apart.

Scale: the text is read once, for its size and checksum; everything after works
on narrow rows.  The order is a range partitioning whose key ends in the id and
the checksum, so that a hot source or many equal sizes still split.  A rank is
the row's number in its partition plus the rows of the partitions before: one
row per partition is all that meets in one task.

Edge cases: a null text is empty (size 16, checksum 0); null dimensions take a
cell of their own; repeated rows are dealt like any others; an empty table gives
no row; fewer rows than shards leave shards empty; other columns are ignored,
or kept where ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import fresh, materialise, parts_for, text_or_empty

BITS = 7
SHARDS = 40
OVERHEAD = 16
ROWS_PER_PART = 250_000


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state, by state * 2**dims + cell bits.

    A state is the curve's entry corner and its main axis.  Within a state the
    sub-cells are visited in the order of the Gray code, after the cell's bits
    were turned into the state's frame.
    """
    size = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (size - 1)

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    number_of = {gray(x): x for x in range(size)}

    def ones_below(x: int) -> int:
        return ((x ^ (x + 1)).bit_length() - 1) if x >= 0 else 0

    digits, after = [], []
    for corner in range(size):
        for axis in range(dims):
            for cell in range(size):
                w = number_of[turn(cell ^ corner, dims - (axis + 1) % dims)]
                enter = gray(2 * ((w - 1) // 2)) if w else 0
                along = 0 if w == 0 else ones_below(w if w % 2 else w - 1) % dims
                digits.append(w)
                after.append((corner ^ turn(enter, axis + 1)) * dims + (axis + along + 1) % dims)
    return digits, after


def hilbert_index(coords: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the curve of a cell whose coordinates lie in 0 .. 2**bits - 1."""
    dims = len(coords)
    digits, after = (F.array(*[F.lit(x) for x in t]) for t in curve_tables(dims))

    def step(acc: Column, level: Column) -> Column:
        cell = F.lit(0)
        for k, x in enumerate(coords):
            bit = F.call_function("shiftright", x.cast("int"), level).bitwiseAND(F.lit(1))
            cell = cell + bit * F.lit(1 << (dims - 1 - k))
        at = acc["state"] * F.lit(1 << dims) + cell + 1
        return F.struct(F.element_at(after, at).alias("state"),
                        (acc["place"] * F.lit(1 << dims) + F.element_at(digits, at)
                         .cast("long")).alias("place"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step,
                       lambda acc: acc["place"])


def category(x: Column, bits: int = BITS) -> Column:
    """A name's cell on its axis; null has cell 0."""
    cells = (1 << bits) - 1
    return F.when(x.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(x), F.lit(cells))).cast("int")


def magnitude(x: Column, bits: int = BITS) -> Column:
    """A size's cell: four to each doubling."""
    cell = F.floor(F.log2(F.greatest(x.cast("double"), F.lit(1.0))) * 4)
    return F.coalesce(F.least(cell, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def shard_rows(docs: DataFrame, shards: int = SHARDS, bits: int = BITS,
               dims: dict[str, str] | None = None, keep: Sequence[str] = (),
               rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """doc_id, size, text_crc32, place, rank, shard, slot of every row of ``docs``.

    ``dims`` maps columns to ``category`` or ``magnitude``; the size of the
    text is always the last dimension.  ``keep`` names further columns to carry.
    """
    spark = docs.sparkSession
    dims = {"source": "category", "lang": "category"} if dims is None else dims
    kinds = {"category": category, "magnitude": magnitude}
    text = text_or_empty()
    rows = docs.select(
        "doc_id", *keep,
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        *[kinds[kind](F.col(c), bits).alias(f"_dim{k}") for k, (c, kind) in enumerate(dims.items())])
    coords = [F.col(f"_dim{k}") for k in range(len(dims))]
    rows = rows.withColumn("_dim_size", magnitude(F.col("size"), bits))
    rows = rows.withColumn("place", hilbert_index([*coords, F.col("_dim_size")], bits))
    rows = materialise(spark, rows.drop("_dim_size", *[f"_dim{k}" for k in range(len(dims))]),
                       "shard-rows")
    n = rows.count()
    order = [F.col("place"), F.col("text_crc32"), F.col("doc_id")]
    rows = materialise(spark, rows.repartitionByRange(parts_for(n, rows_per_part), *order)
                       .withColumn("_part", F.spark_partition_id()), "shard-order")
    before = (rows.groupBy("_part").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
              .select("_part", "_before"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    ranked = (rows.withColumn("_number", number).join(before, "_part")
              .withColumn("rank", (F.col("_before") + F.col("_number")).cast("long")))
    total, cuts = F.lit(max(n, 1)).cast("long"), F.lit(shards).cast("long")
    shard = F.expr(f"(rank * {shards}L) div {max(n, 1)}L")
    return (ranked.withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.col("rank") - F.ceil(F.col("shard") * total / cuts).cast("long"))
            .drop("_part", "_before", "_number"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder per shard below ``path`` (``shard=0``, ...), each sorted along the curve, with
    all columns of ``docs``; where ``docs`` has a column ``shard``, folders are named ``shard_``."""
    row, folder = fresh(docs, "_row"), fresh(docs, "shard")
    # a table may have columns of its own by any name: they travel as one
    packed = docs.withColumn(row, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    sharded = shard_rows(packed, keep=[row], **options)
    sharded.repartitionByRange(F.col("shard"), F.col("rank")).sortWithinPartitions("shard", "rank") \
        .select(f"{row}.*", F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)


def op8(docs: DataFrame) -> DataFrame:
    return shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("place").alias("hilbert"))
