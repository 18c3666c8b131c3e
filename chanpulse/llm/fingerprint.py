"""Document fingerprints: bottom-k sketches, with DataFrame functions alone.

A document's shingles are its runs of five words (the whole sequence, if it has
fewer; none without words).  The sketch is the k smallest distinct 64-bit hashes
of the shingles, ascending.  Sketches of parts merge: the k smallest of their
union are the sketch of the whole.  From sketches alone come the resemblance of
two documents, the share of one that another contains, and the number of
distinct shingles; while a document has fewer than k shingles, all are exact.

``with_edited`` pairs every document with its edited text and the next document
by ascending id; rows of equal ids follow each other in the order of their texts (of the
first PREFIX characters, then of a hash).  The order is cut into blocks of about
ROWS_PER_BLOCK rows by rank: a sample by hash of these keys alone gives the keys at which blocks begin, whatever gaps
the ids leave.  A block gets a copy of the first document of the block after it (the last
one's is the first block's), so that ``lead`` within a block sees the next document and no
window holds more than a block.  The text is shuffled once, into as many partitions as
its bytes ask for.  The first keys of at most MOST_BLOCKS blocks are the only thing that
every task holds: a few MB, whatever the input.

Rows that are the same in id and text stand for each other.  Where one is repeated more
often than a block has rows, a single one of its copies goes into its block, and the others,
whose next document is a copy of their own, are made from it afterwards.

Edge cases: a null text is empty; two documents without words resemble each
other fully, one without words resembles none that has some; null ids come
first; repeated ids follow each other in the order of their texts (see above); a single
document is its own next; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import GAP, materialise, parts_for, text_or_empty

K = 128
SHINGLE = 5
ROWS_PER_BLOCK = 1_000
MOST_BLOCKS = 100_000
#: Characters of a text that decide among equal ids.
PREFIX = 64
#: Sampled keys from which a block's first is taken, and text bytes of a partition.
PER_CUT, PART_BYTES = 16, 32 << 20


def add_sketch(df: DataFrame, text: str, out: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``out``: the bottom-k sketch (array of long) of column ``text``."""
    hashes, n = F.col(f"{out}_words"), F.size(f"{out}_words")

    def run(i: Column) -> Column:
        return F.xxhash64(*[hashes[i + d] for d in range(shingle)])

    shingles = F.when(n >= shingle, F.transform(F.sequence(F.lit(0), n - shingle), run)) \
        .when(n > 0, F.array(F.xxhash64(hashes))) \
        .otherwise(F.array().cast("array<bigint>"))
    split = F.array_remove(F.split(F.col(text), GAP), "")
    return (df.withColumn(f"{out}_words", F.transform(split, lambda w: F.xxhash64(w)))
            .withColumn(out, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k))
            .drop(f"{out}_words"))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """One merged sketch per group: at most k hashes of a group leave a task."""
    low = Window.partitionBy(*by).orderBy("_hash")
    some = df.select(*by, F.explode(sketch).alias("_hash")).distinct()
    return (some.withColumn("_place", F.row_number().over(low)).filter(F.col("_place") <= k)
            .groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias(sketch)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the k smallest hashes of the union that both sketches hold."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Distinct shingles: counted below k, else estimated from the k-th hash."""
    reach = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, too."""
    alike, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), alike * (na + nb) / (1 + alike) / na))


def as_text(a: Column) -> Column:
    """The sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def block_starts(keys: DataFrame, rows: int, blocks: int) -> Column:
    """The ascending keys at which blocks of ``keys`` (key) begin, as an array.

    Every so many-th of the keys that a hash picks; the hash sees the key alone, so that any
    pass over the same rows gives the same blocks.  At most about MOST_BLOCKS keys reach the
    driver."""
    one_in = max(1, rows // (blocks * PER_CUT))
    picked = keys.filter(F.pmod(F.xxhash64(F.lit("cut"), "key"), F.lit(one_in)) == 0).distinct()
    # at most about PER_CUT * MOST_BLOCKS narrow rows
    nth = F.row_number().over(Window.orderBy("key"))
    cuts = picked.withColumn("nth", nth).filter(F.col("nth") % PER_CUT == 0).select("key")
    least = keys.agg(F.min("key").alias("key"))
    found = cuts.union(least).distinct().agg(F.sort_array(F.collect_list("key")).alias("starts")) \
        .select(F.to_json("starts").alias("starts"), F.typeof("starts").alias("kind")).first()
    return F.from_json(F.lit(found["starts"]), found["kind"])  # folded to a constant


def block_of(key: Column, starts: Column) -> Column:
    """The last of ``starts`` (the first of them is the least key) that isn't beyond ``key``:
    a binary search."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(starts) + 1)).cast("int"))

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"] + 1) / 2).cast("int")
        right = F.element_at(starts, middle + 1) <= key
        return F.struct(F.when(right, middle).otherwise(at["lo"]).alias("lo"),
                        F.when(right, at["hi"]).otherwise(middle - 1).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), (F.size(starts) - 1).alias("hi"))
    # once there is one block left, its middle is itself
    return F.aggregate(steps, start, lambda at, k: F.when(at["lo"] < at["hi"], step(at, k))
                       .otherwise(at), lambda at: at["lo"])


def with_next(docs: DataFrame, carry: list[str], rows_per_block: int = ROWS_PER_BLOCK,
              most_blocks: int = MOST_BLOCKS, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, text and ``carry`` of every row, and next_<column> of the row after it."""
    spark = docs.sparkSession
    key = F.struct(F.col("doc_id").isNotNull().alias("there"),
                   F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                   F.substring("text", 1, PREFIX).alias("begin"), F.xxhash64("text").alias("text"))
    rows = docs.select("doc_id", "text", *carry, key.alias("_key"))
    known = docs.agg(F.count("*").alias("n"),
                     F.sum(F.octet_length("text") + 64).alias("bytes")).first()
    n, parts = known["n"], parts_for(known["bytes"] or 0, part_bytes)
    keys = materialise(spark, docs.select(key.alias("key")), "next-keys")
    blocks = max(1, min(most_blocks, -(-n // rows_per_block)))
    starts = block_starts(keys, n, blocks)
    # more copies of a row than a block has rows: there are fewer such rows than blocks
    many = materialise(spark, keys.groupBy("key").agg(F.count("*").alias("copies"))
                       .filter(F.col("copies") > -(-n // blocks)), "next-copies")
    hot = not many.isEmpty()
    if hot:
        marked = rows.join(F.broadcast(many), F.col("_key") == F.col("key"), "left").drop("key")
        others = [c for c in marked.columns if c not in ("_key", "copies")]
        one = marked.filter(F.col("copies").isNotNull()).groupBy("_key").agg(
            *[F.min(c).alias(c) for c in others], F.min("copies").alias("copies"))
        one = materialise(spark, one, "next-copied")
        rows = marked.filter(F.col("copies").isNull()).drop("copies").unionByName(one.drop("copies"))
    rows = rows.withColumn("_block", block_of(F.col("_key"), starts))
    first = F.element_at(starts, F.col("_block") + 1) == F.col("_key")
    before = F.when(F.col("_block") > 0, F.col("_block") - 1).otherwise(F.size(starts) - 1)
    place = lambda copy, at: F.struct(F.lit(copy).alias("copy"), at.alias("at"))
    places = F.when(first, F.array(place(0, F.col("_block")), place(1, before))) \
        .otherwise(F.array(place(0, F.col("_block"))))
    rows = rows.withColumn("_place", F.explode(places)).select(
        "doc_id", "text", *carry, "_key", F.col("_place.copy").alias("_copy"),
        F.col("_place.at").alias("_at")).repartition(parts, "_at")
    order = Window.partitionBy("_at").orderBy("_copy", "_key")
    # one window for all columns, so that the rows are shuffled once
    found = rows.select("doc_id", "text", *carry, "_copy",
                        *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *carry)]) \
        .filter(F.col("_copy") == 0).drop("_copy")
    if not hot:
        return found
    # the copies but one, in chunks of a block's rows
    chunk, rest = F.lit(rows_per_block), F.col("copies") - 1
    chunks = one.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((rest - 1) / chunk))))
    size = F.least(chunk, rest - F.col("_chunk") * chunk).cast("int")
    again = chunks.repartition(parts, "_key", "_chunk").withColumn(
        "_nth", F.explode(F.sequence(F.lit(1), size)))
    return found.unionByName(again.select(
        "doc_id", "text", *carry, *[F.col(c).alias(f"next_{c}") for c in ("text", *carry)]))


def with_edited(docs: DataFrame, k: int = K, shingle: int = SHINGLE,
                rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Every document with its sketch, its edited text and the next document's sketch.

    Edited: the last floor(n/4) of n code points give way to the first as many
    (or all) of the next document.
    """
    own = add_sketch(docs.select("doc_id", text_or_empty().alias("text")), "text", "sketch",
                     k, shingle)
    rows = with_next(own, ["sketch"], rows_per_block)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited_text", F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut),
        F.substring(F.col("next_text"), F.lit(1), cut)))
    return add_sketch(rows.drop("text", "next_text"), "edited_text", "edited_sketch", k, shingle)


def op7(docs: DataFrame) -> DataFrame:
    rows = with_edited(docs)
    return rows.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("est_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_share"))
