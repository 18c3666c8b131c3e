"""Near-duplicate documents by SuperMinHash, banding, verification and components.

1. Signature.  A document's set holds its distinct runs of ``shingle`` words (the
   whole sequence, if it has fewer).  Each element draws, component after component
   of a random permutation, the values j + u_j; a signature component is the least
   value drawn for it.  A document stops when no later round can lower a component.
   All documents of a batch take a round at once, with numpy.
2. Classes.  Documents with equal sets (128-bit key of the set) are one class; only
   classes go on, so copies never meet each other.
3. Banding.  Classes that agree in all ROWS components of one of BANDS bands share a
   bucket.  A bucket's members are tied to its smallest one: links that grow with
   the number of members, not of pairs.  The components of these ties are the
   clusters; classes of different clusters share no bucket.
4. Verification.  Within a cluster every link is confirmed on whole sets: from a
   member, its links among the members not yet reached are found by counting common
   elements, and these go on.  A cluster larger than MOST (or ELEMENTS) is dealt into parts, which
   are searched like that; then ties over a border of parts are verified, then ties of a
   bucket's components to its largest one.  A tight cluster of any size is one component
   after these.  Members of buckets that still hold several components are joined by a
   prefix filter: a set's elements are ordered from the rarest, and two sets that are alike
   share one of the first n - ceil(0.8 n) + 1 of either.  Sizes and the places of the
   shared element rule out most of these pairs, too, and the rest are verified.  A family
   of texts that share a template, but not enough of it, thus makes no pairs: what a member
   has in common with others stands behind what it has alone.
5. Components.  The confirmed links' components give every document the smallest
   doc_id it reaches.

Hot keys: what an aggregate says of a bucket, a cluster or a component (a row each) is
written before its rows are joined with it, so that both sides of the join are plain
exchanges, and adaptive execution can split a bucket, cluster or component that holds a
third of all rows.  Texts are read a second time for the sets of clusters' members; most
others are dropped by a bitmap of the members' hashed keys before any text is moved.

At similarity 0.8 two sets share a bucket with probability 1 - (1 - 0.8 ** ROWS) **
BANDS, that is all but five in a million; the bands' keys are the only thing that is
random, all counts are exact.

Edge cases: a null or wordless text has an empty set and is its own component; null
ids come after all others as a component's id (null, if there is no other); repeated
rows and ids are in one component if their sets are linked; an empty table gives no
row; other columns are ignored by the operator and kept by the stage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import arrow_udf, map_in_arrow, materialise
from chanpulse.llm.components import stars
from chanpulse.llm.textarrays import mix64, slices, spans, word_bounds, word_hashes

ROWS, BANDS = 6, 40
SHINGLE = 5
#: Least similarity, in hundredths.
ALIKE = 80
#: Members and elements of a cluster, or of a part of one, that are searched in one piece.
MOST, ELEMENTS = 4_000, 2_000_000
#: Bits of the bitmap of wanted keys: so many a key, and at most so many in all (32 MB).
#: Beyond that more texts pass it; the join after it is exact.
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
#: Bits of one row of the bitmap, as Spark's ``bitmap_construct_agg`` makes it.
BITMAP_ROW = 1 << 15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def sets(body: np.ndarray, at: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the texts they belong to."""
    body = _LOWER[body]
    starts, ends, of = word_bounds(body, at)
    words = word_hashes(body, starts, ends)
    n = len(at) - 1
    many = np.bincount(of, minlength=n)
    size = max(len(words) - shingle + 1, 0)
    run = np.zeros(size, np.uint64)
    for d in range(shingle):
        run = mix64(run + words[d:d + size]) if size else run
    inside = of[:size] == of[shingle - 1:] if size else np.zeros(0, bool)
    run, run_of = run[inside], of[:size][inside]
    first = np.cumsum(many) - many
    short = np.flatnonzero((many > 0) & (many < shingle))
    whole = np.zeros(len(short), np.uint64)
    for d in range(shingle - 1):
        there = many[short] > d
        whole[there] = mix64(whole[there] + words[first[short[there]] + d])
    element = np.concatenate([run, mix64(whole + many[short].astype(np.uint64))])
    of = np.concatenate([run_of, short])
    order = np.lexsort((element, of))
    element, of = element[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (element[1:] != element[:-1]) | (of[1:] != of[:-1])
    return element[new], of[new]


def signatures(element: np.ndarray, of: np.ndarray, n: int, m: int) -> np.ndarray:
    """SuperMinHash of each set (n x m); a component of an empty set is infinite."""
    out = np.full(n * m, np.inf)
    element, row = element.copy(), of.copy()
    places = None
    for j in range(m):
        draw = mix64(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        value = j + (draw >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        k = j + (mix64(draw) % np.uint64(m - j)).astype(np.int64)
        if places is None:
            slot = k
        else:
            each = np.arange(len(k))
            slot = places[each, k].astype(np.int64)
            places[each, k] = places[:, j]
        np.minimum.at(out, row * m + slot, value)
        live = np.unique(row)
        going = np.zeros(n, bool)
        going[live] = out.reshape(n, m)[live].max(axis=1) > j + 1
        stay = going[row]
        if not stay.any():
            break
        if places is None:
            element, row, k = element[stay], row[stay], k[stay]
            places = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(row), 1))
            places[np.arange(len(k)), k] = 0
        elif not stay.all():
            element, row, places = element[stay], row[stay], places[stay]
    return out.reshape(n, m)


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, m = signature.shape
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(n, m // rows, rows)
    key = np.broadcast_to(np.arange(m // rows, dtype=np.uint64), (n, m // rows)).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, r])
    return key.view(np.int64)


def text_key() -> Column:
    """With the id, names a row's text; tells a null id from any other."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("text"))


def maybe_among(rows: DataFrame, wanted: DataFrame, keys: list[str],
                most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` but for most of those whose ``keys`` ``wanted`` doesn't have: every key hashes
    to one bit of a bitmap, which is broadcast (at most ``most_bits``), so no row is moved."""
    need = max(BITMAP_ROW, BITS_PER_KEY * wanted.count())
    bits = min(most_bits, 1 << (need - 1).bit_length())
    bit = F.pmod(F.xxhash64(*keys), F.lit(bits))
    line, at = F.floor(bit / BITMAP_ROW), F.pmod(bit, F.lit(BITMAP_ROW))
    bitmap = wanted.select(line.alias("_line"), at.alias("_at")).groupBy("_line").agg(
        F.bitmap_construct_agg("_at").alias("_bitmap"))
    byte = F.substring("_bitmap", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.call_function("shiftright", value, (F.col("_at") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return rows.withColumns({"_line": line, "_at": at}).join(F.broadcast(bitmap), "_line") \
        .filter(is_set).select(*rows.columns)


def features(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, th, n, k1, k2 (key of the set) and the bands of every row."""
    def run(batches):
        for batch in batches:
            done = 0
            for part in slices(batch.column(2)):
                body, at = spans(part)
                element, of = sets(body, at, shingle)
                n = len(part)
                sizes = np.bincount(of, minlength=n)
                ends = np.cumsum(sizes)
                keys = []
                for salt in (11, 12):
                    sums = np.r_[np.zeros(1, np.uint64),
                                 np.cumsum(mix64(element + np.uint64(salt)), dtype=np.uint64)]
                    keys.append(mix64(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)))
                bands = band_keys(signatures(element, of, n, ROWS * BANDS))
                rows = batch.slice(done, n)
                done += n
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(sizes.astype(np.int64)),
                     pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS),
                                              pa.array(bands.ravel()))],
                    ["doc_id", "th", "n", "k1", "k2", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("th"), "text")
    return map_in_arrow(rows, run,
                        "doc_id long, th long, n long, k1 long, k2 long, bands array<long>")


def linked(common, a, b):
    return (100 + ALIKE) * common >= ALIKE * (a + b)


def reach(members: list[np.ndarray]) -> list[int]:
    """For each set, the first set of its component; links are confirmed on the sets."""
    n = len(members)
    sizes = np.array([len(x) for x in members], np.int64)
    root = list(range(n))
    if n == 2:
        common = len(np.intersect1d(members[0], members[1], assume_unique=True))
        return [0, 0] if linked(common, *sizes.tolist()) else root
    _, number = np.unique(np.concatenate(members), return_inverse=True)
    ends = np.cumsum(sizes)
    own = [number[e - s:e] for s, e in zip(sizes, ends, strict=True)]
    mark = np.zeros(int(number.max()) + 1, bool)
    left = np.arange(n)  # members not yet reached, and their elements
    flat, at = number, np.r_[0, ends]
    seen = np.zeros(n, bool)
    for first in range(n):
        if seen[first]:
            continue
        seen[first] = True
        edge = [first]
        while edge:
            x = edge.pop()
            if seen[left].sum() * 2 > len(left):
                left = left[~seen[left]]
                flat = np.concatenate([own[i] for i in left]) if len(left) else flat[:0]
                at = np.r_[0, np.cumsum(sizes[left])]
            if not len(left):
                break
            mark[own[x]] = True
            common = np.add.reduceat(mark[flat], at[:-1], dtype=np.int64)
            mark[own[x]] = False
            found = left[linked(common, sizes[left], sizes[x]) & ~seen[left]]
            seen[found] = True
            for i in found.tolist():
                root[i] = first
                edge.append(i)
    return root


def search(parts: DataFrame) -> DataFrame:
    """(cid, root) for rows (label, part, cid, set) that lie in order, a part at a time."""
    def run(batches):
        key, cids, members = None, [], []

        def close():
            roots = reach(members)
            return pa.RecordBatch.from_arrays(
                [pa.array(cids, pa.int64()), pa.array([cids[r] for r in roots], pa.int64())],
                ["cid", "root"])

        for batch in batches:
            for label, part, cid, x in zip(*[batch.column(i).to_pylist() for i in range(4)],
                                           strict=True):
                if (label, part) != key:
                    if cids:
                        yield close()
                    key, cids, members = (label, part), [], []
                if not cids or cids[-1] != cid:  # a text may stand in several rows
                    cids.append(cid)
                    members.append(np.frombuffer(x, np.uint64))
        if cids:
            yield close()

    ordered = parts.repartition("label", "part").sortWithinPartitions("label", "part", "cid")
    return map_in_arrow(ordered.select("label", "part", "cid", "set"), run, "cid long, root long")


def confirmed(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets are alike."""
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(x.to_pylist(), y.to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            out.append(bool(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))))
        return pa.array(out, pa.bool_())

    one = whole.dropDuplicates(["cid"])
    sides = [one.select(F.col("cid").alias(c), F.col("set").alias(f"{c}_set")) for c in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b") \
        .filter(arrow_udf(run, "boolean")("a_set", "b_set")).select("a", "b")


def alike_prefixes(spark, apart: DataFrame, whole: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``apart`` (cid, root) with different roots that may be alike.

    Exact: no pair at or above the threshold is missed.  Elements that one set alone has take
    their places at the front of its order without being looked at."""
    def numbers(sets: pa.Array) -> pa.Array:
        found = [np.frombuffer(x, np.int64) for x in sets.to_pylist()]
        at = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(
            np.concatenate([np.zeros(0, np.int64), *found])))

    own = whole.dropDuplicates(["cid"]).join(apart, "cid")
    entries = own.select("cid", "root", (F.length("set") / 8).cast("long").alias("n"),
                         F.explode(arrow_udf(numbers, "array<long>")(F.col("set"))).alias("e"))
    entries = materialise(spark, entries, "near-elements")
    rare = entries.groupBy("e").agg(F.count("*").alias("often")).filter(F.col("often") > 1)
    shared = entries.join(rare, "e")
    mine = Window.partitionBy("cid")
    place = F.col("n") - F.count("*").over(mine) \
        + F.row_number().over(mine.orderBy("often", "e"))
    first = F.col("n") - F.ceil(F.col("n") * ALIKE / 100) + 1
    kept = materialise(spark, shared.withColumn("place", place).filter(F.col("place") <= first)
                       .select("e", "cid", "root", "n", "place"), "near-prefixes")
    x, y = (kept.select("e", *[F.col(c).alias(f"{c}_{side}") for c in ("cid", "root", "n", "place")])
            for side in "ab")
    most = F.least("place_a", "place_b") + F.least(F.col("n_a") - F.col("place_a"),
                                                   F.col("n_b") - F.col("place_b"))
    return x.join(y, "e").filter(
        (F.col("cid_a") > F.col("cid_b")) & (F.col("root_a") != F.col("root_b"))
        & linked(most, F.col("n_a"), F.col("n_b"))) \
        .select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct()


def components(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST) -> DataFrame:
    """doc_id, th, n_shingles, component_id and first (the row that stays, with its copies)."""
    spark = docs.sparkSession
    rows = materialise(spark, features(docs, shingle), "near-features")
    no_id = F.col("doc_id").isNull().alias("none")
    classes = rows.filter(F.col("n") > 0).groupBy("k1", "k2").agg(
        F.min(F.struct(no_id, "doc_id", "th")).alias("rep"), F.min("bands").alias("bands"),
        F.min("n").alias("n"))
    classes = materialise(spark, classes.withColumn("cid", F.monotonically_increasing_id()),
                          "near-classes")
    held = classes.select("cid", F.explode("bands").alias("key"))
    shared = held.groupBy("key").agg(F.min("cid").alias("hub"), F.count("*").alias("members")) \
        .filter(F.col("members") > 1).drop("members")
    shared = materialise(spark, shared, "near-hubs")
    members = materialise(spark, held.join(shared, "key"), "near-buckets")
    ties = members.filter(F.col("cid") != F.col("hub")).select(
        F.col("cid").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = stars(ties).select(F.col("node").alias("cid"), F.col("root").alias("label"))
    clusters = clusters.join(classes.select("cid", "n", "rep"), "cid")
    clusters = materialise(spark, clusters, "near-clusters")
    many = materialise(spark, clusters.groupBy("label").agg(F.ceil(F.greatest(
        F.count("*") / most, F.sum("n") / ELEMENTS)).alias("parts")), "near-parts")
    dealt = materialise(spark, clusters.join(many, "label").withColumn(
        "part", F.pmod(F.xxhash64("cid"), F.col("parts"))), "near-clusters")
    wanted = dealt.select(
        "label", "part", "parts", "cid", F.col("rep.none").alias("none"),
        F.coalesce("rep.doc_id", F.lit(0)).alias("id"), F.col("rep.th").alias("th"))
    text = docs.select(no_id, F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       text_key().alias("th"), "text")

    def whole_set(column: pa.Array) -> pa.Array:
        out = []
        for part in slices(column):
            element, of = sets(*spans(part), shingle)
            ends = np.cumsum(np.bincount(of, minlength=len(part)))
            out += [element[a:b].tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
        return pa.array(out, pa.binary())

    text = maybe_among(text, wanted, ["none", "id", "th"])
    # merged at every size: the plan of a small input is that of a large one
    whole = text.hint("merge").join(wanted, ["none", "id", "th"]).select(
        "label", "part", "parts", "cid", arrow_udf(whole_set, "binary")(F.col("text")).alias("set"))
    whole = materialise(spark, whole, "near-sets")
    found = materialise(spark, search(whole), "near-roots")
    if not dealt.filter(F.col("parts") > 1).isEmpty():
        found = across(spark, members, dealt, whole, found)
    # the smallest id of each component; classes without links are their own
    reps = found.join(classes.select("cid", "rep"), "cid")
    least = materialise(spark, reps.groupBy("root").agg(F.min("rep").alias("least")), "near-least")
    own = classes.join(found, "cid", "left").select(
        "k1", "k2", "rep", F.coalesce("root", "cid").alias("root"))
    own = own.join(least, "root", "left").select("k1", "k2", F.coalesce("least", "rep").alias("least"))
    narrow = rows.select("doc_id", "th", "n", "k1", "k2")
    some = narrow.filter(F.col("n") > 0).join(own, ["k1", "k2"])
    some = some.select("doc_id", "th", "n", F.col("least.doc_id").alias("component_id"),
                       F.col("doc_id").eqNullSafe(F.col("least.doc_id")).alias("_id"),
                       F.col("least.th").alias("_th"))
    some = some.select("doc_id", "th", F.col("n").alias("n_shingles"), "component_id",
                       (F.col("_id") & (F.col("th") == F.col("_th"))).alias("first"))
    return some.union(narrow.filter(F.col("n") == 0).select(
        "doc_id", "th", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("first")))


def across(spark, members: DataFrame, dealt: DataFrame, whole: DataFrame,
           found: DataFrame) -> DataFrame:
    """(cid, root) after links over the borders of the parts of large clusters."""
    whole = whole.filter(F.col("parts") > 1).select("cid", "set")
    large = dealt.filter(F.col("parts") > 1).select("cid")
    buckets = members.join(large, "cid")
    roots = found

    def named(cid: str, root: str) -> DataFrame:
        return roots.select(F.col("cid").alias(cid), F.col("root").alias(root))

    ties = buckets.filter(F.col("cid") != F.col("hub")).select(
        F.col("cid").alias("a"), F.col("hub").alias("b")).distinct()
    ties = ties.join(named("a", "ra"), "a").join(named("b", "rb"), "b") \
        .filter(F.col("ra") != F.col("rb")).select("a", "b")
    links = found.select(F.col("cid").alias("a"), F.col("root").alias("b"))

    def joined(more: DataFrame) -> DataFrame:
        # single classes have no link of their own and keep themselves as root
        grown = stars(links.union(more))
        return materialise(spark, found.select("cid").join(
            grown.withColumnRenamed("node", "cid"), "cid", "left").select(
            "cid", F.coalesce("root", "cid").alias("root")), "near-roots")

    sure = materialise(spark, confirmed(ties, whole), "near-links")
    roots = joined(sure)

    def placed() -> tuple[DataFrame, DataFrame, DataFrame]:
        """Members with their roots; each bucket's roots; their number, and the one with most
        members."""
        each = buckets.join(named("cid", "root"), "cid").select("key", "cid", "root")
        groups = each.groupBy("key", "root").agg(F.min("cid").alias("head"),
                                                 F.count("*").alias("n"))
        main = groups.groupBy("key").agg(F.max(F.struct("n", "root", "head")).alias("main"),
                                         F.count("*").alias("roots"))
        return each, groups, materialise(spark, main, "near-main")

    # the components of a bucket are tied to its largest one by their first members, so
    # that a smallest member that is linked to nothing leaves no component behind
    _, groups, main = placed()
    heads = groups.join(main, "key").filter(F.col("root") != F.col("main.root")).select(
        F.greatest("head", "main.head").alias("a"), F.least("head", "main.head").alias("b")).distinct()
    sure = materialise(spark, sure.union(confirmed(heads, whole)), "near-links")
    roots = joined(sure)
    # what still lies apart: members of buckets with several components
    each, _, main = placed()
    split = main.filter(F.col("roots") > 1).select("key")
    apart = materialise(spark, each.join(split, "key", "left_semi").select("cid", "root").distinct(),
                        "near-apart")
    pairs = alike_prefixes(spark, apart, whole)
    more = materialise(spark, confirmed(pairs, whole), "near-links")
    return joined(sure.union(more))


def op10(docs: DataFrame) -> DataFrame:
    return components(docs, shingle=2).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id."""
    found = components(docs.select("doc_id", "text"), shingle)
    stay = found.filter("first").select(
        F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
        F.col("th").alias("_th")).distinct()
    # the whole row travels in one column, so that no name of it can clash
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").isNull().alias("_none"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
                       text_key().alias("_th"))
    key = ["_none", "_id", "_th"]
    copy = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    return rows.join(stay, key).withColumn("_copy", copy).filter(F.col("_copy") == 1) \
        .select(*[F.col("_row")[c].alias(c) for c in docs.columns])
