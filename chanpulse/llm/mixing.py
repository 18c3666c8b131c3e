"""Mixing sources to target weights, with DataFrame functions alone.

Sources in the order of their code points, null last, weigh 5, 2, 1, 5, 2, 1 ...
and share the corpus's words.  A target stops at three times its source's words;
the excess is reshared by weight until no source is above.

Within a source every document draws an exponential key, -ln(u) / w, from a hash
of its id and text and its quality weight w (Efraimidis and Spirakis): the
smallest keys are a weighted sample without replacement.  The target is filled by
as many complete epochs as fit.  What remains is filled from the smallest key on,
by a running sum of words; the document at the edge gives its first words, so the
words taken meet the (rounded) target exactly.

Scale: the text is read once, for words and quality.  A running sum within a
source is a sum within a range partition plus the partition sums before it, so a
source with a third of all rows spreads over as many partitions as its rows need.
What is decided per source is one row: epochs, the key at the edge, and the words
that the edge gives.  Rows are compared with it, not joined to each other.

Edge cases: a null text has no words and nothing is taken from it; null ids and
repeated rows draw keys like any other (identical rows at the edge share its
words); an empty table gives no row; a source without words has target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import GAP, WORD, materialise, parts_for, text_or_empty

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20_240_901
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ROWS_PER_PART = 250_000
#: Sources up to which their one-row decisions are broadcast (under 20 MB).
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality(text: Column) -> Column:
    """Letters, digits and spaces as a share of the text, at least 0.05."""
    kept = F.length(F.translate(text, PUNCTUATION, ""))
    return F.greatest(F.lit(0.05), kept / F.greatest(F.length(text), F.lit(1)))


def add_keys(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with _size, _src, _none (source is null), _crc and _key."""
    text = text_or_empty()
    crc = F.xxhash64(text)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_crc")), 11)
    u = (draw + 0.5) / F.lit(float(1 << 53))
    return (docs.withColumns({"_size": words(text), "_w": quality(text), "_crc": crc,
                              "_src": F.coalesce(F.col("source"), F.lit("")),
                              "_none": F.col("source").isNull()})
            .withColumn("_key", -F.log(u) / F.col("_w")).drop("_w"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds target to one row per source (_src, _none, source_size).

    Sorted by size over weight, the sources that stop at their bound come first:
    a source stops if the words left for it and those after it, shared by weight,
    would put it above.
    """
    by_name = Window.orderBy("_none", "_src")
    by_bound = Window.orderBy(F.col("source_size") / F.col("_weight"), "_none", "_src")
    earlier = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    bound = F.col("source_size") * most
    some = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    t = (sizes.withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                  (turn + 1).cast("int")))
         .withColumn("_bound", bound.cast("double"))
         .withColumns({"_all": some("source_size", whole), "_weights": some("_weight", whole),
                       "_bounds_before": some("_bound", earlier),
                       "_weights_before": some("_weight", earlier)}))
    share = (F.col("_all") - F.col("_bounds_before")) / (F.col("_weights")
                                                         - F.col("_weights_before"))
    t = t.withColumn("_stops", share * F.col("_weight") >= F.col("_bound"))
    stopped = lambda c: F.sum(F.when(F.col("_stops"), F.col(c)).otherwise(0)).over(whole)
    t = t.withColumns({"_left": F.col("_all") - stopped("_bound"),
                       "_sharing": F.col("_weights") - stopped("_weight")})
    return t.withColumn("target", F.when(F.col("_stops"), F.col("_bound")).otherwise(
        F.col("_left") / F.col("_sharing") * F.col("_weight"))).select(
        "_src", "_none", "source_size", "target")


def plan(keyed: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST,
         rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per source: source_size, target, _epochs and the edge.

    Rows before the edge (_edge_key, _edge_id, _edge_crc) are taken once more
    than the epochs; a row at it gives _edge_words more.  Without an edge, none.
    """
    spark = keyed.sparkSession
    narrow = keyed.select("_src", "_none", "_key", "doc_id", "_crc", "_size")
    order = ["_none", "_src", "_key", "doc_id", "_crc"]
    ranged = materialise(spark, narrow.repartitionByRange(
        parts_for(narrow.count(), rows_per_part), *order)
        .withColumn("_part", F.spark_partition_id()), "mix-order")
    sums = materialise(spark, ranged.groupBy("_part", "_none", "_src")
                       .agg(F.sum("_size").alias("_sum")), "mix-sums")
    goals = targets(sums.groupBy("_none", "_src").agg(F.sum("_sum").alias("source_size")),
                    weights, most)
    goals = goals.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goals = materialise(spark, goals.withColumn("_rest", F.greatest(F.lit(0), F.round(
        F.col("target")).cast("long") - F.col("_epochs") * F.col("source_size"))), "mix-goals")
    before = F.sum("_sum").over(Window.partitionBy("_none", "_src").orderBy("_part")) - F.col("_sum")
    # the partition of each source where its rest runs out
    edge_parts = (sums.withColumn("_before", before).join(goals, ["_none", "_src"])
                  .filter((F.col("_before") < F.col("_rest"))
                          & (F.col("_rest") <= F.col("_before") + F.col("_sum"))))
    # identical rows compare equal, so they count as one and share what the edge gives
    run = Window.partitionBy("_part", "_none", "_src").orderBy("_key", "doc_id", "_crc") \
        .rowsBetween(Window.unboundedPreceding, -1)
    edge = (ranged.join(edge_parts.select("_part", "_none", "_src", "_before", "_rest"),
                        ["_part", "_none", "_src"])
            .groupBy("_part", "_none", "_src", "_before", "_rest", "_key", "doc_id", "_crc")
            .agg(F.sum("_size").alias("_size"), F.count("*").alias("_twins"))
            .withColumn("_at", F.col("_before") + F.coalesce(F.sum("_size").over(run), F.lit(0)))
            .filter((F.col("_at") < F.col("_rest"))
                    & (F.col("_rest") <= F.col("_at") + F.col("_size")))
            .select("_none", "_src", F.col("_key").alias("_edge_key"),
                    F.col("doc_id").alias("_edge_id"), F.col("_crc").alias("_edge_crc"),
                    F.expr("(_rest - _at) div _twins").alias("_edge_words")))
    return materialise(spark, goals.join(edge, ["_none", "_src"], "left"), "mix-plan")


def extra_words() -> Column:
    """Words that the fractional selection takes of a row joined with its plan."""
    key, edge = F.col("_key"), F.col("_edge_key")
    no_id, no_edge_id = F.col("doc_id").isNull(), F.col("_edge_id").isNull()
    id_before = (no_id & ~no_edge_id) | (~no_id & ~no_edge_id
                                         & (F.col("doc_id") < F.col("_edge_id")))
    id_same = F.col("doc_id").eqNullSafe(F.col("_edge_id"))
    crc = F.col("_crc")
    earlier = (key < edge) | ((key == edge) & (id_before | (id_same & (crc < F.col("_edge_crc")))))
    at = (key == edge) & id_same & (crc == F.col("_edge_crc"))
    return F.when(edge.isNull(), F.lit(0).cast("long")).when(earlier, F.col("_size")) \
        .when(at, F.least(F.col("_size"), F.col("_edge_words"))).otherwise(F.lit(0).cast("long"))


def with_plan(keyed: DataFrame, decided: DataFrame) -> DataFrame:
    """Each row with its source's plan, _extra and _taken."""
    small = decided.count() <= BROADCAST_SOURCES
    joined = keyed.join(F.broadcast(decided) if small else decided, ["_none", "_src"])
    joined = joined.withColumn("_extra", extra_words())
    return joined.withColumn("_taken", F.col("_epochs") * F.col("_size") + F.col("_extra"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST,
        seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``."""
    keyed = materialise(docs.sparkSession, add_keys(docs.select("doc_id", "source", "text"), seed)
                        .drop("text", "source"), "mix-keys")
    return with_plan(keyed, plan(keyed, weights, most)).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        F.col("_taken").alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST,
                    seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each time a document is taken.

    The document at a source's edge ends after the words taken (its n_chars, if
    there is that column, follows).  The columns are those of ``docs``.
    """
    spark = docs.sparkSession
    narrow = materialise(spark, add_keys(docs.select("doc_id", "source", "text"), seed)
                         .drop("text", "source"), "mix-keys")
    # the whole row travels in one column, so that no name of it can clash
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text")
    chosen = with_plan(add_keys(rows, seed), plan(narrow, weights, most))
    copies = (F.col("_epochs") + F.when(F.col("_extra") > 0, 1).otherwise(0)).cast("int")
    copy = chosen.filter((copies > 0) & (F.col("_size") > 0)).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), copies)))
    cut = (F.col("_copy") > F.col("_epochs")) & (F.col("_extra") < F.col("_size"))
    some = F.array_join(F.slice(F.array_remove(F.split("text", GAP), ""), F.lit(1),
                                F.greatest(F.col("_extra"), F.lit(1)).cast("int")), " ")
    out = copy.withColumn("_text", F.when(cut, some).otherwise(F.col("text")))

    def column(c: str) -> Column:
        was = F.col("_row")[c]
        if c == "text":
            return F.col("_text").alias(c)
        if c == "n_chars":
            kind = docs.schema[c].dataType
            return F.when(cut, F.length("_text").cast(kind)).otherwise(was).alias(c)
        return was.alias(c)

    return out.select(*[column(c) for c in docs.columns])


def op9(docs: DataFrame) -> DataFrame:
    return mix(docs)
