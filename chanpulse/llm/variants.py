"""Grouping of spelling variants by permuterm rotations.

Each word gets a terminator, and every rotation of it is laid out:  the rotations of
``form$`` are ``form$``, ``orm$f``, ``rm$fo``, ``m$for`` and ``$form``.  A rotation brings the
character under edit to its end, so in the sorted rotations

* words that differ by one replaced character have rotations with a common prefix and one
  further character (the edited one, which the prefix skips);
* a word that lacks that character has the prefix itself as a rotation.

So each rotation is posted under itself (as the word that may lack a character) and, without
its last character, as a word that may have one replaced or too many.  The postings are
range-partitioned and sorted by prefix, and one scan over each prefix's group finds what is
near.  A group holds at most one word for each letter and one more, since the terminator
fixes the place of the edit: no group is hot, however frequent its words are.  A pair of
words meets in one group only: where equal letters stand side by side, taking out any of
them gives the same word, and only the first of them counts.

A scan doesn't write out a group's pairs.  It emits, for each word of the group, how many
words are near it there and the most frequent of these, one row a word; a hash aggregate by
word puts the groups together.

Every word leads to its ``form``; forms are followed to the last by pointer doubling.  A
form has at least twice the occurrences of its word, so a chain has at most 62 steps, and the
doubling ends after at most seven rounds.

Edge cases: a null text has no word; a null doc_id counts as empty text where occurrences are
edited; a long text is one row until its words are laid out; repeated rows are further
occurrences; equal counts are decided by code-point order; an empty table gives no row;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanpulse.llm.common import materialise, parts_for, text_or_empty

# fixed values: what a word is made of, once A to Z are lower-cased, and the terminator
LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"
#: An occurrence in so many loses a character in the query (by crc32 of id and word).
EDITED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: How often a form occurs for each occurrence of its word, at least.
RATIO = 2
#: Words whose rotations are sorted by one task, about.
WORDS_PER_PART = 50_000


def occurrences(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """doc_id (as text) and word of every run of letters of at least ``least_length``."""
    low = F.translate(text_or_empty(), UPPER, LOWER)
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                        F.explode(F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0)))
                        .alias("word"))
    return found.filter(F.char_length("word") >= least_length)


def edited(found: DataFrame, one_in: int = EDITED) -> DataFrame:
    """The occurrences, one in ``one_in`` without one of its characters."""
    h = F.crc32(F.concat_ws(":", "doc_id", "word").cast("binary"))
    at = F.col("_h") % F.char_length("word")
    short = F.concat(F.substring("word", 1, at), F.substring("word", at + 2, F.char_length("word")))
    return found.withColumn("_h", h).select(
        "doc_id", F.when(F.col("_h") % one_in == 0, short).otherwise(F.col("word")).alias("word"))


def counted(found: DataFrame, least_length: int = LEAST_LENGTH,
            least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of words that are long and frequent enough."""
    return (found.filter(F.char_length("word") >= least_length).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """prefix, edited, word, n: two postings of each rotation; ``edited`` is the character
    that the prefix skips, null where the prefix is the whole rotation."""
    word, size = F.col("word"), F.char_length("word")
    tail = lambda k: F.substring(word, k + 1, size)
    head = lambda k: F.substring(word, F.lit(1), k)
    whole = F.transform(F.sequence(F.lit(0), size), lambda k: F.struct(
        F.concat(tail(k), F.lit(END), head(k)).alias("prefix"),
        F.lit(None).cast("string").alias("edited")))
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.struct(
        F.concat(tail(k + 1), F.lit(END), head(k)).alias("prefix"),
        F.substring(word, k + 1, F.lit(1)).alias("edited")))
    return words.select("word", "n", F.explode(F.concat(whole, skipped)).alias("_r")) \
        .select("_r.prefix", "_r.edited", "word", "n")


def scanned(posted: DataFrame, parts: int) -> DataFrame:
    """word, near, best: for each word of a prefix's group with words near it, their
    number and the first of them by (-n, word), as a struct."""
    order = [F.col("rare"), F.col("word")]
    rows = posted.withColumn("rare", -F.col("n"))
    rows = rows.repartitionByRange(parts, "prefix").sortWithinPartitions("prefix", *order)
    group = Window.partitionBy("prefix").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    me, longer = F.struct("rare", "word"), F.col("edited").isNotNull()
    # of equal letters side by side only the first is taken out
    indel = F.col("edited") != F.substring("prefix", -1, 1)
    rows = rows.select(
        "word", "edited", indel.alias("indel"),
        F.count("edited").over(group).alias("longer"),
        F.count(F.when(indel, True)).over(group).alias("indels"),
        F.nth_value(F.when(longer, me), 1, True).over(group).alias("first"),
        F.nth_value(F.when(longer, me), 2, True).over(group).alias("second"),
        F.nth_value(F.when(indel, me), 1, True).over(group).alias("first_indel"),
        F.min(F.when(~longer, me)).over(group).alias("shorter"))
    other = F.when(F.col("first.word") == F.col("word"), F.col("second")).otherwise(F.col("first"))
    lacks = F.when(F.col("indel"), F.col("shorter"))
    is_longer = F.col("edited").isNotNull()
    return rows.select(
        "word",
        F.when(is_longer, F.col("longer") - 1 + lacks.isNotNull().cast("long"))
        .otherwise(F.col("indels")).alias("near"),
        F.when(is_longer, F.least(other, lacks)).otherwise(F.col("first_indel")).alias("best")) \
        .filter(F.col("near") > 0)


def near_words(words: DataFrame, words_per_part: int = WORDS_PER_PART) -> DataFrame:
    """word, n, n_near, best, best_n of every word of ``words`` (word, n; words distinct)."""
    parts = parts_for(words.count(), words_per_part)
    best = scanned(rotations(words), parts).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("_best"))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("_best.word").alias("best"), (-F.col("_best.rare")).alias("best_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root: where the links word -> form end, for the words that have one."""
    spark = forms.sparkSession
    links = materialise(spark, forms.select("word", F.col("form").alias("root")), "variant-links")
    while True:
        on = links.select(F.col("word").alias("_via"), F.col("root").alias("_next"))
        step = links.join(on, F.col("root") == F.col("_via"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved"))
        step = materialise(spark, step, "variant-links")
        links = step.drop("_moved")
        if step.filter("_moved").isEmpty():
            return links


def grouped(words: DataFrame, ratio: int = RATIO,
            words_per_part: int = WORDS_PER_PART) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n)."""
    spark = words.sparkSession
    near = near_words(words, words_per_part)
    fits = F.col("best_n") >= ratio * F.col("n")
    near = materialise(spark, near.select(
        "word", "n", "n_near", F.when(fits, F.col("best")).alias("form"),
        F.when(fits, F.col("best_n")).alias("form_n")), "variant-forms")
    roots = last_forms(near.filter(F.col("form").isNotNull()))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11(docs: DataFrame) -> DataFrame:
    words = materialise(docs.sparkSession, counted(edited(occurrences(docs))), "variant-words")
    return grouped(words)
