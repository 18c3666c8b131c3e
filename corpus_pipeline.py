"""A corpus pipeline: raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared checkpoint folder and reread as the next one's docs.  All but
the last return the columns of ``documents``:

1. ``language``: documents that the nearest-centroid classifier rejects go.
2. ``quality``: documents that the weakly supervised classifier rejects go.
3. ``near_duplicates``: one document of each group of near copies stays (five-word
   shingles, similarity 0.8).
4. ``mixing``: sources are mixed to their target weights; a document stands there as
   often as it is taken, and the one at a source's edge ends after its last word.
5. ``tokens``: whole texts are encoded: n_tokens, ids, and digests of the ids and of
   their decoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanpulse.llm import bpe, langid, mixing, neardup, quality
from chanpulse.llm.common import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encoded_column(bpe.default_path())(F.col("text"))
    return docs.select("doc_id", "lang", "source", encoded.alias("_e")).select(
        "doc_id", "lang", "source", "_e.*")


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates),
          ("mixing", mixed), ("tokens", tokens)]

#: The classifiers and the hashes of signatures, keys and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
