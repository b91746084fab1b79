"""From raw documents to shards for training.

Each stage takes what its predecessor kept and returns the columns of documents, the last one with shard and slot besides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.llm.common import blank_words, identified, table, unused
from quartzo.llm.contamination import decontaminate
from quartzo.llm.language import UNKNOWN, fit_languages, identify
from quartzo.llm.mixing import mix
from quartzo.llm.sharding import shard
from quartzo.llm.simhash import simhash_components

SHARDS = 8
#: Language identification can't be expressed in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject what the identifier calls undetermined: null and empty texts and texts without a letter; without any label, all.

    Repeated rows are judged alike; an empty table stays empty.
    """
    model = fit_languages(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return identify(docs, model).where(F.col("lang_pred") != UNKNOWN).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id; of equal ids the first row."""
    (rid,) = unused(docs, "row")
    rows = identified(docs, rid)
    linked = simhash_components(rows, keep=(rid,))
    # a group whose ids are all null has no component id, but all its rows have a group through their fingerprints
    first = linked.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col(rid))).alias("first"))
    chosen = first.select(F.col(f"first.{rid}").alias("chosen"))
    return rows.join(chosen, F.col(rid) == F.col("chosen"), "left_semi").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents of which a twentieth or more lies in benchmark windows; null and empty texts have none and stay.

    Repeated rows are judged each for itself.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents until the sources' words have the weights 1, 2, 3 in turn.

    A null source is one of its own. Null and empty texts have no words: they weigh nothing and stay once. Repeated rows are
    drawn each for itself.
    """
    size = F.size(blank_words(F.col("text"))).cast("long")
    return mix(docs, "source", size, F.xxhash64("doc_id", "text")).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the documents into shards of near equal bytes; equal texts together, null like empty. Every row has a slot."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    return shard(docs, SHARDS, size, F.xxhash64("text"))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
