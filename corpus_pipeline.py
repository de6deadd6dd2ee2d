"""From raw documents to packed training bins: every stage works on all that its predecessor kept.

Each stage is a function of (spark, docs, sf_dir) and returns a table that ``run`` writes as Parquet into the shared
folder and reads again for the next. All but the last return the columns of documents. Mixing may take a document
more than once; its copies are rows of their own, and packing never puts two copies into one bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brandtide.llm import mixing, near_dedup, packing, substrings, toxicity
from brandtide.llm.common import small_batches, table
from brandtide.runtime import scratch, staged


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]
#: Language models, similarity joins and best-fit packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:  # a stage's own tables go once its rows are written
            docs = keep(staged(stage(spark, docs, sf_dir), f"stage-{name}"))
    return docs
