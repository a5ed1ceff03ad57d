"""Corpus pipeline: toxicity, near-duplicates, benchmark contamination, mixing and
sharding of ``documents``, each stage on all that the one before kept.

Every stage is written as Parquet in the shared folder and read again, so a lost
executor never repeats more than a stage.  No SQL can express the learnt and
tree-based stages (ORACLE_SQL is None); tests hold run() against brute force.

All stages take whole texts, however long, and carry other columns along; all but the
last return the columns they got.  Repeated rows are rows of their own (but for the
near-duplicates, where they are copies), an empty table stays empty.  Null and empty texts and null ids are never an error; what becomes of them is
said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontaminate, hilbert_shards, mixing, simhash_vptree, toxic_segments
from mercato.llm.common import materialise, read_table

#: The mixture: nine tenths of the tokens that came this far, nothing repeated.
MIX = mixing.Mix(budget_permille=900, epochs=1, seed=mixing.PRODUCTION.seed, weights=mixing.PRODUCTION.weights)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go.  Null and empty texts hold no toxic
    passage and stay; rows without an id are judged like others but never learnt from."""
    return toxic_segments.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id,
    ties by the row's hash.  Texts without a word have fingerprint zero and form one group,
    so one of them stays."""
    return simhash_vptree.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go, whether they or the item have an
    id or not; null and empty texts hold none and stay."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture takes stay.  Null languages and sources are branches of
    their own, null and empty texts count no tokens, ties in the seeded order go by id."""
    return mixing.select(docs, MIX)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and its slot there; null texts count as empty,
    null ids come first, ties go by the text's hash."""
    return hilbert_shards.assign(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("sharding", sharding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
