"""Corpus preparation: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir), works on all rows that the previous
one kept, and its decisions take effect.  All but the last return the columns
of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakesmith.llm import decontaminate as leaks
from lakesmith.llm import mixing, sharding, simhash, toxicity
from lakesmith.llm.common import col, staged, table

SHARDS = 40

#: Boosted trees, SimHash and random sharding have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model fitted on labelled documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).where("predicted = 0").select(*[col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (4-word shingles, 4 bits)."""
    return simhash.keep_one_per_group(docs, shingle=4, distance=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark overlap."""
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target source, language and topic weights."""
    return mixing.sample_to_targets(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents in shards of equal row counts, shuffled uniformly."""
    return sharding.shuffle_into_shards(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", into_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
