"""A training corpus in five stages, each a training-data operator.

Every stage reads what its predecessor kept; :func:`run` writes each result as
Parquet to the shared checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, mixing, sharding, simhash, toxicity
from strata.llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below 0.5; it learns from
    the labelled ones among them outside the held-out fifth."""
    return toxicity.drop_toxic(docs, toxicity.learn_lexicon(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of at most two bits connect."""
    return simhash.deduplicate(docs, shingle_words=3, max_distance=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources meet their targets."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that their id hashes to."""
    return sharding.assign_shards(docs, ["doc_id"], 16)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", near_dedup),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Fingerprints, learned scores and random draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sharded corpus from the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
