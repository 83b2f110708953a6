"""From raw documents to shards of training text, in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a table that is written as Parquet
and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import mixing, sharding, simhash, toxicity, wumanber
from martloom.llm.tables import read, remainder
from martloom.shared import written

SHARDS = 16

# Near means SimHash fingerprints of four-word shingles that differ in four bits at most.
NEAR = {"words": 4, "radius": 4, "blocks": 3}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half; the labels of every fifth id teach nothing."""
    labels = read(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    sample = toxicity.labelled_sample(docs.select("doc_id", "text"), labels)
    judged = toxicity.with_toxicity(docs, toxicity.fit(sample))
    return judged.where("toxicity.predicted = 0").drop("toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.deduplicated(docs, **NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = wumanber.find_passages(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size("spans") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that each goes to; shards of nearly equal bytes."""
    return sharding.with_shards(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The learned scores of the first stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
