"""Training-data pipeline over the table of documents.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written and read again as the next one's docs. All but
the last return the columns of documents; the last returns one row per copy that the mix takes, with its shard.

Stages work on whole tables and texts. Empty input gives an empty result at
every stage; nulls, repeated rows and extra columns follow the operators'
docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardlake.llm.decontaminate import drop_contaminated
from hazardlake.llm.mixing import training_order
from hazardlake.llm.near_dedup import keep_one
from hazardlake.llm.quality_rules import keep_good
from hazardlake.llm.sharding import shard_documents
from hazardlake.llm.staging import stage
from hazardlake.plans.tables import load


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the certified quality rules do not reject."""
    return keep_good(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return training_order(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every copy."""
    return shard_documents(docs)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

#: MinHash, bounds and label propagation are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
