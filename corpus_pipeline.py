"""The corpus pipeline: toxicity filter, near-duplicate removal, decontamination, mixing and sharding, each over whole texts.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's docs.

Defined cases are those of the operators: a null or empty text is not toxic, is no copy, holds no item and has no words, so it stays once at
most; rows of one id count as one document for near duplicates; an empty table gives no rows; all columns are kept, those that
are named like a column of the last stage's give way there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import decontaminate, jaccard, mixing, sharding, toxicity
from stayflow.llm.common import cut, documents, held_out
from stayflow.llm.queries import SHARD_BITS, SHARD_BYTES, TOXIC


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold; the model learns from the labels of all documents' table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~held_out("doc_id", 4, 2))
    return toxicity.drop_toxic(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of at least 0.8 between sets of five words."""
    return jaccard.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources holds them (0, 1 or 2 times)."""
    return mixing.take_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns with the shard that each row belongs to."""
    return sharding.assign_shards(docs, SHARD_BYTES, SHARD_BITS, keep=docs.columns)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark), ("mixing", mix), ("sharding", shard)]

#: No SQL expresses the first stage; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
