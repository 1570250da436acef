"""A training corpus from `documents`: filtered, deduplicated, decontaminated, mixed, sharded.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet to the
shared folder and read again as the next stage's documents. All but the last return rows
with the columns of `documents`; the last returns each row's place in the shards.

Cases: null, empty and wordless texts fail the quality rules; a null source is a host and a source
of its own. Of repeated rows one stays after the second stage, which also keeps one row of each id;
rows without an id are judged by their texts. Extra columns are carried along, whatever their names.
The first stage takes frequent lines out of the texts, and leaves the other columns (n_chars too) as
they were. An empty table gives an empty result, and an empty benchmark finds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowlab.llm import decontaminate, jaccard_join, mixing, quality_rules, sharding
from flowlab.llm.common import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that too many of their host have."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group joined by 80 % alike sets of 5-word shingles."""
    return jaccard_join.keep_one(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them, in the order of its slots."""
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

# Edit distances and the keyed permutation are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    folder = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
