"""The training-data pipeline: quality rules, near-duplicate removal, decontamination, mixing and sharding of documents.

Each stage works on all its predecessor kept and is written before the next one reads it. Stage by stage the text is null,
empty or repeated as the operators define it; no stage needs more than the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gustline.llm.decontaminate import keep_clean
from gustline.llm.mixing import mixed
from gustline.llm.near_join import keep_one
from gustline.llm.quality_rules import keep_good
from gustline.llm.sharding import interleaved
from gustline.session import write_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return interleaved(docs)


STAGES = [("quality_rules", quality), ("near_join", near), ("decontaminate", clean), ("mixing", mix), ("sharding", shard)]
#: The verdicts of several stages (binomial bounds, shingle sets, templates) have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after all stages, with shard and slot."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = spark.read.parquet(write_stage(stage(spark, docs, sf_dir), name))
    return docs
