"""From raw documents to shards of training text, in stages written to Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulselake.llm.decontamination import remove_contaminated
from pulselake.llm.hyperminhash import one_of_each
from pulselake.llm.mixing import mixed
from pulselake.llm.sharding import shard
from pulselake.llm.toxicity import without_toxic
from pulselake.session import shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is below 0.5."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: five-word shingles, similarity of 0.8 or more."""
    return one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a ten-word window of the benchmark."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in which no source has more than a third."""
    return mixed(docs, ceiling=1 / 3)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot."""
    return shard(docs, shards=24)


STAGES = [
    ("toxicity", toxicity),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: No SQL: a trained model and a hash decide. Tests hold the rows against the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = shared_dir(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
