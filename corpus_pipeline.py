"""The corpus pipeline: documents in, a mixed training set out. Every stage calls one operator.

Stages take and return the columns of documents, whatever others they have; the last adds ``copy``. Near
duplicates are judged on shingles of five words at a similarity of 0.8, the operator's defaults.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chunkloom.llm.decontaminate import drop_contaminated
from chunkloom.llm.minhash import drop_near_duplicates
from chunkloom.llm.mixing import mixed
from chunkloom.llm.stage import Stage
from chunkloom.llm.suffix_array import trim_repeats
from chunkloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group stays."""
    return drop_near_duplicates(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more go from every text but the first that has them."""
    return trim_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, with the number of the copy."""
    return mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
ORACLE_SQL = None  # the toxicity stage is a fitted model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = Stage(spark)
    for name, step in STAGES:
        before, docs = docs, stage.table(step(spark, docs, sf_dir), name)
        stage.drop(before)
    return docs
