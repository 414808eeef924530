"""Scratch folders for staged tables, in the folder the cluster shares."""

import tempfile
import uuid

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; one of our own only where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="chunkloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/chunkloom/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables staged during one piece of work, removed at its end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to the shared folder and read it back.

        This cuts the lineage, and unlike cached blocks it survives a lost executor.
        """
        path = new_dir(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self, df: DataFrame, name: str, counts: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict]]:
        """As ``staged``, with aggregates of the rows taken while they are written, so without a job of their own.

        They are observed directly below the write, whose tasks count once however often they are tried.
        """
        seen = Observation()
        table = self.staged(df.observe(seen, *[value.alias(key) for key, value in counts.items()]), name)
        return table, lambda: seen.get
