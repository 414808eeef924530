"""Tables written between the steps of an operator, below the folder the cluster shares."""

import atexit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.sinks.scratch import new_dir, remove

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_left: dict[str, SparkSession] = {}


class Stage:
    """Steps of one operator call.

    ``table`` writes a step and reads it back, which cuts the lineage, survives lost executors and
    lets Spark drop the step's shuffle files at once. ``drop`` removes tables that no later step
    reads; what the returned frame still reads goes when the program ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = new_dir(self.spark, name)
        before = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEAN)
            else:
                self.spark.conf.set(_CLEAN, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        _left[path] = self.spark
        return back

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = self._paths.pop(id(df), None)
            if path:
                remove(self.spark, path)
                _left.pop(path, None)


@atexit.register
def _sweep() -> None:
    for path, spark in _left.items():
        if spark._sc is not None and spark._sc._jsc is not None:
            remove(spark, path)


def keyed(docs: DataFrame, id_col: str, text_col: str, keep_row: bool = False) -> DataFrame:
    """Columns ``id``, ``h`` (hash of the text), ``text``, and the whole row if it is needed later.

    ``(id, h)`` names a row: rows that repeat both are alike in every result. A null text is empty.
    Other columns travel inside one struct, so their names cannot clash with an operator's own.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = [F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")]
    if keep_row:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return docs.select(*columns)


def same_row(left: DataFrame, right: DataFrame):
    """Join condition on (id, h); null ids meet null ids."""
    return left["id"].eqNullSafe(right["id"]) & (left["h"] == right["h"])


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose (id, h) is not in ``gone``, with all their columns."""
    rows = keyed(docs, id_col, text_col, keep_row=True)
    return rows.join(gone, same_row(rows, gone), "left_anti").select("row.*")
