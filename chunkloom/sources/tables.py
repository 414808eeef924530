"""A DataFrame of records as a source."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.text import hash_content
from chunkloom.operators.dedup import null_safe


class TableSource:
    """Records that already are a table (columns of ``schema.RECORDS``, hash not needed).

    Only the action ``delete`` deletes; a missing action is an upsert.
    """

    name = "table"

    def __init__(self, records: DataFrame):
        present = {"action": "upsert", "symbol": "", "symbol_type": "", "content": ""}
        filled = records.fillna(present, subset=[c for c in present if c in records.columns])
        self.records = filled.withColumn("content_hash", hash_content(F.col("content")))

    def workspaces(self) -> DataFrame:
        return self.records.select("workspace_id").distinct()

    def fingerprints(self) -> DataFrame:
        return self.records.select(
            "workspace_id", "path", "seq", "action", "content_hash",
            F.lit(None).cast("string").alias("error"),
        )

    def fetch(self, keys: DataFrame) -> DataFrame:
        found = null_safe(self.records, keys, ["workspace_id", "path", "seq"], "left_semi")
        return found.withColumn("error", F.lit(None).cast("string"))

    def close(self) -> None:
        pass
