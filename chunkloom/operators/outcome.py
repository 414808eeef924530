"""Per-file quarantine, counters and error counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.text import record_id


def failed_rows(rows: DataFrame) -> DataFrame:
    """The quarantine: one row per failed record."""
    return rows.where("error IS NOT NULL").select(
        "workspace_id",
        "file_id",
        "path",
        "stage",
        F.regexp_extract("error", r"^(\w+)", 1).alias("error_type"),
        F.col("error").alias("message"),
    )


def unreadable_files(prints: DataFrame) -> DataFrame:
    """Quarantine rows of what a source could not read, or could not name."""
    return prints.where("error IS NOT NULL").select(
        "workspace_id",
        record_id(F.col("workspace_id"), F.col("path")).alias("file_id"),
        "path",
        F.lit("source").alias("stage"),
        F.regexp_extract("error", r"^(\w+)", 1).alias("error_type"),
        F.col("error").alias("message"),
    )


def good_rows(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows of the files without any error.

    Pass a staged ``quarantine``: while its list of files is small it is broadcast, and the
    rows are filtered without a shuffle.
    """
    failed = quarantine.select("file_id").distinct()
    return rows.join(failed, "file_id", "left_anti").drop("error", "stage")


def errors_by_stage(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("stage", "error_type").agg(F.count("*").alias("errors"))


def print_counts() -> dict[str, Column]:
    """Aggregates of a source's fingerprints."""
    return {
        "records_in": F.count(F.lit(1)),
        "unreadable": F.count("error"),
        "last_seq": F.coalesce(F.max("seq"), F.lit(0)),
    }


def row_counts() -> dict[str, Column]:
    """Aggregates of the fanned-out rows with ``error``.

    Each file that came through dedup has exactly one row with chunk_no 0, which counts files without a distinct.
    """
    deleted = (F.col("action") == "delete") & F.col("error").isNull()
    return {
        "rows": F.count(F.lit(1)),
        "files": F.count(F.when(F.col("chunk_no") == 0, 1)),
        "records_deleted": F.count(F.when(deleted, 1)),
        "records_failed": F.count("error"),
    }
