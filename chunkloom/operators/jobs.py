"""The job ledger as a roll-up of append-only events.

Event kinds: ``created`` (with total_files), ``status`` (with status and error_msg; the last by
seq wins), ``done`` and ``failed`` (``files`` files each, one if that is null or there is no such column).  A job without a created event is unknown.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def job_rollup(events: DataFrame) -> DataFrame:
    """Current state of every job.  Counting files does not move updated_at."""
    is_status = F.col("kind") == "status"
    stamp = F.when(is_status, F.col("seq"))
    created = F.col("kind") == "created"
    files = F.coalesce("files", F.lit(1)) if "files" in events.columns else F.lit(1)

    def counted(kind: str) -> Column:
        total = F.sum(F.when(F.col("kind") == kind, files))
        return F.coalesce(total, F.lit(0)).cast("long").alias(kind)

    return (
        events.groupBy("job_id", "workspace_id")
        .agg(
            F.coalesce(F.max_by("status", stamp), F.lit("queued")).alias("status"),
            F.coalesce(F.max("total_files"), F.lit(0)).cast("long").alias("total_files"),
            counted("done"),
            counted("failed"),
            F.coalesce(F.max_by("error_msg", stamp), F.lit("")).alias("error_msg"),
            F.min(F.when(created, F.col("ts"))).alias("created_at"),
            F.max(F.when(created | is_status, F.col("ts"))).alias("updated_at"),
        )
        .where("created_at IS NOT NULL")
    )


def get_job(events: DataFrame, job_id: str) -> DataFrame:
    """One job, or no row when the id is unknown."""
    return job_rollup(events.where(F.col("job_id") == job_id))
