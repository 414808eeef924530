"""The path -> content hash snapshot as a table."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.operators.dedup import PATH


def load_snapshot(snapshot: DataFrame, workspace_id: str) -> DataFrame:
    """One workspace's path and hash; prunes partitions when stored by workspace."""
    return snapshot.where(F.col("workspace_id") == workspace_id).select("path", "content_hash")


def upsert_snapshot(snapshot: DataFrame, seen: DataFrame, now: datetime) -> DataFrame:
    """Replace the hash of the paths in ``seen`` (unique by path); keep all other paths."""
    fresh = seen.select(*PATH, "content_hash", F.lit(now).cast("timestamp").alias("updated_at"))
    kept = snapshot.join(fresh.select(*PATH), PATH, "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def delete_from_snapshot(snapshot: DataFrame, deleted: DataFrame) -> DataFrame:
    return snapshot.join(deleted.select(*PATH).distinct(), PATH, "left_anti")


def tombstones(snapshot: DataFrame, scan: DataFrame) -> DataFrame:
    """A delete record for every known path that the complete ``scan`` no longer has."""
    return (
        snapshot.select(*PATH)
        .join(scan.select(*PATH), PATH, "left_anti")
        .select(*PATH, F.lit("delete").alias("action"))
    )
