"""Applying an ordered log of upserts and deletes to a keyed table.

A delete removes every symbol of its file that came before it; of the later upserts the last
one of each key survives.  A row without a number comes before all others, and before it a
delete without one.  Among upserts of one key and number the greatest content hash is the
last; of rows that agree in it too, one is taken.  Null key columns are keys like others.

The survivors are found on narrow rows: keys, order and nothing else.  `row_number() = 1` over
the key lets Spark keep one row per key in each map task before the shuffle
(WindowGroupLimit), so a key with many versions does not gather them in one task, and the
deletes are reduced to one row per file.  Only then are texts and vectors joined to them.
Tables pass ``stage`` to write the narrow results down first: their size is then known, and
while they are small the wide rows are filtered by a broadcast and not shuffled at all.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.functions.text import is_delete, metadata_json
from chunkloom.operators.dedup import PATH, null_safe

CHUNK_KEY = ["workspace_id", "path", "symbol"]


def last_deletes(log: DataFrame) -> DataFrame:
    return (
        log.where(is_delete(F.col("action")))
        .groupBy(*PATH)
        .agg(F.max("seq").alias("deleted_at"))
    )


Stage = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, name: str) -> DataFrame:
    """The stage that stages nothing."""
    return df


def _ties(log: DataFrame) -> list[str]:
    return [c for c in ("content_hash",) if c in log.columns]


def surviving_keys(
    log: DataFrame, deleted: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """Key, path, order and content hash of the last upsert per key that no later delete removes."""
    ranked = [*order, *_ties(log)]
    columns = list(dict.fromkeys([*key, *PATH, *ranked]))
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in ranked])
    latest = (
        log.where(~is_delete(F.col("action")))
        .select(*columns, F.row_number().over(newest).alias("_n"))
        .where("_n = 1")
        .drop("_n")
    )
    gone = deleted.select(*PATH, "deleted_at", F.lit(True).alias("_gone"))
    after = "_gone IS NULL OR seq > deleted_at OR (deleted_at IS NULL AND seq IS NOT NULL)"
    return null_safe(latest, gone, PATH, "left").where(after).select(*columns)


def chosen_rows(log: DataFrame, chosen: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The whole rows of the chosen upserts, one for each, with the columns ``chosen`` adds."""
    upserts = log.where(~is_delete(F.col("action")))
    joined = list(dict.fromkeys([*key, *order, *_ties(log)]))
    repeated = [c for c in PATH if c not in key]
    rows = null_safe(upserts, chosen.drop(*repeated), joined, "inner")
    rest = [F.to_json(c) if t.startswith("map") else F.col(c) for c, t in upserts.dtypes]
    one = Window.partitionBy(*key).orderBy(F.xxhash64(*rest))
    return rows.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")


def untouched_rows(
    base: DataFrame, deleted: DataFrame, upserts: DataFrame, key: list[str]
) -> DataFrame:
    """Rows of the stored table that neither a delete nor an upsert reaches."""
    kept = null_safe(base, deleted.select(*PATH), PATH, "left_anti")
    return null_safe(kept, upserts.select(*key), key, "left_anti")


def stored_vector(embedding: Column) -> Column:
    """An empty vector is stored as NULL."""
    return F.when(F.size(embedding) > 0, embedding)


def has_vector(embedding: Column) -> Column:
    return F.coalesce(F.size(embedding) > 0, F.lit(False))


# The fields of a point payload, in order; `file_path` is column `path`.
PAYLOAD_FIELDS = (
    "workspace_id", "file_path", "symbol", "symbol_type", "language", "content_hash", "content",
)


def _fields(names) -> list[Column]:
    return [F.col("path" if n == "file_path" else n).alias(n) for n in names]


def point_payload() -> Column:
    """The point's payload as JSON.  Metadata is not part of it."""
    return F.to_json(F.struct(*_fields(PAYLOAD_FIELDS)))


def memory_metadata(source: str) -> Column:
    return F.to_json(F.struct(*_fields(PAYLOAD_FIELDS[:-1]), F.lit(source).alias("source")))


def _chunk_rows(log: DataFrame, chosen: DataFrame, now: Column, order: list[str]) -> DataFrame:
    born = F.col("created_at") if "created_at" in chosen.columns else F.lit(None).cast("timestamp")
    return chosen_rows(log.drop("created_at"), chosen, CHUNK_KEY, order).select(
        *CHUNK_KEY,
        "symbol_type",
        "language",
        "content",
        "content_hash",
        stored_vector(F.col("embedding")).alias("embedding"),
        metadata_json(F.col("metadata")).alias("metadata"),
        born.alias("created_at"),
        now.alias("updated_at"),
    )


def chunk_changes(
    log: DataFrame, now: Column, order: list[str], stage: Stage = lazily
) -> tuple[DataFrame, DataFrame]:
    """``(rows to store, paths whose earlier rows go)`` for a chunk table, whatever it holds."""
    deleted = stage(last_deletes(log), "deletes")
    chosen = stage(surviving_keys(log, deleted, CHUNK_KEY, order), "chosen")
    return _chunk_rows(log, chosen, now, order), deleted


def merge_chunks(
    base: DataFrame, log: DataFrame, now: Column, order: list[str], stage: Stage = lazily
) -> tuple[DataFrame, DataFrame]:
    """``(rows to store, untouched rows)`` for the chunk table.

    An insert leaves created_at empty; an update keeps the stored value.
    """
    deleted = stage(last_deletes(log), "deletes")
    born = base.where("created_at IS NOT NULL").select(*CHUNK_KEY, "created_at")
    born = null_safe(born, deleted.select(*PATH), PATH, "left_anti")
    chosen = null_safe(surviving_keys(log, deleted, CHUNK_KEY, order), born, CHUNK_KEY, "left")
    chosen = stage(chosen, "chosen")
    fresh = _chunk_rows(log, chosen, now, order)
    return fresh, untouched_rows(base, deleted, chosen, CHUNK_KEY)


def _points(log: DataFrame, order: list[str], stage: Stage):
    """An upsert without a vector is no point and leaves an existing one alone."""
    relevant = log.where(is_delete(F.col("action")) | has_vector(F.col("embedding")))
    deleted = stage(last_deletes(relevant), "deletes")
    chosen = stage(surviving_keys(relevant, deleted, ["id"], order), "chosen")
    fresh = chosen_rows(relevant, chosen, ["id"], order).select(
        "id",
        *PATH,
        F.col("embedding").alias("vector"),
        point_payload().alias("payload"),
    )
    return fresh, deleted, chosen


def point_changes(
    log: DataFrame, order: list[str], stage: Stage = lazily
) -> tuple[DataFrame, DataFrame]:
    """``(rows to store, paths whose earlier rows go)`` for a point table, keyed by id."""
    fresh, deleted, _ = _points(log, order, stage)
    return fresh, deleted


def merge_points(
    base: DataFrame, log: DataFrame, order: list[str], stage: Stage = lazily
) -> tuple[DataFrame, DataFrame]:
    """``(rows to store, untouched rows)`` for the point table, keyed by id."""
    fresh, deleted, chosen = _points(log, order, stage)
    return fresh, untouched_rows(base, deleted, chosen, ["id"])


def memories(log: DataFrame, source: str) -> DataFrame:
    """Rows for the append-only table; deletes are skipped."""
    return log.where(~is_delete(F.col("action"))).select(
        "content", memory_metadata(source).alias("metadata")
    )
