"""Keyed and append-only parquet tables, written as deltas and merged when read.

A run adds a folder with its surviving upserts and one with its delete marks, and nothing else is rewritten: a change of
one per cent writes about one per cent of the bytes. A reader takes every key's newest row and drops rows
older than the last mark of their path. The lists that decide this come from the deltas alone; while they are
short they are broadcast and the large base is filtered in place. When the deltas outgrow ``share`` of the base, or are
more than ``MOST_DELTAS``, a compaction writes the merged table as the new base, so every byte is rewritten about
1/``share`` times over its life. Versions, atomic commits and repeated runs are in ``versions``.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom import schema
from chunkloom.operators import replay
from chunkloom.operators.dedup import PATH, null_safe
from chunkloom.sinks.scratch import Scratch
from chunkloom.sinks.versions import TableSet, run_folder

SHARE = 0.25
MOST_DELTAS = 32


def _order(log: DataFrame) -> list[str]:
    """Arrival order; the chunks of one file come in their order in the file."""
    return [c for c in ("seq", "chunk_no") if c in log.columns]


class Table:
    """Rows in folders named by runs. In a shared ``TableSet`` a run prepares, and the set commits all its tables."""

    name: str
    columns: T.StructType

    def __init__(self, spark: SparkSession, path: str, tables: TableSet | None = None):
        self.spark = spark
        self.tables = tables or TableSet(spark, path, shared=False)

    @classmethod
    def of(cls, tables: TableSet):
        """The table of this kind in a shared set."""
        return cls(tables.spark, tables.root, tables)

    def _folder(self, kind: str) -> str:
        return f"{self.tables.root}/{self.name}/{kind}"

    def _put(self, kind: str, df: DataFrame, folder: str) -> None:
        writer = df.write.mode("overwrite")
        if "workspace_id" in df.columns:
            writer = writer.partitionBy("workspace_id")
        writer.parquet(f"{self._folder(kind)}/run={folder}")

    def _get(self, kind: str, segments: list[dict], columns: T.StructType) -> DataFrame:
        """Rows of segments with the ``_version`` of each."""
        layout = T.StructType([*columns.fields, T.StructField("run", T.StringType())])
        if not segments:
            rows = self.spark.createDataFrame([], layout)
        else:
            paths = [f"{self._folder(kind)}/run={s['run']}" for s in segments]
            rows = self.spark.read.schema(layout).option("basePath", self._folder(kind)).parquet(*paths)
        version = F.lit(segments[0]["version"] if segments else 0)
        if len(segments) > 1:
            pairs = [F.lit(x) for s in segments for x in (s["run"], s["version"])]
            version = F.create_map(*pairs)[F.col("run")]
        return rows.select(*columns.names, version.cast("long").alias("_version"))

    def prepare(self, log: DataFrame, run_id: str, now: datetime) -> None:
        """Write the run's folders; a commit of the set makes them visible."""
        if not self.tables.has_run(self.name, run_id):
            self._prepare(self._named(log, run_id), run_folder(run_id), now)
            self.tables.prepared(run_id, self.name)

    def _named(self, log, run_id: str):
        return log

    def write(self, log: DataFrame, run_id: str, now: datetime) -> None:
        self.prepare(log, run_id, now)
        self.tables.commit(run_id)
        self.tidy()

    def tidy(self) -> None:
        """Work that is due after a commit."""


class KeyedTable(Table):
    key: list[str]

    def __init__(self, spark: SparkSession, path: str, tables: TableSet | None = None, share: float = SHARE):
        super().__init__(spark, path, tables)
        self.share = share

    def load(self, rows: DataFrame) -> None:
        """Replace the whole table by ``rows``, unique by key."""
        folder = run_folder(f"load-{self.tables._next()}")
        self._put("rows", rows.select(*self.columns.names), folder)
        self.tables.replace(self.name, folder)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the last version, or of ``version``."""
        segments = self.tables.segments(self.name, version)
        rows = self._get("rows", segments, self.columns)
        deltas = [s for s in segments if not s["base"]]
        if not deltas or len(segments) == 1:
            return rows.drop("_version")
        changed = self._get("rows", deltas, self.columns)
        newest = changed.groupBy(*self.key).agg(F.max("_version").alias("_newest"))
        path = T.StructType([f for f in schema.SNAPSHOT.fields if f.name in PATH])
        marks = self._get("marks", deltas, path).groupBy(*PATH).agg(F.max("_version").alias("_mark"))
        live = null_safe(rows, marks, PATH, "left").where("_mark IS NULL OR _version >= _mark")
        live = null_safe(live, newest, self.key, "left")
        return self._carried(live).select(*self.columns.names)

    def _carried(self, live: DataFrame) -> DataFrame:
        """The newest of the ``live`` rows of each key."""
        return live.where("_newest IS NULL OR _version = _newest")

    def _prepare(self, log: DataFrame, folder: str, now: datetime) -> None:
        with Scratch(self.spark) as scratch:
            rows, marks = self._changes(log, now, scratch.staged)
            self._put("rows", rows.select(*self.columns.names), folder)
            self._put("marks", marks.select(*PATH).distinct(), folder)

    def _changes(self, log: DataFrame, now: datetime, stage) -> tuple[DataFrame, DataFrame]:
        """Rows to store, unique by key, and the paths whose earlier rows go."""
        raise NotImplementedError

    def tidy(self) -> None:
        segments = self.tables.segments(self.name)
        base = [s["run"] for s in segments if s["base"]]
        deltas = [s["run"] for s in segments if not s["base"]]
        if len(deltas) <= 1 and not base:
            return
        size = self.tables.bytes_of(self.name, base)
        if len(deltas) > MOST_DELTAS or self.tables.bytes_of(self.name, deltas) > self.share * size > 0:
            self.compact()

    def compact(self) -> None:
        """Write the merged table as its new base; readers of older versions keep their folders until a vacuum."""
        folder = run_folder(f"base-{self.tables._next()}")
        self._put("rows", self.read(), folder)
        self.tables.replace(self.name, folder)


class SnapshotTable(KeyedTable):
    name = "snapshot"
    columns = schema.SNAPSHOT
    key = PATH

    def prepare(self, seen: DataFrame, deleted: DataFrame, run_id: str, now: datetime) -> None:
        """Upsert the hashes in ``seen`` and drop the paths in ``deleted``."""
        super().prepare((seen, deleted), run_id, now)

    def write(self, seen: DataFrame, deleted: DataFrame, run_id: str, now: datetime) -> None:
        self.prepare(seen, deleted, run_id, now)
        self.tables.commit(run_id)
        self.tidy()

    def _changes(self, log, now, stage):
        seen, deleted = log
        stamp = F.lit(now).cast("timestamp").alias("updated_at")
        return seen.select(*PATH, "content_hash", stamp), deleted


class ChunkTable(KeyedTable):
    name = "chunks"
    columns = schema.CHUNKS
    key = replay.CHUNK_KEY

    def _changes(self, log, now, stage):
        return replay.chunk_changes(log, F.lit(now).cast("timestamp"), _order(log), stage)

    def _carried(self, live: DataFrame) -> DataFrame:
        """An update keeps the time of creation that the rows before it have."""
        born = live.where("_newest IS NOT NULL AND created_at IS NOT NULL").groupBy(*self.key)
        newest = super()._carried(live)
        found = null_safe(newest, born.agg(F.max("created_at").alias("_born")), self.key, "left")
        return found.withColumn("created_at", F.coalesce("created_at", "_born"))


class PointTable(KeyedTable):
    name = "points"
    columns = schema.POINTS
    key = ["id"]

    def _changes(self, log, now, stage):
        return replay.point_changes(log, _order(log), stage)


class MemoryTable(Table):
    """Append-only rows: a run adds its folder once."""

    name = "memories"
    columns = schema.MEMORIES

    def __init__(self, spark: SparkSession, path: str, tables: TableSet | None = None, source: str = "chunkloom"):
        super().__init__(spark, path, tables)
        self.source = source

    def read(self, version: int | None = None) -> DataFrame:
        return self._get("rows", self.tables.segments(self.name, version), self.columns).drop("_version")

    def _prepare(self, log: DataFrame, folder: str, now: datetime) -> None:
        self._put("rows", replay.memories(log, self.source), folder)


class VersionTable(Table):
    """The versions of files that passed dedup: keys and hashes, append-only."""

    name = "versions"
    columns = schema.VERSIONS

    def read(self, version: int | None = None) -> DataFrame:
        return self._get("rows", self.tables.segments(self.name, version), self.columns).drop("_version")

    def _prepare(self, log: DataFrame, folder: str, now: datetime) -> None:
        self._put("rows", log.select(*self.columns.names), folder)


class QuarantineTable(Table):
    """What failed, by run: an append-only list of files with stage, kind of error and message."""

    name = "quarantine"
    columns = schema.QUARANTINE

    def read(self, version: int | None = None) -> DataFrame:
        return self._get("rows", self.tables.segments(self.name, version), self.columns).drop("_version")

    def _named(self, log: DataFrame, run_id: str) -> DataFrame:
        return log.withColumn("run_id", F.lit(run_id))

    def _prepare(self, log: DataFrame, folder: str, now: datetime) -> None:
        stamped = log.withColumn("seen_at", F.lit(now).cast("timestamp"))
        self._put("rows", stamped.select(*self.columns.names), folder)
