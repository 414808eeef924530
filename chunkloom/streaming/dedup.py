"""Dedup of an endless change log: the last hash of every path is a versioned table.

Each micro-batch is compared with the table by ``operators.dedup.passing_versions``, hot paths cut into blocks, and
adds what it changed. The new state and what passed are committed in one version, named by the query's id and the batch: a
batch that died is repeated against the state before it, and one that is in already adds nothing.

A batch scans the narrow state of its workspaces, so let triggers bring many rows. Rows without workspace or path do not
pass; a row without a number comes before the others of its path in the batch.
"""

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunkloom.operators.dedup import PATH, SEQ_BLOCK, hot_cuts, hot_paths, null_safe, passing_versions
from chunkloom.sinks.scratch import Scratch
from chunkloom.sinks.tables import SnapshotTable
from chunkloom.sinks.versions import TableSet, Writer

_NARROW = ["workspace_id", "path", "seq", "action", "content_hash"]


def last_states(passing: DataFrame) -> DataFrame:
    """``hash`` of the last passing row of each path, null after a delete; what did not pass changes nothing."""
    deleted = F.col("action").eqNullSafe("delete")
    order = F.struct(F.col("seq").isNotNull(), "seq")
    return passing.groupBy(*PATH).agg(
        F.max_by(F.when(~deleted, F.col("content_hash")), order).alias("hash")
    )


def dedup_stream(
    log: DataFrame,
    tables: TableSet,
    sinks: list,
    checkpoint: str,
    *,
    snapshot: DataFrame | None = None,
    deletes_reset: bool = True,
    seq_block: int = SEQ_BLOCK,
    now: datetime | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start writing the rows of ``log`` that pass, with all their columns, to every sink.

    The state is the snapshot table of ``tables``; ``snapshot`` is its content where it has none yet. Sinks in the
    same set are committed with the state. Others are written before it, and again if the
    batch is repeated. ``trigger`` defaults to all available input.
    """
    state = SnapshotTable.of(tables)
    if snapshot is not None and not tables.segments(state.name):
        state.load(snapshot)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = f"{stream}-{batch_id}"
        if tables.has_run(state.name, run_id):
            return
        writer = Writer(run_id, now or datetime.now(UTC))
        with Scratch(tables.spark) as scratch:
            staged = scratch.staged
            rows = staged(batch.select(*_NARROW), "batch")
            here = staged(rows.select("workspace_id").distinct(), "workspaces")
            known = state.read().join(here.where("workspace_id >= ''"), "workspace_id", "left_semi")
            hot = staged(hot_paths(rows, seq_block), "hot")
            hot = staged(hot_cuts(rows, hot, seq_block), "cuts")
            passing = passing_versions(
                rows, known, hot=hot, carry=("action", "content_hash"),
                deletes_reset=deletes_reset, seq_block=seq_block,
            )
            passing = staged(passing, "passing")
            last = last_states(passing if deletes_reset else passing.where("NOT action <=> 'delete'"))
            last = staged(last, "last")
            out = passing
            if set(batch.columns) != set(_NARROW):
                out = null_safe(batch, passing.select(*PATH, "seq"), [*PATH, "seq"], "left_semi")
            for sink in sinks:
                writer.put(sink, out)
            seen = last.where("hash IS NOT NULL").withColumnRenamed("hash", "content_hash")
            writer.put(state, seen, last.where("hash IS NULL").select(*PATH))
            writer.commit()
        for table in [*sinks, state]:
            getattr(table, "tidy", lambda: None)()

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
