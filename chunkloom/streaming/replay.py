"""Applying an endless change log to keyed tables, one merge per micro-batch.

Replaying a micro-batch a second time gives the same tables, so a retried batch is harmless. A run
is named by the query's id, which lives in the checkpoint, and the batch: another stream, or the same
one with a new checkpoint, never overwrites what an earlier one appended.
"""

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chunkloom.sinks.versions import Writer


def replay_stream(
    log: DataFrame,
    sinks: list,
    checkpoint: str,
    *,
    now: datetime | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start writing ``log`` to every sink; ``trigger`` defaults to all available input."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        writer, failed = Writer(f"{stream}-{batch_id}", now or datetime.now(UTC)), []
        batch.persist()
        try:
            for sink in sinks:
                try:
                    writer.put(sink, batch)
                except Exception as error:
                    failed.append(error)
            writer.commit()
            for sink in sinks:
                getattr(sink, "tidy", lambda: None)()
        finally:
            batch.unpersist()
        if failed:
            # every sink had its turn; the batch fails and is retried as a whole
            raise ExceptionGroup(f"{len(failed)} of {len(sinks)} sinks failed", failed)

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
