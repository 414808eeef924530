"""The job ledger: an append-only event table and its roll-up.

Events are written in batches, one folder per batch. The batches of a run are named by its job and their place in it, so
a repeated run replaces what it wrote before and counts nothing twice.
"""

import hashlib
import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from chunkloom import schema
from chunkloom.operators.jobs import get_job, job_rollup


class JobLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _folder(self, batch: str) -> str:
        return f"{self.path}/events-{hashlib.sha256(batch.encode()).hexdigest()[:32]}"

    def _written(self, batch: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(batch) + "/_SUCCESS")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _put(self, job_id: str, workspace_id: str, events: list[dict], batch: str | None = None) -> None:
        """Write events as one file; a batch of the same name is replaced."""
        start, now = time.time_ns(), datetime.now(UTC)
        rows = [
            {"job_id": job_id, "workspace_id": workspace_id, "seq": start + n, "ts": now} | event
            for n, event in enumerate(events)
        ]
        table = self.spark.createDataFrame(
            [tuple(row.get(name) for name in schema.JOB_EVENTS.names) for row in rows], schema.JOB_EVENTS
        )
        table.coalesce(1).write.mode("overwrite").parquet(self._folder(batch or uuid.uuid4().hex))

    def events(self) -> DataFrame:
        files = self.spark.read.schema(schema.JOB_EVENTS).option("recursiveFileLookup", True)
        return files.parquet(self.path)

    def jobs(self) -> DataFrame:
        return job_rollup(self.events())

    def create(self, workspace_id: str, total_files: int = 0) -> str:
        job_id = uuid.uuid4().hex
        self._put(job_id, workspace_id, [{"kind": "created", "total_files": total_files}])
        return job_id

    def update_status(
        self, job_id: str, workspace_id: str, status: str, error_msg: str = ""
    ) -> None:
        self._put(job_id, workspace_id, [{"kind": "status", "status": status, "error_msg": error_msg}])

    def count_done(self, job_id: str, workspace_id: str, files: int = 1) -> None:
        self._put(job_id, workspace_id, [{"kind": "done", "files": files}])

    def count_failed(self, job_id: str, workspace_id: str, files: int = 1) -> None:
        self._put(job_id, workspace_id, [{"kind": "failed", "files": files}])

    def get(self, job_id: str) -> dict | None:
        row = get_job(self.events(), job_id).first()
        return row.asDict() if row else None

    def run(self, workspace_id: str, build: Callable, job_id: str | None = None) -> str:
        """Create a job, build a flow, run it, and record how it ended and how many files it took or failed.

        With the ``job_id`` of an earlier try the job is run again: its end replaces the one recorded before.
        """
        if not workspace_id:
            raise ValueError("workspace_id is required")
        job_id = job_id or uuid.uuid4().hex
        begin, end = f"begin:{job_id}", f"end:{job_id}"
        if not self._written(begin):
            start = [{"kind": "created", "total_files": 0}, {"kind": "status", "status": "running", "error_msg": ""}]
            self._put(job_id, workspace_id, start, begin)
        last = {"kind": "status", "status": "done", "error_msg": ""}
        try:
            stats = build().run(run_id=job_id)
        except Exception as e:
            stats = getattr(e, "stats", {})
            last |= {"status": "failed", "error_msg": str(e)}
        done, failed = stats.get("files_done", 0), stats.get("files_failed", 0)
        counts = [
            {"kind": "done", "files": done, "total_files": done + failed},
            {"kind": "failed", "files": failed},
        ]
        self._put(job_id, workspace_id, [*counts, last], end)
        return job_id
