"""What the physical plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from chunkloom.operators.dedup import passing_versions
from chunkloom.operators.replay import last_deletes, surviving_keys
from chunkloom.operators.snapshot import load_snapshot
from chunkloom.plans import views
from chunkloom.plans.catalog import QUERIES
from chunkloom.sinks.tables import SnapshotTable

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NATIVE = [
    "workspace_index", "relative_path", "ext_filter", "content_hash", "dedup_snapshot",
    "dedup_with_deletes", "snapshot_upsert", "tombstones", "markdown_sections", "go_symbols",
    "python_symbols", "fanout_mixed", "log_replay", "vector_points", "memory_append",
    "embed_chunks", "job_rollup",
]


@pytest.mark.parametrize("key", NATIVE)
def test_no_python_worker_and_no_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SF))
    for word in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("key", ["markdown_sections", "go_symbols", "python_symbols"])
def test_chunking_does_not_shuffle(spark, key):
    text = plan(QUERIES[key](spark, SF))
    # The one exchange spreads the single small input file over the cores.
    assert text.count("Exchange") == text.count("Exchange RoundRobinPartitioning") <= 1
    assert "Window" not in text and "Aggregate" not in text


def test_only_used_columns_are_read(spark):
    text = plan(QUERIES["content_hash"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_replay_keeps_one_row_per_key_before_the_shuffle(spark):
    log = views.change_log(spark, SF)
    text = plan(surviving_keys(log, last_deletes(log), ["path", "symbol"], ["seq"]))
    assert "content#" not in text and "embedding#" not in text
    assert "row_number(), 1, Partial" in text
    assert "partial_max" in text


def test_dedup_shuffles_blocks_once_and_no_text(spark):
    log = views.change_log(spark, SF)
    df = passing_versions(log, views.event_snapshot(spark, SF))
    text = plan(df)
    assert "content#" not in text
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_reading_merges_deltas_without_shuffling_the_base(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "s"), share=9)
    log = views.change_log(spark, SF)
    hashes = log.groupBy("workspace_id", "path").agg(F.max("content_hash").alias("content_hash"))
    table.load(hashes.withColumn("updated_at", F.lit(views.NOW).cast("timestamp")))
    table.write(hashes.limit(1), hashes.where("false"), "run", views.NOW)
    text = plan(table.read())
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    loaded = plan(load_snapshot(table.read(), "w"))
    assert "isnotnull(workspace_id" in loaded.split("PartitionFilters: [")[1].split("]")[0]
