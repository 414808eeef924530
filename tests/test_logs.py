"""Dedup and replay of random logs against plain loops; streams against batches."""

import random

import pytest
from pyspark.sql import functions as F

from chunkloom.operators.dedup import (
    _block_of,
    changed_files,
    drop_unchanged,
    hot_cuts,
    hot_paths,
    passing_versions,
)
from chunkloom.operators.replay import merge_chunks, merge_points
from chunkloom.plans.views import NOW, shape_events
from chunkloom.schema import CHUNKS, POINTS, SNAPSHOT
from chunkloom.sinks.tables import ChunkTable, MemoryTable, SnapshotTable, VersionTable
from chunkloom.sinks.versions import TableSet
from chunkloom.streaming.dedup import dedup_stream
from chunkloom.streaming.replay import replay_stream

LOG = "workspace_id string, path string, seq long, action string, content_hash string"


def random_log(seed, n=400, hot=0.4):
    """One path holds a large share of the log."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        path = "hot" if rng.random() < hot else f"p{rng.randrange(8)}"
        action = "delete" if rng.random() < 0.15 else "upsert"
        rows.append(("w" + str(seq % 2), path, seq, action, rng.choice("ABC")))
    return rows


def passing_loop(rows, stored, deletes_reset):
    memory, found = dict(stored), set()
    for ws, path, seq, action, digest in rows:
        key = (ws, path)
        if action == "delete":
            found.add((ws, path, seq))
            if deletes_reset:
                memory.pop(key, None)
        elif memory.get(key) != digest:
            found.add((ws, path, seq))
            memory[key] = digest
    return found


STORED = {("w0", "hot"): "A", ("w1", "p1"): "B", ("w0", "never"): "C"}


def snapshot(spark):
    rows = [(ws, path, digest, NOW) for (ws, path), digest in STORED.items()]
    return spark.createDataFrame(rows, SNAPSHOT)


@pytest.mark.parametrize("deletes_reset", [True, False])
@pytest.mark.parametrize("seq_block", [3, 50, 10_000])
def test_passing_equals_loop(spark, deletes_reset, seq_block):
    rows = random_log(seq_block)
    log = spark.createDataFrame(rows, LOG).repartition(5)
    options = {"deletes_reset": deletes_reset, "seq_block": seq_block}
    found = passing_versions(log, snapshot(spark), **options).collect()
    assert len(found) == len(set(found))
    wanted = passing_loop(rows, STORED, deletes_reset)
    assert {tuple(r) for r in found} == wanted
    narrow = drop_unchanged(log, snapshot(spark), **options)
    wide = drop_unchanged(log.withColumn("content", F.lit("t")), snapshot(spark), **options)
    assert {(r[0], r[1], r[2]) for r in narrow.collect()} == wanted
    assert {(r[0], r[1], r[2]) for r in wide.collect()} == wanted
    hot = hot_paths(log, seq_block)
    if seq_block == 50:
        assert {r.path for r in hot.collect()} == {"hot"}
    for cut in (hot, hot_cuts(log, hot, seq_block)):
        split = drop_unchanged(log, snapshot(spark), hot=cut, **options)
        assert {(r[0], r[1], r[2]) for r in split.collect()} == wanted


def test_passing_edges(spark):
    def run(*versions, stored=None, deletes_reset=True):
        rows = [
            ("w", "p", i, "delete" if v is None else "upsert", v) for i, v in enumerate(versions)
        ]
        known = spark.createDataFrame([("w", "p", stored, NOW)], SNAPSHOT) if stored else None
        log = spark.createDataFrame(rows, LOG)
        found = passing_versions(log, known, deletes_reset=deletes_reset).collect()
        return sorted(r.seq for r in found)

    assert run("A", "A") == [0]
    assert run("A", "B", "A") == [0, 1, 2]
    assert run("A", stored="A") == []
    assert run(None, "A", stored="A") == [0, 1]
    assert run(None, "A", stored="A", deletes_reset=False) == [0]
    assert run("A", None, "A") == [0, 1, 2]
    assert run("A", None, "A", deletes_reset=False) == [0, 1]


def test_changed_files(spark):
    scan = spark.createDataFrame(
        [("w0", "hot", 1, "upsert", "A"), ("w1", "hot", 1, "upsert", "A"),
         ("w1", "p1", 1, "upsert", "x"), ("w0", "gone", 1, "delete", None)],
        LOG,
    )
    found = {(r.workspace_id, r.path) for r in changed_files(scan, snapshot(spark)).collect()}
    assert found == {("w1", "hot"), ("w1", "p1"), ("w0", "gone")}


def random_chunks(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        path = "hot" if rng.random() < 0.4 else f"p{rng.randrange(6)}"
        action = "delete" if rng.random() < 0.1 else "upsert"
        symbol = f"s{rng.randrange(5)}"
        vector = [float(seq)] if rng.random() < 0.6 else []
        rows.append(
            (f"{path}#{symbol}", "w", path, symbol, "func", "go", f"c{seq}", f"h{seq}", vector,
             {"n": str(seq)}, action, seq)
        )
    return rows


LOG_ROWS = (
    "id string, workspace_id string, path string, symbol string, symbol_type string, "
    "language string, content string, content_hash string, embedding array<float>, "
    "metadata map<string,string>, action string, seq long"
)


def base_chunks(spark):
    rows = [
        ("w", path, symbol, "func", "go", "old", "old", None, "{}", NOW, NOW)
        for path in ("hot", "p1", "quiet")
        for symbol in ("s1", "s77")
    ]
    return spark.createDataFrame(rows, CHUNKS)


def test_replay_equals_loop(spark):
    rows = random_chunks(1)
    rows = [r for r in rows if not (r[2] == "p1" and r[10] == "delete")]
    table = {(r.path, r.symbol): ("old", True) for r in base_chunks(spark).collect()}
    for r in rows:
        path, symbol = r[2], r[3]
        if r[10] == "delete":
            table = {k: v for k, v in table.items() if k[0] != path}
        else:
            table[path, symbol] = (r[6], table.get((path, symbol), (None, False))[1])
    log = spark.createDataFrame(rows, LOG_ROWS).repartition(5)
    now = F.lit(NOW).cast("timestamp")
    fresh, kept = merge_chunks(base_chunks(spark), log, now, ["seq"])
    found = fresh.unionByName(kept).collect()
    assert len(found) == len(table)
    # created_at is kept by updates and stays empty on inserts.
    assert {(r.path, r.symbol): (r.content, r.created_at is not None) for r in found} == table
    assert all(r.metadata == f'{{"n":"{r.content[1:]}"}}' for r in found if r.content != "old")
    assert all(r.embedding is None or r.embedding for r in found)


def test_points_equal_loop(spark):
    rows = random_chunks(2)
    base = [(f"{p}#s1", "w", p, [0.5], "{}") for p in ("hot", "p1", "quiet")]
    table = {b[0]: (b[2], b[3]) for b in base}
    for r in rows:
        if r[10] == "delete":
            table = {k: v for k, v in table.items() if v[0] != r[2]}
        elif r[8]:
            table[r[0]] = (r[2], r[8])
    log = spark.createDataFrame(rows, LOG_ROWS).repartition(5)
    fresh, kept = merge_points(spark.createDataFrame(base, POINTS), log, ["seq"])
    found = {r.id: (r.path, r.vector) for r in fresh.unionByName(kept).collect()}
    assert found == table


def event_files(spark, path, parts=4):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    size = 1000 // parts
    for i in range(parts):
        part = events.where((F.col("event_id") >= i * size) & (F.col("event_id") < (i + 1) * size))
        part.coalesce(1).write.mode("append").parquet(path)
    return events


def streamed(spark, path, schema):
    return shape_events(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    )


def passed_rows(table):
    return sorted(map(tuple, table.read().select("workspace_id", "path", "seq").collect()))


@pytest.mark.parametrize("deletes_reset, seq_block", [(True, 20), (False, 1_000_000)])
def test_dedup_stream_equals_batch(spark, tmp_path, deletes_reset, seq_block):
    events = event_files(spark, str(tmp_path / "in"))
    log = shape_events(events)
    known = log.where("path = 'u5'").limit(1).select(
        "workspace_id", "path", "content_hash", F.lit(NOW).cast("timestamp").alias("updated_at")
    )
    tables = TableSet(spark, str(tmp_path / "tables"))
    passed, texts = VersionTable.of(tables), MemoryTable(spark, str(tmp_path / "texts"))

    def stream(sinks):
        return dedup_stream(
            streamed(spark, str(tmp_path / "in"), events.schema), tables, sinks, str(tmp_path / "cp"),
            snapshot=known, deletes_reset=deletes_reset, seq_block=seq_block, now=NOW,
        )

    class Broken:
        name = "broken"

        def write(self, log, run_id, now):
            if tables.version()["version"] > 2:
                raise OSError("no room")

    broken = stream([passed, Broken()])  # stops after the first batch, at a sink that had its rows
    with pytest.raises(Exception, match="no room"):
        broken.awaitTermination()
    query = stream([passed, texts])
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 3
    batch = passing_versions(log, known, deletes_reset=deletes_reset)
    assert passed_rows(passed) == sorted(map(tuple, batch.collect()))
    assert 0 < texts.read().count() < passed.read().where("action <> 'delete'").count()
    state = {r.path: r.content_hash for r in SnapshotTable.of(tables).read().collect()}
    wanted = {r.path: r.content_hash for r in known.collect()}
    for r in sorted(log.collect(), key=lambda r: r.seq):
        if r.action != "delete":
            wanted[r.path] = r.content_hash
        elif deletes_reset:
            wanted.pop(r.path, None)
    assert state == wanted


def test_dedup_stream_edges(spark, tmp_path):
    rows = [
        ("w", "p", 2, "upsert", "A"), ("w", "p", None, "upsert", "A"), (None, "p", 1, "upsert", "A"),
        ("w", None, 1, "upsert", "A"), ("v", "p", 1, None, "B"), ("v", "q", 1, "delete", None),
    ]
    spark.createDataFrame(rows, LOG).write.parquet(str(tmp_path / "in"))
    log = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    tables = TableSet(spark, str(tmp_path / "tables"))
    dedup_stream(log, tables, [VersionTable.of(tables)], str(tmp_path / "cp")).awaitTermination()
    found = {(r.workspace_id, r.path, r.seq) for r in VersionTable.of(tables).read().collect()}
    assert found == {("w", "p", None), ("v", "p", 1), ("v", "q", 1)}
    state = {(r.workspace_id, r.path, r.content_hash) for r in SnapshotTable.of(tables).read().collect()}
    assert state == {("w", "p", "A"), ("v", "p", "B")}


def test_replay_stream_equals_batch(spark, tmp_path):
    events = event_files(spark, str(tmp_path / "in"))
    stream_table = ChunkTable(spark, str(tmp_path / "stream"))
    replay_stream(
        streamed(spark, str(tmp_path / "in"), events.schema),
        [stream_table],
        str(tmp_path / "cp"),
        now=NOW,
    ).awaitTermination()
    batch_table = ChunkTable(spark, str(tmp_path / "batch"))
    batch_table.write(shape_events(events), "run", NOW)

    def content(table):
        return sorted(
            map(tuple, table.read().select("path", "symbol", "content", "metadata").collect())
        )

    assert content(stream_table) == content(batch_table)
    # A repeated batch changes nothing.
    before = content(batch_table)
    batch_table.write(shape_events(events), "run", NOW)
    assert content(batch_table) == before


def test_rows_without_action_or_number_are_kept(spark):
    log = spark.createDataFrame(
        [("w", "p", None, None, "a"), ("w", "p", 1, None, "a"), ("w", "p", 2, "upsert", "b"), ("w", "q", 1, None, "c")],
        "workspace_id string, path string, seq long, action string, content_hash string",
    )
    hot = spark.createDataFrame([("w", "p")], "workspace_id string, path string")
    for options in ({}, {"hot": hot, "seq_block": 1}):
        kept = drop_unchanged(log, **options).collect()
        assert sorted((r.path, r.seq is not None and r.seq) for r in kept) == [
            ("p", False), ("p", 2), ("q", 1),
        ]


def test_a_second_stream_appends_memories(spark, tmp_path):
    row = {
        "workspace_id": "w", "path": "p", "symbol": "s", "symbol_type": "t", "language": "go",
        "content": "c", "content_hash": "h", "seq": 1,
    }
    rows = spark.createDataFrame([row]).withColumn("action", F.lit(None).cast("string"))
    rows.write.parquet(str(tmp_path / "log"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "log"))

    class Broken:
        def write(self, log, run_id, now):
            raise RuntimeError("no room")

    table = MemoryTable(spark, str(tmp_path / "memories"))
    for n in range(2):
        replay_stream(source, [table], str(tmp_path / f"c{n}")).awaitTermination()
    assert table.read().count() == 2
    broken = replay_stream(source, [Broken(), table], str(tmp_path / "c2"))
    with pytest.raises(Exception, match="sinks failed"):
        broken.awaitTermination()
    assert table.read().count() == 3


def test_sparse_numbers_are_cut_into_even_blocks(spark):
    """One path, numbers of a clock with long pauses: no block holds more than twice its share."""
    n, block = 20_000, 500
    rows = spark.range(n).select(
        F.lit("w").alias("workspace_id"), F.lit("hot").alias("path"),
        (F.floor(F.col("id") / 100) * 10**15 + F.col("id") * 977).alias("seq"),
    )
    cuts = hot_cuts(rows, hot_paths(rows, block), block)
    placed = rows.join(cuts, ["workspace_id", "path"]).select("seq", _block_of(F.col("seq"), F.col("cuts")).alias("b"))
    sizes = [r["count"] for r in placed.groupBy("b").count().collect()]
    assert len(sizes) >= n // block * 0.9 and max(sizes) <= 2 * block
    ends = placed.groupBy("b").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("b").collect()
    assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))
