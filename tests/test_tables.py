"""Delta tables: merged reads, one version for all tables, repeated and broken runs, nulls and ties."""

import os
import random

import pytest
from pyspark.sql import functions as F

from chunkloom import Flow
from chunkloom.operators.fanout import fan_out
from chunkloom.sinks.tables import ChunkTable, MemoryTable, PointTable, SnapshotTable
from chunkloom.sinks.versions import TableSet, Writer
from chunkloom.sources.tables import TableSource
from tests.test_flow import versions
from tests.test_logs import LOG_ROWS, NOW, base_chunks, random_chunks


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG_ROWS)


@pytest.mark.parametrize("share", [0.01, 100])
def test_many_runs_equal_a_loop(spark, tmp_path, share):
    rows = random_chunks(3, 200)
    table = {(r.path, r.symbol): ("old", True) for r in base_chunks(spark).collect()}
    chunks = ChunkTable(spark, str(tmp_path / "chunks"), share=share)
    chunks.load(base_chunks(spark))
    before = chunks.read().count()
    for i in range(0, len(rows), 50):
        chunks.write(frame(spark, rows[i : i + 50]), f"run {i}", NOW)
        for r in rows[i : i + 50]:
            if r[10] == "delete":
                table = {k: v for k, v in table.items() if k[0] != r[2]}
            else:
                table[r[2], r[3]] = (r[6], table.get((r[2], r[3]), (None, False))[1])
        found = {(r.path, r.symbol): (r.content, r.created_at is not None) for r in chunks.read().collect()}
        assert found == table
    assert chunks.read(version=1).count() == before  # an older version is still there
    assert len(chunks.tables.segments("chunks")) == (1 if share < 1 else 5)
    chunks.compact()
    assert chunks.tables.vacuum(keep=1) >= 1
    assert {(r.path, r.symbol): (r.content, r.created_at is not None) for r in chunks.read().collect()} == table


def test_a_small_change_writes_little(spark, tmp_path):
    rng = random.Random(1)
    text = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400))
    rows = [(f"p{i}#s", "w", f"p{i}", "s", "func", "go", text(), f"h{i}", [0.5], {}, "upsert", i) for i in range(4000)]
    path = str(tmp_path / "chunks")
    chunks = ChunkTable(spark, path)
    chunks.write(frame(spark, rows).coalesce(2), "all", NOW)
    whole = size_of(path)
    changed = [(*r[:6], text(), f"x{r[7]}", *r[8:]) for r in rows[::100]]
    chunks.write(frame(spark, changed).coalesce(2), "few", NOW)
    assert size_of(path) - whole < 0.03 * whole
    assert chunks.read().count() == 4000 and chunks.read().where("content_hash LIKE 'x%'").count() == 40


def test_null_numbers_and_ties(spark, tmp_path):
    row = lambda path, symbol, content, h, seq, action="upsert", n="1": (
        f"{path}#{symbol}", "w", path, symbol, "func", "go", content, h, [1.0], {"n": n}, action, seq,
    )
    log = [row(f"p{i}", "s", "t", "h", None) for i in range(45)]  # nothing has a number
    log += [row("tie", "s", f"c{i % 9}", f"h{i % 9}", 5, n=str(i)) for i in range(200)]  # all have the same one
    log += [row("gone", "s", "t", "h", None), row("gone", "", "", "", None, "delete")]
    log += [row("back", "", "", "", None, "delete"), row("back", "s", "t", "h", 0)]
    log += [row(None, "s", "t", "h", 1), row("none", None, "t", "h", 1), row("none", None, "u", "i", 2)]
    for cls, key in ((ChunkTable, lambda r: (r.path, r.symbol)), (PointTable, lambda r: (r.path, r.id))):
        table = cls(spark, str(tmp_path / cls.name))
        table.write(frame(spark, log).repartition(4), "run", NOW)
        found = [key(r) for r in table.read().collect()]
        assert len(found) == len(set(found))
        assert {p for p, _ in found} == {*(f"p{i}" for i in range(45)), "tie", "back", None, "none"}
    chunks = ChunkTable(spark, str(tmp_path / "chunks")).read()
    assert chunks.where("path = 'tie'").first().content == "c8"
    assert chunks.where("path = 'none'").first().content == "u"


class Dies(Exception):
    pass


def test_a_run_is_seen_as_a_whole(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    chunks, points, memories = (c.of(tables) for c in (ChunkTable, PointTable, MemoryTable))
    sinks = [chunks, points, memories]
    count = lambda: [s.read().count() for s in sinks]
    first = frame(spark, [r for r in random_chunks(4, 60) if r[10] != "delete"])
    writer = Writer("one", NOW)
    for sink in sinks:
        writer.put(sink, first)
    assert count() == [0, 0, 0]  # prepared, not committed
    writer.commit()
    seen = count()
    assert all(seen)

    second = frame(spark, [("q#s", "w", "q", "s", "func", "go", "t", "h", [1.0], {}, "upsert", 1)])
    killed = Writer("two", NOW)
    killed.put(chunks, second)
    killed.put(points, second)  # and here the process ends
    again = TableSet(spark, str(tmp_path / "set"))
    assert [c.of(again).read().count() for c in (ChunkTable, PointTable, MemoryTable)] == seen
    for _ in range(2):  # the second time it adds nothing
        rerun = Writer("two", NOW)
        for cls in (ChunkTable, PointTable, MemoryTable):
            rerun.put(cls.of(again), second)
        rerun.commit()
        assert count() == [n + 1 for n in seen]
    assert tables.version()["version"] == 2 and chunks.read(version=1).count() == seen[0]

    # a manifest that was cut short is no version
    with open(tmp_path / "set" / "_versions" / f"{3:020d}.json", "w") as f:
        f.write('{"version": 3, "tab')
    assert tables.version()["version"] == 2 and count() == [n + 1 for n in seen]


def test_a_flow_that_fails_leaves_its_set_alone(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    chunks, memories, snapshot = ChunkTable.of(tables), MemoryTable.of(tables), SnapshotTable.of(tables)

    class Failing(MemoryTable):
        broken = True

        def _prepare(self, log, folder, now):
            super()._prepare(log, folder, now)
            if Failing.broken:
                raise Dies("between sinks")

    rows = versions(
        spark,
        {"path": "a", "id": "a", "language": "text", "content": "1", "seq": None},
        {"path": None, "id": "b", "language": "text", "content": "2", "seq": 1},
    )
    flow = Flow("f").source(TableSource(rows)).dedup(snapshot).transform("fan_out", fan_out)
    flow.sink(chunks).sink(Failing.of(tables))
    with pytest.raises(ExceptionGroup):
        flow.run("r", NOW)
    assert tables.version()["version"] == 0 and chunks.read().count() == 0
    Failing.broken = False
    stats = flow.run("r", NOW)
    assert stats["errors_by_stage"] == {"source:MissingKey": 1} and stats["records_failed"] == 1
    assert tables.version()["version"] == 1
    assert [t.read().count() for t in (chunks, memories, snapshot)] == [1, 1, 1]
