"""Sources, flows, tables, embedders and the job ledger end to end."""

import hashlib
import os

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyarrow.fs import LocalFileSystem
from pyspark.sql import functions as F

from chunkloom import Flow, build_flow
from chunkloom.functions.text import (
    WHITE_SPACE,
    allowed,
    extension,
    in_hidden_dir,
    language_of,
    relative_key,
    trim_space,
)
from chunkloom.operators.embed import OUTAGE, embed_by_hashing, embed_with_model, embedder
from chunkloom.operators.fanout import fan_out
from chunkloom.operators.snapshot import tombstones
from chunkloom.schema import SNAPSHOT
from chunkloom.sinks.ledger import JobLedger
from chunkloom.sinks.tables import ChunkTable, MemoryTable, PointTable, QuarantineTable, SnapshotTable
from chunkloom.sources.files import FileSource, azure_source, local_source, s3_source
from chunkloom.sources.listing import FileStore, KeyStore, LocalStore, Wanted, list_files, middle
from chunkloom.sources.tables import TableSource
from tests.test_chunks import RECORDS, record
from tests.test_logs import NOW


def put(root, files):
    for path, data in files.items():
        full = os.path.join(root, path)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(data)


TREE = {
    "pkg/__init__.py": b"def a():\n    pass\n",
    "_priv/b.go": b"package p\nfunc X() {}\nfunc Y() {}\n",
    ".eslintrc.js": b"x",
    ".git/h.py": b"no",
    "a/.hid/deep/h.py": b"no",
    "D.GO": b"package",
    "README": b"z",
    "n.txt": b"z",
    "bad.md": b"# \xff\nh\xe9llo\n",
    "m/n/o.mdx": b"hi",
    "empty.md": b"",
}
VISIBLE = {
    "pkg/__init__.py", "_priv/b.go", ".eslintrc.js", "D.GO", "bad.md", "m/n/o.mdx", "empty.md",
}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / ".tree"  # a hidden root is visible all the same
    put(root, TREE)
    return str(root)


def test_local_scan(spark, tree):
    source = local_source(spark, "w", tree, seq=3)
    prints = source.fingerprints()
    rows = {r.path: r for r in source.fetch(prints).collect()}
    assert set(rows) == VISIBLE
    for path, r in rows.items():
        assert r.content_hash == hashlib.sha256(TREE[path]).hexdigest()
        assert r.id == hashlib.sha256(f"w:{path}".encode()).hexdigest()
        assert (r.metadata, r.action, r.seq, r.error) == ({}, "upsert", 3, None)
    hashes = source.fetch(prints).select("path", F.sha2("content", 256)).collect()
    assert {p: h for p, h in hashes} == {p: r.content_hash for p, r in rows.items()}
    assert rows["D.GO"].language == "go" and rows[".eslintrc.js"].language == "javascript"
    only = local_source(spark, "w", tree, extensions={".TXT"}).fingerprints()
    assert [r.path for r in only.collect()] == ["n.txt"]


def test_missing_root(spark, tmp_path):
    with pytest.raises(NotADirectoryError):
        local_source(spark, "w", str(tmp_path / "nothing"))


def test_object_scan(spark, tmp_path):
    put(tmp_path, {f"b1/{k}": b"t" for k in (
        "src/a.go", "src/.git/c.py", "src2/x.go", "src/sub/D.MD", "other/e.go", "src/noext")})
    bucket = str(tmp_path / "b1")
    found = {}
    for name, make in {
        "s3": lambda p: s3_source(spark, "w", bucket, p, make_filesystem=LocalFileSystem),
        "az": lambda p: azure_source(
            spark, "w", "acc", "key", bucket, p, make_filesystem=LocalFileSystem
        ),
    }.items():
        source = make("src")
        found[name] = {r.path: r for r in source.fetch(source.fingerprints()).collect()}
        assert set(found[name]) == {"a.go", ".git/c.py", "2/x.go", "sub/D.MD"}
    assert found["s3"]["2/x.go"].metadata == {"s3_key": "src2/x.go", "bucket": bucket}
    assert found["az"]["a.go"].metadata == {"blob_name": "src/a.go", "container": bucket}
    deep = s3_source(spark, "w", bucket, "src/sub/", make_filesystem=LocalFileSystem)
    assert [r.path for r in deep.fingerprints().collect()] == ["D.MD"]
    listed = spark.createDataFrame(
        [("src/a.go", 1), ("src/lost.go", 1), ("other/e.go", 1), ("src/noext", 1)],
        "key string, size long",
    )
    given = s3_source(
        spark, "w", bucket, "src/", make_filesystem=LocalFileSystem, inventory=listed
    )
    rows = {r.path: r.error for r in given.fingerprints().collect()}
    assert set(rows) == {"a.go", "lost.go"} and rows["a.go"] is None
    assert rows["lost.go"].startswith("FileNotFoundError")


class FailingStore(FileStore):
    def open(self):
        def entries(key):
            if key == "":
                return [(True, "d", 0), (False, "a.go", 1)]
            raise PermissionError("no listing")

        return entries, lambda key: b""


def test_failed_listing_fails_the_job(spark):
    with pytest.raises(Exception, match="no listing"):
        FileSource(spark, "w", FailingStore()).entries()


def test_text_above_the_limit_is_quarantined_with_its_path(spark, tree, tmp_path):
    def run(largest, name):
        source = FileSource(spark, "w", LocalStore(tree), largest=largest)
        hashes = {r.path: (r.content_hash, r.error) for r in source.fingerprints().collect()}
        assert hashes == {p: (hashlib.sha256(TREE[p]).hexdigest(), None) for p in VISIBLE}
        flow = Flow("f").source(source).transform("f", fan_out)
        return flow.dedup(t.snapshot).quarantine(errors).sink(t.chunks).run(run_id=name)

    t, errors = Tables(spark, str(tmp_path / "t")), QuarantineTable(spark, str(tmp_path / "e"))
    stats = run(20, "small")
    large = {p for p in VISIBLE if len(TREE[p]) > 20}
    assert {(r.path, r.stage, r.error_type) for r in errors.read().collect()} == {
        (p, "source", "FileTooLarge") for p in large
    }
    assert stats["records_failed"] == len(large) > 0
    # not remembered, so that a run with room for them takes just these
    again = run(1 << 20, "large")
    assert again["records_skipped"] == len(VISIBLE) - len(large) and again["records_failed"] == 0


KEYS = [f"src/{w}/{n:03d}{e}" for w in ("a", "b", "b~", "é") for n in range(40) for e in (".go", ".txt")]
KEYS += ["src/.git/x.py", "srd/y.go", "a.go", "zz/q.go", "src/a/000.go/inner.MD"]


class Bucket:
    """Keys in order, handed out in pages of three; notes what it handed out."""

    def __init__(self, log):
        self.log = log

    def __call__(self):
        def page(prefix, after):
            found = sorted(k for k in KEYS if k.startswith(prefix) and k > after)
            with open(self.log, "a") as f:
                f.writelines(f"{k}\n" for k in [f"? {prefix} {after}", *found[:3]])
            return [(k, 1) for k in found[:3]], len(found) > 3

        return page


@pytest.mark.parametrize("prefix, calls", [("", 20), ("src", 1000), ("src/b", 1000), ("src/é/0", 10), ("none", 1)])
def test_key_ranges_list_every_key_once(spark, tmp_path, prefix, calls):
    log = str(tmp_path / "log")
    store = KeyStore("b", LocalFileSystem, Bucket(log))
    files, _ = list_files(spark, store, Wanted(prefix, frozenset({".go", ".md"})), calls, 40)
    wanted = [k for k in KEYS if k.startswith(prefix) and k.lower().endswith((".go", ".md"))]
    assert sorted(r.key for r in files.collect()) == sorted(wanted)
    with open(log) as f:
        lines = f.read().splitlines()
    handed = [k for k in lines if not k.startswith("? ")]
    asked = len(lines) - len(handed)
    matching = sum(k.startswith(prefix) for k in KEYS)
    assert all(k.startswith(prefix) for k in handed)
    assert asked <= 2 * (matching // 3 + 2)


def test_source_by_key_ranges(spark, tmp_path):
    put(tmp_path, {f"b/{k}": b"t" for k in KEYS[:9] + ["src2/x.go"] if k.endswith(".go")})
    pages = Bucket(str(tmp_path / "log"))
    bucket = str(tmp_path / "b")
    source = s3_source(spark, "w", bucket, "src/a/", [".go"], 1, LocalFileSystem, make_pages=pages)
    rows = {r.path: r.error for r in source.fingerprints().collect()}
    assert set(rows) == {f"{n:03d}.go" for n in range(40)}
    assert sorted(p for p, e in rows.items() if e is None) == [f"{n:03d}.go" for n in range(5)]


texts = st.text("a~b/ \u00e9\ud7ff\U0010ffff", max_size=6)


@given(texts, texts)
def test_middle_lies_between(a, b):
    low, high = sorted([a, b])
    half = middle(low, high)
    assert half is None or low < half < high
    half and half.encode()


@pytest.mark.parametrize("calls", [1, 2, 1000])
def test_trees_are_walked_in_rounds(spark, tree, calls):
    wanted = Wanted(None, frozenset({".py", ".mdx"}))
    files, _ = list_files(spark, LocalStore(tree), wanted, calls, calls)
    assert {(r.key, r.size) for r in files.collect()} == {
        (p, len(TREE[p])) for p in VISIBLE if p.endswith((".py", ".mdx"))
    }


def column(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_path_functions(spark):
    assert column(spark, ["a/B.GO", "a.b/c", "x", ".go", "a."], extension) == [
        ".go", "", "", ".go", "."]
    assert column(spark, ["x.hpp", "x.cxx", "x", "x.MDX"], language_of) == [
        "c", "cpp", "text", "markdown"]
    assert column(spark, ["x.hpp", "x.h", "x"], allowed) == [False, True, False]
    assert column(spark, ["a/.b/c", ".a", "a/.b", ".x/y"], in_hidden_dir) == [
        True, False, False, True]
    keys = ["src/a", "src2/x", "lib/a", "src//a"]
    assert column(spark, keys, lambda k: relative_key(k, F.lit("src"))) == [
        "a", "2/x", "lib/a", "/a"]
    assert column(spark, [WHITE_SPACE + "a b" + WHITE_SPACE], trim_space) == ["a b"]


def test_tombstones_ignore_present_paths(spark):
    known = spark.createDataFrame([("w", "a", "h", NOW), ("w", "b", "h", NOW)], SNAPSHOT)
    scan = spark.createDataFrame([("w", "a")], "workspace_id string, path string")
    assert [tuple(r) for r in tombstones(known, scan).collect()] == [("w", "b", "delete")]


class Tables:
    def __init__(self, spark, root):
        self.snapshot = SnapshotTable(spark, f"{root}/snapshot")
        self.chunks = ChunkTable(spark, f"{root}/chunks")
        self.points = PointTable(spark, f"{root}/points")
        self.memories = MemoryTable(spark, f"{root}/memories")
        self.errors = QuarantineTable(spark, f"{root}/errors")
        self.sinks = [self.chunks, self.points, self.memories]

    def keys(self):
        return {(r.path, r.symbol) for r in self.chunks.read().collect()}


def test_flow_over_changes(spark, tree, tmp_path):
    t = Tables(spark, str(tmp_path))
    os.symlink(tree, os.path.join(tree, "loop.md"))  # cannot be read as a file

    def run(seq):
        return build_flow(
            spark, "w", "local", {"input": tree}, sinks=t.sinks, snapshot=t.snapshot,
            quarantine=t.errors, find_deleted=True, dim=8, seq=seq,
        ).run()

    first = run(1)
    (bad,) = t.errors.read().collect()
    assert (bad.path, bad.stage, bad.error_type) == ("loop.md", "source", "IsADirectoryError")
    assert (first["records_in"], first["records_out"], first["records_skipped"]) == (8, 8, 0)
    assert (first["records_deleted"], first["records_failed"]) == (0, 1)
    assert first["errors_by_stage"] == {"source:IsADirectoryError": 1}
    assert ("_priv/b.go", "X") in t.keys() and ("empty.md", "_doc") in t.keys()
    assert ("pkg/__init__.py", "a") in t.keys() and ("D.GO", "_file") in t.keys()
    # The empty file has a chunk but no vector, so it is no point.
    assert t.points.read().count() == 7 and t.memories.read().count() == 8
    assert t.snapshot.read().count() == 7

    again = run(2)
    assert (again["records_in"], again["records_out"], again["records_skipped"]) == (8, 0, 7)
    assert t.memories.read().count() == 8

    os.unlink(os.path.join(tree, "D.GO"))
    put(tree, {"pkg/__init__.py": b"def a():\n    return 1\n"})
    third = run(3)
    assert (third["records_in"], third["records_out"], third["records_skipped"]) == (7, 2, 5)
    assert third["records_deleted"] == 1
    assert not any(path == "D.GO" for path, _ in t.keys())
    assert "D.GO" not in {r.path for r in t.snapshot.read().collect()}
    body = t.chunks.read().where("path = 'pkg/__init__.py'").first().content
    assert body == "def a():\n    return 1"

    # Every file vanishes: the emptied partitions go too.
    for path in (VISIBLE - {"D.GO"}) | {"loop.md"}:
        os.unlink(os.path.join(tree, path))
    fourth = run(4)
    assert (fourth["records_in"], fourth["records_deleted"]) == (0, 6)
    assert t.snapshot.read().count() == 0
    assert t.keys() == set() and t.points.read().count() == 0


def failing_model():
    def model(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("rejected")
        return [[float(len(t)), 0.0] for t in texts]

    return model


def versions(spark, *rows):
    return spark.createDataFrame([record(**r) for r in rows], RECORDS)


def test_failed_file_is_quarantined_whole(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    rows = versions(
        spark,
        {"id": "a", "path": "a", "language": "markdown", "content": "# 1\nok\n# 2\nbad", "seq": 1},
        {"id": "b", "path": "b", "language": "markdown", "content": "# 1\nok", "seq": 2},
    )
    flow = Flow("f").source(TableSource(rows)).dedup(t.snapshot)
    flow.transform("fan_out", fan_out).transform("embed", embedder(failing_model, 2, 8)).quarantine(t.errors)
    for sink in t.sinks:
        flow.sink(sink)
    stats = flow.run()
    assert t.keys() == {("b", "1")}
    assert stats["errors_by_stage"] == {"embed:RuntimeError": 1}
    assert (stats["records_out"], stats["records_failed"]) == (1, 1)
    # A failed file is tried again by the next run, and what failed is kept by run.
    assert {r.path for r in t.snapshot.read().collect()} == {"b"}
    (bad,) = t.errors.read().collect()
    assert (bad.path, bad.stage, bad.error_type) == ("a", "embed", "RuntimeError")
    fixed = Flow("f").source(TableSource(rows)).dedup(t.snapshot).quarantine(t.errors)
    fixed.transform("fan_out", fan_out).transform("embed", embedder(lambda: lambda x: [[1.0, 0.0]] * len(x), 2, 8))
    assert fixed.sink(t.chunks).run("fixed")["records_failed"] == 0
    assert t.keys() == {("b", "1"), ("a", "1"), ("a", "2")} and t.errors.read().count() == 1


def test_last_version_decides_the_snapshot(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    rows = versions(
        spark,
        {"path": "a", "id": "a", "language": "text", "content": "1", "seq": 1},
        {"path": "a", "id": "a", "language": "text", "content": "", "seq": 2, "action": "delete"},
        {"path": "b", "id": "b", "language": "text", "content": "", "seq": 3, "action": "delete"},
        {"path": "b", "id": "b", "language": "text", "content": "2", "seq": 4},
    )
    flow = Flow("f").source(TableSource(rows)).dedup(t.snapshot)
    stats = flow.transform("fan_out", fan_out).sink(t.chunks).run()
    assert stats["records_deleted"] == 2
    assert {r.path for r in t.snapshot.read().collect()} == {"b"}
    assert t.keys() == {("b", "")}


def test_missing_action_is_an_upsert(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    rows = versions(spark, {"language": "text", "content": "t", "action": None, "symbol": None})
    Flow("f").source(TableSource(rows)).transform("fan_out", fan_out).sink(t.chunks).run()
    assert t.keys() == {("p", "")}


class BrokenSink:
    name = "broken"

    def write(self, log, run_id, now):
        raise OSError("disk")


def test_one_failing_sink_does_not_stop_the_others(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    rows = versions(spark, {"language": "text", "content": "t"})
    flow = Flow("f").source(TableSource(rows)).dedup(t.snapshot).transform("fan_out", fan_out)
    with pytest.raises(ExceptionGroup) as caught:
        flow.sink(BrokenSink()).sink(t.chunks).run()
    stats = caught.value.stats
    assert stats["sinks"] == {"broken": "OSError: disk", "chunks": "ok"}
    assert stats["records_out"] == 0 and "disk" not in stats["errors_by_stage"]
    assert stats["error"] and stats["duration_ms"] > 0
    assert t.chunks.read().count() == 1 and t.snapshot.read().count() == 0


def test_flow_needs_source_and_sink(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing to read"):
        Flow("f").sink(BrokenSink()).run()
    with pytest.raises(ValueError, match="nowhere to write"):
        Flow("f").source(TableSource(versions(spark, {"content": "t"}))).run()
    with pytest.raises(ValueError, match="lacking .'input'"):
        build_flow(spark, "w", "", {}, sinks=[BrokenSink()])
    with pytest.raises(ValueError, match="not one of the sources"):
        build_flow(spark, "w", "ftp", {}, sinks=[BrokenSink()])
    with pytest.raises(ValueError, match="at least one sink"):
        build_flow(spark, "w", "local", {"input": str(tmp_path)})
    with pytest.raises(ValueError, match="not known .'extension'"):
        build_flow(spark, "w", "local", {"input": str(tmp_path), "extension": 1}, sinks=[BrokenSink()])
    with pytest.raises(ValueError, match="must be .hashing. or a callable"):
        embedder("other")


def test_memories_are_appended_once_per_run(spark, tmp_path):
    table = MemoryTable(spark, str(tmp_path / "m"))
    rows = versions(spark, {"language": "text", "content": "t"})
    for run_id in ("r1", "r1", "r2"):
        table.write(rows, run_id, NOW)
    assert table.read().count() == 2


def test_embed_rules(spark):
    rows = versions(
        spark,
        {"id": "a", "content": "The the é_1"},
        {"id": "b", "content": ""},
        {"id": "c", "content": "x", "embedding": [1.0]},
        {"id": "d", "content": "x", "action": "delete"},
        {"id": "e", "content": "}{"},
    )
    found = {r.id: r.embedding for r in embed_by_hashing(rows, 16).collect()}

    def bucket(word):
        return int(hashlib.sha256(word.encode()).hexdigest()[:8], 16) % 16

    counts = np.zeros(16)
    for word in ("the", "the", "é_1"):
        counts[bucket(word)] += 1
    assert np.allclose(found["a"], counts / np.linalg.norm(counts))
    assert found["b"] is None and found["c"] == [1.0] and found["d"] is None
    assert found["e"] == [0.0] * 16


def test_model_batches_keep_order_and_are_checked(spark):
    rows = versions(spark, *[{"id": str(i), "content": "x" * i} for i in range(50)])
    found = embed_with_model(rows.repartition(3), failing_model, 2, 7).collect()
    assert {r.id: r.embedding and r.embedding[0] for r in found} == {
        str(i): float(i) if i else None for i in range(50)
    }
    wrong = embed_with_model(rows, lambda: lambda texts: [[1.0]] * len(texts), 2).collect()
    assert all("expected (2,)" in r.error for r in wrong if r.id != "0")
    short = embed_with_model(rows, lambda: lambda texts: [], 2).collect()
    assert all("0 vectors for 1" in r.error for r in short if r.id != "0")


def sizing_model():
    return lambda texts: [[float(len(texts)), float(sum(map(len, texts)))] for _ in texts]


def test_calls_of_a_model_are_bounded_by_size(spark):
    lengths = [1_000_000, 3, 400, 50, 1_000_000, *range(1, 200), 999]
    texts = [{"id": str(i), "content": "x" * n} for i, n in enumerate(lengths)]
    found = embed_with_model(versions(spark, *texts).coalesce(1), sizing_model, 2, 50, 1000).collect()
    assert len(found) == len(lengths) and all(r.error is None for r in found)
    for r in found:
        count, chars = r.embedding
        assert count <= 50 and (count == 1 or chars <= 1000) and chars >= lengths[int(r.id)]
    assert sum(1 / r.embedding[0] for r in found) < 40  # calls


def outage_model():
    asked = []

    def embed(texts):
        asked.append(len(texts))
        raise ConnectionError(f"call {len(asked)}")

    return embed


def test_an_outage_is_not_retried_text_by_text(spark):
    rows = versions(spark, *[{"id": str(i), "content": "x"} for i in range(100)]).coalesce(1)
    errors = {r.error for r in embed_with_model(rows, outage_model, 2, 10).collect()}
    assert errors == {f"ConnectionError: call {n}" for n in range(1, OUTAGE + 1)}
    picky = embed_with_model(rows.withColumn("content", F.col("id")), lambda: picky_call, 1, 50).collect()
    assert {r.id for r in picky if r.error} == {"7", "42"} and sum(r.embedding is not None for r in picky) == 98


def picky_call(texts):
    if {"7", "42"} & set(texts):
        raise ValueError("no")
    return [[1.0]] * len(texts)


def test_job_ledger(spark, tmp_path):
    ledger = JobLedger(spark, str(tmp_path / "jobs"))
    job = ledger.create("w", 3)
    assert ledger.get(job)["status"] == "queued" and ledger.get(job)["total_files"] == 3
    ledger.count_done(job, "w")
    ledger.count_done(job, "w")
    ledger.count_failed(job, "w")
    ledger.update_status(job, "w", "failed", "why")
    got = ledger.get(job)
    assert (got["status"], got["error_msg"], got["done"], got["failed"]) == ("failed", "why", 2, 1)
    assert ledger.get("unknown") is None
    t = Tables(spark, str(tmp_path))
    rows = versions(spark, {"language": "text", "content": "t"})
    done = ledger.run(
        "w", lambda: Flow("f").source(TableSource(rows)).transform("f", fan_out).sink(t.chunks)
    )
    broken = ledger.run("w", lambda: Flow("f").sink(BrokenSink()))
    found = ledger.get(done)
    assert (found["status"], found["done"], found["failed"], found["total_files"]) == ("done", 1, 0, 1)
    before = ledger.events().count()
    mixed = versions(
        spark, *[{"path": p, "id": p, "language": "text", "content": "t", "seq": n} for n, p in enumerate("abc")]
    )

    def partly(name):
        spoil = F.when(F.col("path") == name, "Spoilt: no").otherwise(F.col("error"))
        flow = Flow("f").source(TableSource(mixed)).transform("f", fan_out)
        return flow.transform("g", lambda rows: rows.withColumn("error", spoil)).sink(t.memories)

    for name, counts in (("b", (2, 1, 3)), ("none", (3, 0, 3))):  # the second run is the same job again
        assert ledger.run("w", lambda name=name: partly(name), "job") == "job"
        found = ledger.get("job")
        assert (found["done"], found["failed"], found["total_files"]) == counts
    assert ledger.events().count() == before + 5
    nothing = ledger.run("w", lambda: Flow("f").source(TableSource(mixed.where("false"))).sink(t.memories))
    assert ledger.get(nothing)["status"] == "done" and ledger.get(nothing)["total_files"] == 0
    assert ledger.get(broken)["status"] == "failed"
    assert "nothing to read" in ledger.get(broken)["error_msg"]
    with pytest.raises(ValueError):
        ledger.run("", lambda: None)
